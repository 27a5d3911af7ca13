"""N-gram join, decontamination and top-k search against brute force."""
import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lineark.llm import decontaminate, ngram_join, topk_codes

EMPTY = "doc_id long, text string"


def grams(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute_components(rows, width, num, den):
    sets = [(i, grams(t, width)) for i, t in rows]
    up = list(range(len(sets)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                up[max(root(a), root(b))] = min(root(a), root(b))
    low = {}
    for a, (i, s) in enumerate(sets):
        if i is not None:
            low[root(a)] = min(i, low.get(root(a), i))
    return Counter((i, len(s), low.get(root(a), i) if s else i) for a, (i, s) in enumerate(sets))


def near_copies(seed, n=260):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [r.choices(vocabulary, k=r.choice([3, 4, 8, 15, 40, 120, 400])) for _ in range(30)]
    shared = r.choices(vocabulary, k=25)
    out = []
    for i in range(n):
        w = list(bases[0] if r.random() < 0.3 else r.choice(bases))     # one group holds a third
        for _ in range(r.choice([0, 0, 1, 2, 5, len(w) // 20 + 1])):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        if r.random() < 0.3:
            w = w + shared
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("width,num,seed", [(4, 85, 1), (5, 80, 2), (2, 50, 3)])
def test_ngram_join_equals_brute_force(shipped, width, num, seed):
    rows = near_copies(seed)
    got = ngram_join.ngram_join(shipped.createDataFrame(rows, EMPTY).repartition(5), width, num, 100)
    assert Counter(map(tuple, got.collect())) == brute_components(rows, width, num, 100)


def test_ngram_join_edges(edge_docs, spark):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    got = ngram_join.ngram_join(edge_docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, got.collect())) == brute_components(rows, 4, 85, 100)
    assert ngram_join.ngram_join(spark.createDataFrame([], EMPTY)).count() == 0
    kept = ngram_join.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(
        [(False, i) for i in (0, 1, 2, 3, 5, 6, 7, 8, 9)] + [(True, 0)] * 2)


def test_signatures_meet_for_every_linked_pair():
    """Also for sets whose n-grams leave most fragments empty."""
    r = np.random.default_rng(5)
    cuts = ngram_join.Cuts(85, 100)
    for trial in range(3000):
        n = int(r.integers(1, 60))
        x = r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        if trial % 2:
            x = x >> np.uint64(int(r.integers(0, 40)))          # crowds them into few fragments
        y = set(x.tolist())
        for _ in range(int(r.integers(0, 6))):
            if r.random() < 0.5 and len(y) > 1:
                y.discard(next(iter(y)))
            else:
                y.add(int(r.integers(0, 1 << 62)))
        a, b = np.unique(x), np.array(sorted(y), np.uint64)
        both = len(np.intersect1d(a, b))
        if both != len(a) or both != len(b):
            if 100 * both >= 85 * (len(a) + len(b) - both):
                (sa, qa), (sb, qb) = cuts.signatures(a), cuts.signatures(b)
                common = set(sa.tolist()) & set(sb.tolist())
                # in some cut that both take, they share as many as either's quota asks
                shared = Counter(v & (1 << cuts.bits) - 1 for v in common)         # a hash's low bits name its cut
                asked = [{int(q) >> 32: int(q) & 0xFFFFFFFF for q in qq} for qq in (qa, qb)]
                assert any(shared[k] >= max(asked[0][k], asked[1][k]) for k in asked[0].keys() & asked[1].keys())


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(1000, r.randrange(2000, 2100)) for _ in range(200)] + [(5000, 5001), (5001, 5000)]
    got = {x["cid"]: x["comp"] for x in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and got[5001] == 5000
    assert {c for v, c in got.items() if 2000 <= v < 2100} == {1000}


WORDS = [f"v{i}" for i in range(500)]


def test_decontaminate(shipped):
    r = random.Random(4)
    items = [(i, " ".join(r.choices(WORDS, k=k))) for i, k in enumerate([5, 8, 15, 15, 40, 60])] + [(6, None), (7, ""), (1, None)]
    doc = lambda k: r.choices(WORDS, k=k)
    rows, want = [], set()
    for i in range(40):
        w = doc(r.choice([0, 3, 30, 300]))
        item = r.choice([1, 2, 3, 4, 5])
        passage = items[item][1].split()
        if i % 4 == 1:
            w = w + passage + doc(5)
            want.add((i, item))
        if i % 4 == 2 and len(passage) >= 15:
            passage[7] = "changed"                       # one exchanged word in fifteen
            w = w + passage
            want.add((i, item))
        if i % 4 == 3:
            w = w + passage[:6] + doc(4)                 # too short an overlap
        rows.append((i, " ".join(w).upper().replace(" ", ", "), "x", 1))
    rows += [(1, rows[1][1], "x", 1), (None, items[4][1], "x", 2), (100, None, "x", 3), (101, "", "x", 3)]
    want.add((None, 4))
    docs = shipped.createDataFrame(rows, "doc_id long, text string, item_id string, seed long")
    bench = shipped.createDataFrame(items, EMPTY.replace("doc_id", "item_id"))
    found = decontaminate.overlaps(docs, bench)
    assert {(x["doc_id"], x["item_id"]) for x in found.collect()} == want
    clean = decontaminate.decontaminate(docs, bench)
    bad = {i for i, _ in want}
    assert clean.columns == docs.columns
    assert sorted(x["doc_id"] for x in clean.collect()) == sorted(x[0] for x in rows if x[0] not in bad)
    empty = shipped.createDataFrame([], EMPTY)
    assert decontaminate.overlaps(empty, bench).count() == 0
    assert decontaminate.decontaminate(docs, empty.withColumnRenamed("doc_id", "item_id")).count() == len(rows)
    # a bitmap too small for the benchmark costs speed only
    small = decontaminate.overlaps(docs, bench, bitmap_bits=64)
    assert {(x["doc_id"], x["item_id"]) for x in small.collect()} == want


def tolerated(n):
    """All ways to exchange as many of a run's ``n`` words as ``similarity`` allows."""
    return itertools.combinations(range(n), n - math.ceil(n * decontaminate.SIMILARITY - 1e-9))


def test_masks_cover_the_tolerance():
    def seeded(n, changed):
        return any(all(mask[k] == "0" or at + k not in changed for k in range(len(mask)))
                   for mask in decontaminate.masks_of(n) for at in range(n - len(mask) + 1))
    for n in range(decontaminate.LEAST, decontaminate.RUN + 1):
        assert [x for x in tolerated(n) if not seeded(n, x)] == []
    for phase in range(5):
        assert seeded(60, set(range(phase, 60, 5)))
    assert all(mask.startswith("11") for mask in (*decontaminate.MASKS, *decontaminate.SHORT_MASKS))


def test_exchanged_words_are_found(shipped):
    item = [f"word{i}" for i in range(60)]
    lengths = [13, 12, 11, 10, 9, 8]
    bench = shipped.createDataFrame([(n, " ".join(f"n{n}x{i}" for i in range(n))) for n in lengths] + [(60, " ".join(item))], "item_id long, text string")
    docs = []
    for n in lengths:
        docs += [(n, " ".join(["before", *("changed" if i in x else f"n{n}x{i}" for i in range(n)), "after"])) for x in tolerated(n)]
    docs += [(60, " ".join("changed" if i % 5 == phase else w for i, w in enumerate(item))) for phase in (3,)]
    found = decontaminate.overlaps(shipped.createDataFrame(docs, EMPTY), bench).collect()
    assert Counter(x["item_id"] for x in found) == Counter(i for i, _ in docs)
    assert all(x["doc_id"] == x["item_id"] for x in found)


def test_top_k(shipped):
    r = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(r.normal(size=(300, 20)))]
    for i in range(0, 300, 3):
        vectors[i] = (i, vectors[0][1])                  # a third share one vector
    rows = vectors + [(300, None), (None, vectors[1][1]), (5, vectors[5][1]), (350, [1.0, None, 2.0]), (400, [])]
    df = shipped.createDataFrame([(a, b, 7) for a, b in rows], "vec_id long, embedding array<double>, rank int")
    got = [tuple(x) for x in topk_codes.top_k(df, k=6).collect()]
    bits = {i: [int(x is not None and x > 0) for x in v] + [0] * (20 - len(v)) for i, v in rows if i is not None and v is not None}
    want = []
    for q in (i for i in bits if i % 50 == 0):
        near = sorted((sum(a != b for a, b in zip(bits[q], bits[i])), i) for i in bits if i != q)[:6]
        want += [(q, n, i, d) for n, (d, i) in enumerate(near, 1)]
    assert sorted(got) == sorted(want)
    few = shipped.createDataFrame([(0, [1.0]), (1, [-1.0])], "vec_id long, embedding array<double>")
    assert [tuple(x) for x in topk_codes.top_k(few).collect()] == [(0, 1, 1, 1)]
    assert topk_codes.top_k(few.where("false")).count() == 0


def all_alignments(docs, items, run=13, share=0.8):
    """(doc, item) pairs with a run of aligned words, at any alignment, of which enough are equal: all
    words of an item of fewer than 8."""
    import re
    words = lambda t: re.findall(r"[0-9A-Za-z]+", (t or "").lower())
    out = set()
    for d, text in docs:
        h = words(text)
        for item, other in items:
            q = words(other)
            n = min(run, len(q))
            for shift in range(-len(q) + 1, len(h)):
                m = [0 <= shift + k < len(h) and h[shift + k] == q[k] for k in range(len(q))]
                if n and max(sum(m[s:s + n]) for s in range(len(q) - n + 1)) >= (n if n < 8 else share * n):
                    out.add((d, item))
                    break
    return out


def test_decontamination_equals_a_scan_of_all_alignments(shipped):
    r = random.Random(12)
    vocabulary = [f"v{i}" for i in range(60)]           # few words, so that chance overlaps of some words are many
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([2, 3, 5, 7, 8, 9, 11, 13, 14, 20, 40])))) for i in range(40)]
    items += [(40, "Unique"), (41, None), (42, ""), (43, items[5][1])]
    docs = []
    for d in range(160):
        w = r.choices(vocabulary, k=r.choice([0, 3, 30, 120]))
        q = (r.choice(items)[1] or "").split()
        a = r.randrange(len(q) + 1) if r.random() < 0.4 else 0
        q = q[a:]
        for _ in range(r.choice([0, 1, 2, 3, len(q) // 6])):
            if q:
                q[r.randrange(len(q))] = "other"
        at = r.randrange(len(w) + 1)
        docs.append((d, " ".join(w[:at] + q + w[at:])))
    docs += [(200, "so unique, so"), (201, None), (202, "")]
    got = decontaminate.overlaps(shipped.createDataFrame(docs, EMPTY).repartition(3), shipped.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == all_alignments(docs, items)


def test_decontamination_of_short_items_and_unspaced_scripts(shipped):
    chinese = "机器学习模型在评测数据集上的表现常常因为训练语料包含题目而被高估这是一个普遍的问题"
    thai = "ประเทศไทยมีเมืองหลวงชื่อกรุงเทพมหานคร"
    items = [(1, "what is the capital of old Ruritania"), (2, chinese), (3, thai), (4, "xyzzy"), (5, "two words")]
    docs = [(1, "He asked: What is the capital of old Ruritania?"), (2, "前文很长。" + chinese + "后文。"), (3, "ก" + thai), (4, "say xyzzy now"), (5, "two, words"),
            (10, "What is the capital of new Ruritania"), (11, chinese[::-1]), (12, "xyzzyx"), (13, "words two"),
            (14, chinese[:10] + "完" + chinese[11:])]
    got = decontaminate.overlaps(shipped.createDataFrame(docs, EMPTY), shipped.createDataFrame(items, "item_id long, text string"))
    assert {(x.doc_id, x.item_id) for x in got.collect()} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (14, 2)}


def test_stages_keep_columns_whatever_their_names(edge_docs, shipped):
    from lineark.llm import ngram_join
    extra = edge_docs.selectExpr("*", "'a' as `hash`", "1 as row", "'b' as __doc_hash", "'c' as `dotted.name`")
    bench = shipped.createDataFrame([(1, "no id here")], "item_id long, text string")
    kept = decontaminate.decontaminate(extra, bench)
    assert kept.columns == extra.columns
    rows = [tuple(x) for x in extra.collect()]
    assert Counter(map(tuple, kept.collect())) == Counter(x for x in rows if x[1] != "no id here")
    one = ngram_join.one_of_each(extra, width=5, num=80)
    assert one.columns == extra.columns and set(map(tuple, one.collect())) <= set(rows)
    assert {x.doc_id for x in one.collect()} >= {0, 1, 2, 7, 8}


def test_top_k_of_edges(edge_docs, shipped):
    vecs = [(i * 50, [1.0 if i >> b & 1 else -1.0 for b in range(9)], "x") for i in range(30)] + [(None, [1.0], "x"), (7, None, "x"), (50, [1.0] * 9, "x"), (3, [None, 1.0], "x")]
    df = shipped.createDataFrame(vecs + vecs[:4], "vec_id long, embedding array<double>, d string")
    got = defaultdict(list)
    for r in topk_codes.top_k(df, k=4).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.distance, r.neighbour_id))
    bits = lambda v: [1 if b < len(v) and (v[b] or 0) > 0 else 0 for b in range(9)]
    rows = [(i, bits(v)) for i, v, _ in vecs if i is not None and v is not None]
    for q in {i for i, _ in rows if i % 50 == 0}:
        near = {}
        for i, c in rows:
            if i != q:
                near[i] = min(near.get(i, 99), min(sum(a != b for a, b in zip(c, o)) for j, o in rows if j == q))
        assert got[q] == sorted((d, i) for i, d in near.items())[:4]
