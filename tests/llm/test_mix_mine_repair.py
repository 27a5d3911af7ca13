"""Source mixing, hard negatives and conversation repair against brute force."""
import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lineark.llm import conversation_repair, hard_negatives, queries, source_mix

DOCS = "doc_id long, text string, source string"


# --- mixing -----------------------------------------------------------------

def water(sizes, budget, weights=(1, 2, 3), repeats=3):
    """Targets by the rule as it is told: share by weight, stop at the cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed = {}
    while len(fixed) < len(order):
        free = [s for s in order if s not in fixed]
        level = (budget - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > repeats * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: float(repeats * sizes[s]) for s in over}
    return fixed


def corpus(seed, n=400):
    r = random.Random(seed)
    sources = [None, "a", "B", "é", "zz", "𝔸", "￮", "tiny"]
    rows = []
    for i in range(n):
        source = "a" if r.random() < 0.4 else r.choice(sources[:-1])
        rows.append((i, " ".join(["w"] * r.choice([0, 1, 3, 20, 60])), source))
    return rows + [(n, "one two", "tiny"), (n + 1, None, "empty source"), (None, "no id here", "a"), (7, "w w w", "a"), (7, "w w w", "a")]


@pytest.mark.parametrize("share", [1.0, 0.3, 2.5, 3.5])
def test_mix_follows_targets(spark, share):
    rows = corpus(3)
    got = source_mix.taken(spark.createDataFrame(rows, DOCS).repartition(7), share).collect()
    size_of = defaultdict(int)
    for _, t, s in rows:
        size_of[s] += len((t or "").split())
    budget = math.floor(share * sum(size_of.values()))
    aim = water(size_of, budget)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len((t or "").split())) for i, t, s in rows)
    assert all(0 <= r.taken <= 3 * r.size and r.taken == r.rounds * r.size for r in got if r.size)
    by_id = {(i, len((t or "").split())): s for i, t, s in rows}
    sums, told = defaultdict(int), {}
    for r in got:
        s = by_id[r.doc_id, r.size]
        sums[s] += r.taken
        told[s] = r.target, r.source_size
    for s in size_of:
        assert told[s][1] == size_of[s] and told[s][0] == pytest.approx(aim[s])
        assert abs(sums[s] - aim[s]) <= 2 * 60
    assert sum(sums.values()) <= budget


def test_mix_is_the_queue_in_python(spark):
    rows = corpus(5, 150)
    size = lambda t: len((t or "").split())
    of = defaultdict(list)
    for i, t, s in rows:
        of[s].append((hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), -1 if i is None else i, size(t)))
    total = {s: sum(x[2] for x in v) for s, v in of.items()}
    budget, aims = sum(total.values()), water(total, sum(total.values()))
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    queue = []
    for s, docs in of.items():
        for k in range(max(1, math.ceil(aims[s] / total[s])) if total[s] else 1):
            up = 0
            for key, i, n in sorted(docs):
                up += n
                queue.append(((k * total[s] + up) / aims[s] if aims[s] else 0.0, order.index(s), k, key, i, n))
    want, sent = [], 0
    for *_, k, _, i, n in sorted(queue):
        sent += n
        if sent <= budget:
            want.append((None if i < 0 else i, n, k, sent))
    got = source_mix.mix(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert Counter((r.doc_id, r.size, r.round, r.sent) for r in got) == Counter(want)


def test_mix_of_edges(spark, edge_docs):
    got = source_mix.taken(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert sum(r.taken for r in got) <= sum(r.size for r in got)
    assert set(got[0].asDict()) == {"doc_id", "size", "source_size", "target", "taken", "rounds"}
    assert source_mix.taken(spark.createDataFrame([], DOCS)).collect() == []
    blank = source_mix.taken(spark.createDataFrame([(1, "", "s"), (2, None, None)], DOCS)).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2


def test_mix_does_not_depend_on_partitions(spark):
    rows = corpus(9, 200)
    one = source_mix.taken(spark.createDataFrame(rows, DOCS).coalesce(1)).collect()
    many = source_mix.taken(spark.createDataFrame(list(reversed(rows)), DOCS).repartition(11)).collect()
    assert Counter(one) == Counter(many)


# --- hard negatives -----------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def mined(rows, every=50, k=5, m=3):
    """Brute force with integers."""
    full = []
    for i, v, lab in rows:
        if i is None or v is None or lab is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        full.append((i, lab, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    full = list(dict.fromkeys(full))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a in full:
        if a[0] % every:
            continue
        others = sorted(((dot(a[2], b[2]), b) for b in full if b != a), key=lambda x: (-x[0], x[1][0]))
        for p, b in [x for x in others if x[1][1] == a[1]][:k]:
            fit = [(n, c) for n, c in others if c[1] != a[1] and 50 * p <= 100 * n <= 95 * p]
            out += [(a[0], b[0], i, c[0], p, n) for i, (n, c) in enumerate(fit[:m], 1)]
    return Counter(out)


def vectors(seed, n, dims, copies=0.3):
    r = np.random.RandomState(seed)
    base = r.normal(size=(8, dims))
    x = np.where(r.rand(n, 1) < copies, base[r.randint(0, 8, n)], r.normal(size=(n, dims))) + 0.05 * r.normal(size=(n, dims))
    x[: n // 4] = x[0]                  # many equal vectors
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, [float(v) for v in row], int(r.randint(0, 4))) for i, row in enumerate(x)]


@pytest.mark.parametrize("n,dims,every,blocks", [(300, 64, 50, 1 << 18), (250, 7, 10, 40), (120, 130, 5, 130), (90, 1, 7, 4)])
def test_hard_negatives_equal_brute_force(shipped, monkeypatch, n, dims, every, blocks):
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", blocks)         # several blocks of anchors
    rows = vectors(n, n, dims)
    got = hard_negatives.hard_negatives(shipped.createDataFrame(rows, VECTORS).repartition(4), every=every)
    assert Counter(map(tuple, got.collect())) == mined(rows, every)


def test_hard_negatives_of_edges(shipped):
    rows = vectors(1, 60, 8)
    odd = [(100, None, 1), (150, [0.1, None] + [0.0] * 6, 1), (200, [float("nan")] * 8, 2), (250, [float("inf")] * 8, 2), (300, [0.5] * 8, None),
           (None, [0.5] * 8, 1), (350, [0.0] * 8, 0), (400, [], 1), (450, [0.5, -0.5], 1)]
    extra = [(*r, "x", 1) for r in rows + odd + rows[:5]]
    df = shipped.createDataFrame(extra, VECTORS + ", mark string, score int")
    got = hard_negatives.hard_negatives(df)
    padded = [(i, v and list(v) + [0.0] * (8 - len(v)) if v is not None else v, lab) for i, v, lab in rows + odd]
    padded = [(i, [0.0] * 8 if v == [] else v, lab) for i, v, lab in padded]
    assert Counter(map(tuple, got.collect())) == mined(padded)
    assert hard_negatives.hard_negatives(shipped.createDataFrame([], VECTORS)).collect() == []
    assert hard_negatives.hard_negatives(shipped.createDataFrame([(1, [0.5], 1)], VECTORS)).collect() == []
    with pytest.raises(ValueError, match="inner products"):
        hard_negatives.hard_negatives(shipped.createDataFrame([(1, [1e15], 1)], VECTORS))


def test_intervals_hold_the_scores_and_narrow():
    r = np.random.RandomState(4)
    for dims in (3, 64, 100):
        v = r.randint(-250, 250, size=(400, dims)).astype(np.int64)
        v[0] = 0
        turns = hard_negatives.rotations(dims, len(hard_negatives.PLANES))
        codes, t, rest = hard_negatives.encode(v, turns)
        q = hard_negatives.Queries(v[:50], turns)
        mid, wide = q.interval(np.arange(50), codes, t, rest, np.linalg.norm(v, axis=1))
        exact = v[:50] @ v.T
        assert (np.abs(exact - mid) <= wide).all()
        assert rest[1:].mean() < 0.35 * np.linalg.norm(v[1:], axis=1).mean()


# --- conversations ------------------------------------------------------------

def cheapest(rows):
    """(cost, audit) over all edits by plain enumeration of the states, audits kept whole."""
    best = {0: (0, "")}
    due = {0: 2, 1: 2, 2: 3, 3: 2}

    def inserted(best):
        for _ in range(3):
            for q, (c, a) in list(best.items()):
                best[due[q]] = min(best.get(due[q], (10**9, "")), (c + 5, a + "I"))
        return best
    for initial, fault in rows:
        new = {}
        for q, (c, a) in inserted(best).items():
            steps = [(2, "D", q)]
            if fault not in "bd" or not fault:
                more = 5 if fault == "t" else 0
                steps += [(more + 1, "R", due[q])]
                steps += [(more, "K", 1)] if initial == "s" and q == 0 else []
                steps += [(more, "K", due[q])] if initial == " sua"[due[q]] else []
            for d, letter, to in steps:
                new[to] = min(new.get(to, (10**9, "")), (c + d, a + letter))
        best = new
    best = inserted(best)
    return min(best[q] for q in (0, 3) if q in best)


def code(initial, fault):
    return 4 * {"": 0, "t": 1, "d": 2, "b": 3}[fault] + ("sua".index(initial) if initial in "sua" and initial else 3)


def test_agenda_finds_the_least_repair_of_all_short_conversations():
    kinds = [(i, f) for i in ("s", "u", "a", "x") for f in ("", "t", "b")]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            assert conversation_repair.lightest(bytes(code(*r) for r in rows)) == cheapest(rows), rows


@pytest.mark.parametrize("segment", [1, 2, 3, 7, 512])
def test_agenda_in_segments(segment):
    r = random.Random(segment)
    for _ in range(150):
        rows = [(r.choice("suaauaux"), r.choice(["", "", "", "t", "d", "b"])) for _ in range(r.randrange(0, 30))]
        assert conversation_repair.lightest(bytes(code(*x) for x in rows), segment) == cheapest(rows)


def test_agenda_takes_a_very_long_conversation():
    r = random.Random(1)
    rows = [(r.choice("ua"), r.choice(["", "", "t", "b"])) for _ in range(20_000)]
    cost, audit = conversation_repair.lightest(bytes(code(*x) for x in rows))
    assert len(audit.replace("I", "")) == len(rows)
    small = rows[:3000]
    assert conversation_repair.lightest(bytes(code(*x) for x in small)) == cheapest(small)


def by_hand(rows):
    """The contract's figures of damaged rows, conversation by conversation, in plain Python."""
    groups, out = defaultdict(list), {}
    text_of = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        groups.setdefault(conv, [])
        role, text = text_of(role), text_of(text)
        fate = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        groups[conv] += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    for conv, g in groups.items():
        g.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.md5(x[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in g:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, *_ in g if t is not None]
        initials = [r[:1] for _, r, _ in g]
        cost, audit = cheapest(list(zip(initials, faults)))
        repaired, last, left = [], 0, iter(g)
        for letter in audit:
            if letter == "I":
                last = {0: 2, 1: 2, 2: 3, 3: 2}[last]
                repaired.append(("user" if last == 2 else "assistant") + ":")
                continue
            _, role, text = next(left)
            if letter == "D":
                continue
            last = 1 if letter == "K" and role[:1] == "s" else {0: 2, 1: 2, 2: 3, 3: 2}[last]
            repaired.append((role if letter == "K" else "user" if last == 2 else "assistant") + ":" + text)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def test_repair_equals_plain_python(shipped):
    r = random.Random(8)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(r.choice([1, 2, 5, 9, 700 if conv == 3 else 4])):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = r.choice(["Hello there.", "what?", "no end", " \t\n ", "", None, "end. \n", f"text {turn}!", "漢字。", "x" * 3000 + "."])
            rows.append((conv, r.choice([turn, turn, turn, turn + 2, None]), role, text))
    rows += rows[:30]
    df = shipped.createDataFrame([(*x, "u", 3) for x in rows], "conv_id long, turn long, role string, text string, sign string, head int").repartition(5)
    got = conversation_repair.repair(queries.damaged(df), gone_col="gone").collect()
    assert {x.conv_id: tuple(x)[1:] for x in got} == by_hand(rows) and len(got) == 61


def test_repair_of_edges(shipped):
    schema = "conv_id string, turn int, role string, text string, gone boolean"
    empty = hashlib.sha256(b"").hexdigest()
    got = conversation_repair.repair(shipped.createDataFrame([("all gone", 1, "user", "x.", True), ("one", None, "assistant", "So.", None)], schema), gone_col="gone")
    assert {tuple(x) for x in got.collect()} == {("all gone", 0, 0, 0, 0, 0, 0, "", empty), ("one", 0, 0, 0, 0, 0, 2, "D", empty)}
    assert conversation_repair.repair(shipped.createDataFrame([], schema)).collect() == []
