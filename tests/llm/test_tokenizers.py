"""BPE codec, token counts and language-model scores against the libraries and brute force."""
import hashlib
import math
import random
import zlib
from collections import Counter

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lineark.llm import bpe_codec, lm_score, token_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
MODEL = P.path("piece_bpe_32k.model")
EMPTY = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_codec.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.TreeCodec(bpe_codec.read_ranks(RANKS), P.PATTERN, leaf=1, block=8)


def texts(n, seed):
    r = random.Random(seed)
    parts = ["the", " ", "  ", "\n", "aaaa", "é", "漢字", "123", "'s", "!!", "\t", "ing", "tion", " ", "☃", "ab" * 40]
    return ["".join(r.choices(parts, k=r.randrange(60))) for _ in range(n)]


def test_tree_codec_equals_library(codec, library):
    for t in [*texts(300, 1), "a" * 3000, "ab" * 999, "é" * 500, " " * 300 + "x"]:
        ids = codec.encode(t)
        assert ids.tolist() == library.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_tree_codec_equals_library_on_any_text(t):
    import tiktoken
    if not hasattr(test_tree_codec_equals_library_on_any_text, "both"):
        ranks = bpe_codec.read_ranks(RANKS)
        test_tree_codec_equals_library_on_any_text.both = (
            bpe_codec.TreeCodec(ranks, P.PATTERN, leaf=2, block=6),
            tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    codec, library = test_tree_codec_equals_library_on_any_text.both
    assert codec.encode(t).tolist() == library.encode_ordinary(t)


def test_encode_rows(edge_docs, library, spark):
    got = bpe_codec.encode(edge_docs, RANKS, P.PATTERN)
    rows = got.collect()
    assert len(rows) == edge_docs.count()
    want = Counter()
    for r in edge_docs.collect():
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"], len(ids), b"".join(i.to_bytes(4, "little") for i in ids), (r["text"] or "").encode()] += 1
    assert Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in rows) == want
    back = {bytes(r["decoded"]) for r in bpe_codec.decode(got, RANKS).collect()}
    assert back == {k[3] for k in want}
    assert bpe_codec.encode(spark.createDataFrame([], EMPTY), RANKS, P.PATTERN).count() == 0


def test_token_counts(edge_docs, spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for size in (1, 1000):
        got = token_counts.token_counts(edge_docs, MODEL, 100, table_size=size).collect()
        want = Counter((r["doc_id"], len((r["text"] or "").encode()), n := len(sp.encode(r["text"] or "")), n > 100) for r in edge_docs.collect())
        assert Counter(map(tuple, got)) == want
    assert token_counts.token_counts(spark.createDataFrame([], EMPTY), MODEL, 100).count() == 0


def test_long_pretokens_stay_out_of_the_table(spark):
    texts = spark.createDataFrame([("漢" * 30 + " word",)] * 5 + [("y" * 5000,)] * 5, "t string").selectExpr("cast(t as binary) t")
    got = [r["token"] for r in token_counts.frequent(texts).collect()]
    assert got == ["▁word"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z0.\n\t▁é漢 ☃<>s")), max_size=40))
def test_pretokens_count_like_the_library(t):
    if not hasattr(test_pretokens_count_like_the_library, "c"):
        test_pretokens_count_like_the_library.c = token_counts.PieceCounter(MODEL)
    c = test_pretokens_count_like_the_library.c
    assert sum(map(c, token_counts.pretokens(t))) == len(c.model.encode(t))


def test_lattice_sums_all_segmentations():
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = lm_score._model_ids(MODEL)
    r = random.Random(3)
    logp = {i: math.log(r.random() / len(ids)) for i in ids}
    lattice = lm_score.Lattice(MODEL, logp)

    def brute(s):
        if not s:
            return 1.0
        total = 0.0
        for n in range(1, len(s) + 1):
            if (p := lattice.piece.get(s[:n])) is not None:
                total += math.exp(p) * brute(s[n:])
        if s[0] not in lattice.piece:
            total += math.exp(sum(lattice.byte[b] for b in s[0].encode())) * brute(s[1:])
        return total

    for w in ("the", "hello", "x☃y", "ing\x00", "🙂"):
        assert lattice(w) == pytest.approx(math.log10(brute(lm_score.MARK + w)), rel=1e-9)
    assert m.get_piece_size() > len(ids)


def test_lm_score(edge_docs, spark, monkeypatch):
    monkeypatch.setattr(lm_score, "HOT", 3)
    got = lm_score.lm_score(edge_docs, MODEL).collect()
    rows = edge_docs.collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(r["doc_id"], (r["text"] or "").encode().lower().split() + [b""]) for r in rows]
    seen = Counter(w for i, t in tokens if not held(i) for w in t)
    n, v = sum(seen.values()), len(seen)
    want = Counter((i, held(i), len(t), sum(seen[w] > 0 for w in t), n, round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in t), 4)) for i, t in tokens)
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    # the score adds up from the words' lattices
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = Counter(i for w, c in seen.items() for i in (m.encode(w.decode()) if w else [-1]) for _ in range(c))
    ids = [-1, *lm_score._model_ids(MODEL)]
    total = sum(pieces[i] for i in ids) + len(ids)
    logp = {i: math.log((pieces[i] + 1) / total) for i in ids}
    lattice = lm_score.Lattice(MODEL, {i: p for i, p in logp.items() if i >= 0})
    scores = {(i, round(sum(lattice(w.decode()) if w else logp[-1] / math.log(10) for w in t), 3)) for i, t in tokens}
    assert {(r["doc_id"], round(r["score"], 3)) for r in got} == scores
    assert lm_score.lm_score(spark.createDataFrame([], EMPTY), MODEL).count() == 0


def test_digests_of_the_query(library):
    ids = library.encode_ordinary("the and")
    packed = b"".join(i.to_bytes(4, "little") for i in ids)
    assert hashlib.sha256(packed).hexdigest() == hashlib.sha256(bpe_codec.TreeCodec(bpe_codec.read_ranks(RANKS), P.PATTERN).encode("the and").tobytes()).hexdigest()
