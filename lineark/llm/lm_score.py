"""Language-model scores: a subword lattice over an existing vocabulary, and a word unigram
base.

The lattice weights all segmentations of a word into vocabulary pieces (bytes for characters
that no piece has) by their pieces' unigram probabilities; the forward recursion sums them
in log space, so a word gets its marginal probability.  Words are independent given
the vocabulary, since every word starts with the word mark and no piece holds a mark inside;
a document's probability is the product over its words and one end.  The
pieces' probabilities come from the training documents' words, segmented once per
distinct word.

Words are counted per task first, then once over all tasks.  Each distinct word's lattice is
computed once.  The ``HOT`` most frequent words, a table of fixed size, are broadcast; only
the rarer words of a document, once each, are shuffled to meet their counts.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineark.llm.common import ENTRY_BYTES, STEP, as_bytes, fold, map_rows, stored

HOT = 1 << 17
#: distinct words a task counts before it hands on its partial counts
TASK_WORDS = 300_000
MARK = "▁"


class Lattice:
    """Marginal log10 probabilities of words under piece log probabilities (natural)."""

    def __init__(self, model_path: str, logp: dict[int, float]):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.piece, self.byte = {}, {}
        for i, p in logp.items():
            name = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(name[1:-1], 16)] = p
            else:
                self.piece[name] = p
        self.longest = max(map(len, self.piece), default=1)

    def char(self, c: str) -> float:
        return sum(self.byte[b] for b in c.encode("utf-8"))

    def __call__(self, word: str) -> float:
        text, get, a = MARK + word, self.piece.get, [0.0]
        for j in range(1, len(text) + 1):
            terms = [a[i] + p for i in range(max(0, j - self.longest), j) if (p := get(text[i:j])) is not None]
            if text[j - 1] not in self.piece:
                terms.append(a[j - 1] + self.char(text[j - 1]))
            top = max(terms)
            a.append(top + math.log(sum(math.exp(t - top) for t in terms)))
        return a[-1] / math.log(10)


def _model_ids(model_path: str) -> list[int]:
    """Ids of pieces and bytes, without control and unknown."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]


def word_counts(texts: DataFrame) -> DataFrame:
    """(w, c): training count of every word of ``texts`` (``t`` BINARY, ``held`` BOOLEAN); words of
    held-out texts only have 0; the empty word stands for the end of a text."""
    def run(batches):
        import pyarrow as pa
        seen: Counter = Counter()

        def rows():
            out = pa.RecordBatch.from_pydict({"w": pa.array(seen.keys(), pa.binary()), "c": pa.array(seen.values(), pa.int64())})
            seen.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP).to_pydict()
                for t, held in zip(part["t"], part["held"]):
                    words = t.lower().split()       # bytes: A-Z only; 0x20 and 0x09-0x0D
                    words.append(b"")
                    if held:
                        seen.update(dict.fromkeys(words, 0))
                    else:
                        seen.update(words)
                    if len(seen) > TASK_WORDS:
                        yield rows()
        yield rows()

    own = texts.select("t", "held").mapInArrow(run, "w binary, c long")
    return own.groupBy("w").agg(F.sum("c").alias("c"))


def piece_logp(counts: DataFrame, model_path: str) -> dict[int, float]:
    """Add-one log probabilities of the vocabulary's pieces, and of the end (id -1), in training
    words; the table has one entry per piece, however large the corpus is."""
    def run(batches):
        import pyarrow as pa
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        seen: dict[int, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 4 * STEP):
                part = batch.slice(at, 4 * STEP).to_pydict()
                for w, c in zip(part["w"], part["c"]):
                    for i in model.encode(w.decode("utf-8", "replace")) if w else [-1]:
                        seen[i] = seen.get(i, 0) + c
        yield pa.RecordBatch.from_pydict({"i": pa.array(seen.keys(), pa.int32()), "n": pa.array(seen.values(), pa.int64())})

    ids = [-1, *_model_ids(model_path)]
    got = counts.where("c > 0").mapInArrow(run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n"))
    n = {r["i"]: r["n"] for r in got.collect()}
    total = sum(n.get(i, 0) for i in ids) + len(ids)
    return {i: math.log((n.get(i, 0) + 1) / total) for i in ids}


def lm_score(docs: DataFrame, model_path: str, folds: int = 7, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Log10 probabilities of every whole text, learned from texts outside the held-out fold.

    Words are runs outside white space, A-Z lower-cased; a text's tokens are its words and one
    end.  Returns one row per input row: the id column; ``held_out`` BOOLEAN (crc32 of the id as
    text modulo ``folds`` is ``held``; false for a null id, which is learned from); ``n_tokens``,
    ``n_known`` (seen in training) and ``train_tokens`` LONG; ``base_score`` DOUBLE, the sum of
    log10((c+1)/(N+1*(V+1))); ``score`` DOUBLE, the lattice's marginal.  A null or empty text has
    the end only.  With no training text, c, N and V are 0.  Repeated rows count
    each in training and get equal scores.  Other columns are ignored.
    """
    kind = dict(docs.dtypes)[id_col]
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("k"), F.coalesce(fold(F.col(id_col), folds) == held, F.lit(False)).alias("held"),
                        as_bytes(F.col(text_col)).alias("t"))
    counts = stored(word_counts(texts), "counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    train_tokens, floor = total["n"], total["n"] + total["v"] + 1
    model = spark.sparkContext.broadcast(piece_logp(counts, model_path))    # one number per piece

    def weigh():
        logp = dict(model.value)
        end = logp.pop(-1) / math.log(10)
        lattice = Lattice(model_path, logp)
        return lambda cols: {"w": cols["w"], "c": cols["c"], "lp": [lattice(w.decode("utf-8", "replace")) if w else end for w in cols["w"]]}

    words = stored(map_rows(counts, weigh, "w binary, c long, lp double"), "words")
    top = words.where(F.length("w") <= ENTRY_BYTES).orderBy(F.desc("c"), "w").limit(HOT)
    hot = spark.sparkContext.broadcast({bytes(r["w"]): (r["c"] > 0, math.log10((r["c"] + 1) / floor), r["lp"]) for r in top.toLocalIterator()})

    def split():
        import xxhash
        table = hot.value

        def step(cols):
            out = {c: [] for c in ("k", "held", "h", "w", "n", "head", "known", "base", "lp")}
            for k, is_held, t in zip(cols["k"], cols["held"], cols["t"]):
                tokens = t.lower().split()
                tokens.append(b"")
                h = xxhash.xxh3_128_digest(t)
                known, base, lp, rare = 0, 0.0, 0.0, []
                for w, n in Counter(tokens).items():
                    if (x := table.get(w)) is None:
                        rare.append((w, n))
                    else:
                        known += n * x[0]
                        base += n * x[1]
                        lp += n * x[2]
                size = len(rare) + 1
                out["k"] += [k] * size
                out["held"] += [is_held] * size
                out["h"] += [h] * size
                # the head row carries the sums so far; its key has a space, so it is no word and is spread evenly
                out["w"] += [b" " + h, *(w for w, _ in rare)]
                out["n"] += [len(tokens), *(n for _, n in rare)]
                out["head"] += [1] + [0] * len(rare)
                out["known"] += [known] + [0] * len(rare)
                out["base"] += [base] + [0.0] * len(rare)
                out["lp"] += [lp] + [0.0] * len(rare)
            return out
        return step

    rows = map_rows(texts, split, f"k {kind}, held boolean, h binary, w binary, n long, head int, known long, base double, lp double")
    met = rows.join(words.select("w", "c", F.col("lp").alias("wlp")), "w", "left")
    is_head, c = F.col("head") == 1, F.coalesce("c", F.lit(0))
    sums = met.groupBy("k", "held", "h").agg(
        F.sum("head").alias("copies"),
        F.sum(F.when(is_head, F.col("n"))).alias("n_tokens"),
        F.sum(F.when(is_head, F.col("known")).when(c > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.when(is_head, F.col("base")).otherwise(F.col("n") * F.log10((c + 1) / F.lit(floor)))).alias("base_score"),
        F.sum(F.when(is_head, F.col("lp")).otherwise(F.col("n") * F.col("wlp"))).alias("score"))
    each = lambda name: (F.col(name) / F.col("copies")).alias(name)
    whole = lambda name: (F.expr(f"{name} div copies")).alias(name)
    return sums.select(F.col("k").alias(id_col), F.col("held").alias("held_out"), whole("n_tokens"), whole("n_known"),
                       F.lit(train_tokens).cast("long").alias("train_tokens"), each("base_score"), each("score"),
                       F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
