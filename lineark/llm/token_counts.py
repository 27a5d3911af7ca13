"""Token counts by a map-side two-tier lookup, without any pre-token shuffle.

A sentencepiece BPE text never merges across the start of a run of word marks (no piece of
the vocabulary has a mark after another character) nor across a line feed (no piece has
one), so a text's count is the sum over its pre-tokens.  Both facts are checked against
the vocabulary when the model is loaded.

Tier one is a compact table of the pre-tokens that are frequent in the whole input, with
their token counts, broadcast to the workers.  It is built from one counting pass in which
each task keeps only its own ``TASK_TOP`` most frequent pre-tokens.  Its size is fixed by
``TABLE_SIZE``.  Tier two is a bounded cache in each worker, filled by encoding the misses.
Both tiers only save work; the counts do not depend on them.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineark.llm.common import ENTRY_BYTES, STEP, Cache, as_bytes, map_rows

MARK = "▁"
TASK_TOP = 4_096
TABLE_SIZE = 65_536
CACHED = 250_000
#: a counting pass drops rare entries of a task's counter beyond this many
COUNTER_SIZE = 200_000
_PRETOKEN = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")


def pretokens(text: str) -> list[str]:
    """Runs that are encoded apart from each other; white space is marked as the library does."""
    return _PRETOKEN.findall(MARK + text.replace(" ", MARK)) if text else []


class PieceCounter:
    """Counts the tokens of one pre-token with the library."""

    def __init__(self, model_path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
            raise ValueError("this vocabulary joins words or lines: its texts can't be counted by pre-token")

    def __call__(self, token: str) -> int:
        if token == "\n":
            return len(self.model.encode("\n")) - 1      # the library puts one mark before a text
        if token[0] != MARK:                             # starts a line: no mark of its own
            return len(self.model.encode("\n" + token)) - len(self.model.encode("\n"))
        if token == MARK:
            return len(self.model.encode("\n")) - 1 and 1
        return len(self.model.encode(token[1:]))


def frequent(texts: DataFrame, table_size: int = TABLE_SIZE) -> DataFrame:
    """The ``table_size`` pre-tokens with the largest counts over the tasks' own top lists,
    none longer than ``ENTRY_BYTES``: ``token``, ``n``.  ``texts`` has one BINARY column ``t``."""

    def run(batches):
        import pyarrow as pa
        seen: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                for t in batch.column(0).slice(at, STEP).to_pylist():
                    seen.update(pretokens(t.decode("utf-8", "replace")))
                if len(seen) > COUNTER_SIZE:
                    seen = Counter(dict(seen.most_common(COUNTER_SIZE // 4)))
        top = Counter({x: n for x, n in seen.items() if len(x.encode("utf-8")) <= ENTRY_BYTES}).most_common(TASK_TOP)
        yield pa.RecordBatch.from_pydict({"token": pa.array([x for x, _ in top], pa.string()),
                                          "n": pa.array([n for _, n in top], pa.int64())})

    own = texts.select("t").mapInArrow(run, "token string, n long")
    return (own.groupBy("token").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "token").limit(table_size))


def token_counts(docs: DataFrame, model_path: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text", table_size: int = TABLE_SIZE) -> DataFrame:
    """Tokens of every whole text, as the sentencepiece model at ``model_path`` gives them
    without begin and end tokens.

    Returns one row per input row: the id column, ``n_bytes`` LONG (UTF-8), ``n_tokens``
    LONG, ``over_limit`` BOOLEAN (more than ``limit`` tokens).  A null or empty text has
    0 and 0; repeated rows are counted each; other columns are ignored.  The model file
    must be readable at its path on every executor.
    """
    kind = dict(docs.dtypes)[id_col]
    spark = docs.sparkSession
    df = docs.select(F.col(id_col).alias("k"), as_bytes(F.col(text_col)).alias("t"))

    words = [r["token"] for r in frequent(df, table_size).select("token").toLocalIterator()]   # at most table_size
    count = PieceCounter(model_path)
    raw = [w.encode("utf-8") for w in words]
    shared = spark.sparkContext.broadcast((
        b"".join(raw), np.cumsum([0, *map(len, raw)], dtype=np.uint32),
        np.array([count(w) for w in words], dtype=np.uint32)))

    def make():
        blob, ends, sizes = shared.value
        table = {blob[a:b].decode("utf-8"): int(n) for a, b, n in zip(ends, ends[1:], sizes)}
        misses = Cache(PieceCounter(model_path), CACHED)

        class Tiers(dict):
            def __missing__(self, token):
                return misses[token]

        known = Tiers(table).__getitem__

        def step(cols: dict) -> dict:
            n = [sum(map(known, pretokens(t.decode("utf-8", "replace")))) for t in cols["t"]]
            return {"k": cols["k"], "n_bytes": [len(t) for t in cols["t"]], "n_tokens": n,
                    "over_limit": [x > limit for x in n]}
        return step

    return map_rows(df, make, f"k {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("k", id_col)
