"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is cut recursively near its middle, the halves are encoded, and the results are
joined.  Two kinds of joint exist:

* Between a non-space and a white-space character.  No match of the pre-token pattern
  spans such a place, so the joint needs no repair: the ids are concatenated.
* Inside one pre-token.  A window of tokens around the joint is merged again; it doubles
  until the tokens next to it on both sides are *stable* beside its first and last token,
  that is until merging just the two tokens' bytes gives the two tokens back.  Every
  pair of neighbours in the result is then stable, which is enough for the whole: a merge
  across a token boundary would be, when it first happens, the lowest-ranked one in the
  two tokens alone as well.

Decoding concatenates byte strings up the same kind of tree.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineark.llm.common import Cache, as_bytes, map_rows

LEAF_BYTES = 24
BLOCK_CHARS = 1 << 15
CACHED_PIECES = 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its id per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class TreeCodec:
    """Encoder and decoder for one vocabulary; ``leaf`` bytes and ``block`` characters
    are where the two recursions stop (they change speed, never results)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF_BYTES,
                 block: int = BLOCK_CHARS, cached: int = CACHED_PIECES):
        import regex
        self.ranks, self.leaf, self.block = ranks, max(1, leaf), max(2, block)
        self.tokens = {i: t for t, i in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.joint = regex.compile(r"\S(?=\s)")
        self.pieces = Cache(lambda piece: self.piece(piece.encode("utf-8")), cached)
        self.stable = Cache(lambda ab: self.merge(self.tokens[ab[0]] + self.tokens[ab[1]]) == [*ab], cached)

    def merge(self, data: bytes) -> list[int]:
        """Merge the lowest-ranked neighbours (the leftmost of equals) until none is left."""
        if (whole := self.ranks.get(data)) is not None and len(data) == 1:
            return [whole]
        if len(data) > 64:
            return self._merge_heap(data)
        get, top = self.ranks.get, len(self.ranks) + 1
        cuts = list(range(len(data) + 1))
        cost = [get(data[i:i + 2], top) for i in range(len(data) - 1)]
        while cost and (low := min(cost)) < top:
            i = cost.index(low)
            del cuts[i + 1], cost[i]
            if i < len(cost):
                cost[i] = get(data[cuts[i]:cuts[i + 2]], top)
            if i:
                cost[i - 1] = get(data[cuts[i - 1]:cuts[i + 1]], top)
        return [self.ranks[data[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _merge_heap(self, data: bytes) -> list[int]:
        """The same merges with a heap of candidate pairs, for wide windows."""
        get, n = self.ranks.get, len(data)
        end, before, alive = list(range(1, n + 1)), list(range(-1, n)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if j >= n or end[j] != stop or not alive[j]:
                continue
            alive[j], end[i] = False, stop
            if stop < n:
                before[stop] = i
                if (r := get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (h := before[i]) >= 0 and (r := get(data[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        return [self.ranks[data[i:end[i]]] for i in range(n) if alive[i]]

    def piece(self, data: bytes) -> list[int]:
        """One pre-token: halves, then the joint."""
        if len(data) <= self.leaf:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.piece(data[:half]), self.piece(data[half:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring byte strings from their encodings."""
        if not left or not right:
            return left or right
        k = 1
        while True:
            a, b = max(0, len(left) - k), min(len(right), k)
            window = self.merge(b"".join(self.tokens[t] for t in left[a:] + right[:b]))
            if (a == 0 or self.stable[left[a - 1], window[0]]) and \
                    (b == len(right) or self.stable[window[-1], right[b]]):
                return left[:a] + window + right[b:]
            k *= 2

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if len(text) > self.block:
            half = len(text) // 2
            cut = self.joint.search(text, half)
            at = cut.end() if cut else max((m.end() for m in self.joint.finditer(text, 0, half)), default=0)
            if 0 < at < len(text):
                return np.concatenate([self.encode(text[:at]), self.encode(text[at:])])
        ids: list[int] = []
        for part in map(self.pieces.__getitem__, self.find(text)):
            ids += part
        return np.array(ids, dtype="<u4")

    def decode(self, ids: Sequence[int] | np.ndarray) -> bytes:
        """Bytes of the ids, concatenated up a tree of halves."""
        if len(ids) > self.block:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        return b"".join(map(self.tokens.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text.

    Returns one row per input row: the id column as it was, ``n_tokens`` LONG, ``ids``
    BINARY (the ids packed as little-endian unsigned 32-bit integers) and ``decoded``
    BINARY (the bytes that the ids decode to).  A null or empty text gives no ids and
    empty bytes; repeated rows are encoded each; other columns are ignored.  The rank
    file must be readable at ``ranks_path`` on every executor.  No shuffle; a worker
    keeps at most ``CACHED_PIECES`` encoded pre-tokens.
    """
    kind = dict(docs.dtypes)[id_col]

    def make():
        codec = TreeCodec(read_ranks(ranks_path), pattern)

        def step(cols: dict) -> dict:
            ids = [codec.encode(t.decode("utf-8", "replace")) for t in cols["t"]]
            return {"k": cols["k"], "n_tokens": [len(x) for x in ids], "ids": [x.tobytes() for x in ids],
                    "decoded": [codec.decode(x) for x in ids]}
        return step

    df = docs.select(F.col(id_col).alias("k"), as_bytes(F.col(text_col)).alias("t"))
    return map_rows(df, make, f"k {kind}, n_tokens long, ids binary, decoded binary").withColumnRenamed("k", id_col)


def decode(tokens: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Decode packed ids (see ``encode``): the id column and ``decoded`` BINARY; null ids give empty bytes."""
    kind = dict(tokens.dtypes)[id_col]

    def make():
        codec = TreeCodec(read_ranks(ranks_path), r"\S+")
        return lambda cols: {"k": cols["k"], "decoded": [codec.decode(np.frombuffer(x, "<u4")) for x in cols["x"]]}

    df = tokens.select(F.col(id_col).alias("k"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("x"))
    return map_rows(df, make, f"k {kind}, decoded binary").withColumnRenamed("k", id_col)
