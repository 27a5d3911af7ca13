"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only.

A mask such as ``11011011`` keeps some word positions of a window and ignores the others,
so a window still hashes alike after a word at an ignored place was exchanged.  Every
window of every benchmark item is hashed under each mask.  A training document's windows
are first tested, inside the scan, against bitmaps of fixed size made from the benchmark (its
word pairs, then its first three kept words, then its masked windows); only the few that pass
become rows and are joined with the benchmark's hashes.  Around each joined hit the two texts are
compared word by word at the hit's alignment: the hit counts when some run of ``run``
aligned words (the whole item, if shorter) has at least ``similarity`` of its words equal.
Items of fewer than ``LEAST`` words have no spaced seed: their seed is the whole item.

Each character of a script without blanks between words counts as a word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineark.llm.common import ascii_lower, with_row

#: all masks keep their first two positions, which the word-pair test uses; however two words of a run of
#: 13, or every fifth word of a longer one, are exchanged, one of these finds a seed
MASKS = ("11011011", "1110100111", "1101111")
#: besides, for items shorter than a run: with them every exchange that ``similarity`` allows in 8 to 12 words leaves a seed
SHORT_MASKS = ("110111", "110001011")
LEAST = 8
RUN = 13
SIMILARITY = 0.8
#: bits of each bitmap, about 16 for each benchmark window; with fewer, more windows pass to the
#: join, and none is lost
BITMAP_BITS = 1 << 18
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Thai, Lao, Myanmar, Khmer, kana and Han (with its later planes)
UNSPACED = r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3005-\u3007\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]"


def _word_hashes(text: Column) -> Column:
    """Hashes of the words (runs outside ASCII non-alphanumerics, A-Z lower-cased; single characters in
    scripts without blanks)."""
    spaced = F.when(text.rlike(UNSPACED), F.regexp_replace(text, UNSPACED, " $0 ")).otherwise(text)
    return F.transform(F.filter(F.split(ascii_lower(spaced), _BREAK), lambda w: w != ""), lambda w: F.xxhash64(w))


def _at(h: Column, i: Column, mask: str) -> Column:
    """Hash of the kept positions of the window that starts at 0-based ``i``."""
    return F.xxhash64(*(F.get(h, i + k) for k, c in enumerate(mask) if c == "1"), F.lit(mask))


def _bitmap(values: DataFrame, bits: int) -> Column:
    """Scalar subquery: ``bits`` flags as ARRAY<BOOLEAN>, those at ``_place`` set for each value ``v``."""
    words = values.select(_place(F.col("v"), bits).alias("at")).groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, at & 63)")).alias("b"))
    full = values.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("w")).join(words, "w", "left").select("w", F.coalesce("b", F.lit(0)).alias("b"))
    flags = lambda x: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda p: F.getbit(x["b"], p) == 1)
    return full.groupBy().agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), flags)).alias("bits")).scalar()


def _place(v: Column, bits: int) -> Column:
    """A hash's place in the bitmap."""
    return v.bitwiseAND(F.lit(bits - 1)).cast("int")


def _in(bitmap: str, v: Column, bits: int) -> Column:
    return F.coalesce(F.get(bitmap, _place(v, bits)), F.lit(False))


def masks_of(n: int, masks: Sequence[str] = MASKS, run: int = RUN) -> tuple[str, ...]:
    """The masks whose seeds an item of ``n`` words has."""
    if n < LEAST:
        return ("1" * n,)
    return (*masks, *(SHORT_MASKS if n < run else ()))


def _windows(h: Column, mask: str) -> Column:
    """Start positions at which the mask fits; NULL if there is none (a sequence would run backwards)."""
    last = F.size(h) - len(mask)
    return F.when(last >= 0, F.sequence(F.lit(0), last))


def _third(mask: str) -> int | None:
    """Offset of a mask's third kept word."""
    kept = [k for k, c in enumerate(mask) if c == "1"]
    return kept[2] if len(kept) > 2 else None


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: Sequence[str] = MASKS, run: int = RUN,
             similarity: float = SIMILARITY, bitmap_bits: int = BITMAP_BITS, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Verified overlaps: one row per document and benchmark item,
    ``doc_id, doc_hash, item_id, n_hits, n_matched, first_word``.

    ``doc_hash`` is a hash of id and text, so rows that share an id stay apart; ``n_hits``
    counts seed hits that were verified, ``n_matched`` is the most equal words in a compared
    run, ``first_word`` the first hit's word position.  An item of fewer than ``LEAST`` words matches
    where all of it stands.  Repeated rows give one row.  Null or empty texts, on either side, match
    nothing.  Ids may be null.  Other columns are ignored.  Benchmark items may repeat.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), _word_hashes(F.col(item_text_col)).alias("q")).where(F.size("q") > 0)
    # the items' lengths, those from a run on as one; each mask is kept for the lengths that use it
    lengths = sorted(r["n"] for r in items.select(F.least(F.size("q"), F.lit(run)).alias("n")).distinct().collect())
    users: dict[str, list[int]] = {mask: [] for mask in masks}
    for n in lengths:
        for mask in masks_of(n, masks, run):
            users.setdefault(mask, []).append(n)
    masks = list(users)
    if any(not (mask + "1").startswith("11") for mask in masks):
        raise ValueError("masks keep their first two words")
    span = max(map(len, masks))
    seeds = None
    for mask in masks:
        mine = items.where(F.least(F.size("q"), F.lit(run)).isin(users[mask]))
        one = (mine.select("item_id", "q", F.explode(_windows(F.col("q"), mask)).alias("p"))
               .select("item_id", "q", "p", F.lit(mask).alias("mask"), _at(F.col("q"), F.col("p"), mask).alias("seed")))
        seeds = one if seeds is None else seeds.union(one)
    seeds = seeds.distinct()
    kept = lambda h, i, *offsets: F.xxhash64(*(F.get(h, i + k) for k in offsets))
    of_item = lambda mine, *offsets: _bitmap(seeds.where(F.col("mask").isin(mine)).select(kept(F.col("q"), F.col("p"), *offsets).alias("v")), bitmap_bits)
    seed_bits = _bitmap(seeds.select(F.col("seed").alias("v")), bitmap_bits)

    # each step is a column of its own, so that no hash is computed twice; nothing is filtered between
    # them, as a filter would be moved below and compute its column once more
    steps = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(id_col, text_col).alias("doc_hash"), _word_hashes(F.col(text_col)).alias("h"))
    pairs = F.zip_with("h", F.slice("h", F.lit(2), F.greatest(F.size("h") - 1, F.lit(0))), lambda a, b: _in("pair_bits", F.xxhash64(a, b), bitmap_bits))
    groups: dict[int | None, list[str]] = {}
    for mask in masks:
        if len(mask) > 1:
            groups.setdefault(_third(mask), []).append(mask)
    steps = steps.withColumn("pair_bits", of_item([m for m in masks if len(m) > 1], 0, 1)).withColumn("pairs", pairs)
    found = F.filter(F.transform("pairs", lambda v, i: F.when(v, i)), lambda i: i.isNotNull())
    steps = steps.select("doc_id", "doc_hash", "h", F.when(F.array_contains("pairs", True), found).otherwise(F.array().cast("array<int>")).alias("at"))
    starts = {None: "at"}
    for third, mine in groups.items():
        if third is not None:
            starts[third] = f"at{third}"
            steps = steps.withColumn("bits", of_item(mine, 0, 1, third)).withColumn(
                f"at{third}", F.filter("at", lambda i: _in("bits", kept(F.col("h"), i, 0, 1, third), bitmap_bits)))  # noqa: B023
    if "1" in masks:
        steps = steps.withColumn("bits", of_item(["1"], 0)).withColumn("single", F.filter(
            F.transform("h", lambda v, i: F.when(_in("bits", F.xxhash64(v), bitmap_bits), i)), lambda i: i.isNotNull()))
    steps = steps.withColumn("bits", seed_bits)
    around = run - 1
    seeded = []
    for mask in masks:
        at = "single" if mask == "1" else starts[_third(mask)]
        fits = F.filter(at, lambda i: i + len(mask) <= F.size("h"))  # noqa: B023
        seed = F.transform(fits, lambda i: F.struct(i.alias("i"), _at(F.col("h"), i, mask).alias("seed")))  # noqa: B023
        # a fixed number of words on both sides of the hit travels with it
        seeded.append(F.transform(F.filter(seed, lambda x: _in("bits", x["seed"], bitmap_bits)), lambda x: F.struct(
            x["i"].alias("i"), x["seed"].alias("seed"), F.greatest(x["i"] - around, F.lit(0)).alias("from"),
            F.slice("h", F.greatest(x["i"] - around, F.lit(0)) + 1, F.lit(2 * around + span)).alias("d"))))
    hits = steps.select("doc_id", "doc_hash", F.explode(F.concat(*seeded)).alias("hit")).select("doc_id", "doc_hash", "hit.*")
    joined = hits.join(seeds.drop("mask"), "seed")

    # item word k stands against document word i + k - p; compare run after run that covers the seed's neighbourhood
    size = F.size("q")
    length = F.least(F.lit(run), size)
    low = F.greatest(F.lit(0), F.col("p") - around)
    high = F.least(size, F.col("p") + span + around)
    equal = F.transform(F.sequence(low, high - 1), lambda k: F.coalesce(
        F.when(F.col("i") + k - F.col("p") >= F.col("from"), (F.get("q", k) == F.get("d", F.col("i") + k - F.col("p") - F.col("from"))).cast("int")), F.lit(0)))
    compared = joined.select("doc_id", "doc_hash", "item_id", "i", length.alias("len"), equal.alias("m"))
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.size("m") - F.col("len") + 1), lambda s: F.aggregate(
        F.slice("m", s, F.col("len")), F.lit(0), lambda a, b: a + b)))
    scored = compared.select("doc_id", "doc_hash", "item_id", "i", "len", best.alias("best"))
    return (scored.where(F.col("best") >= F.col("len") * similarity)
            .groupBy("doc_id", "doc_hash", "item_id")
            .agg(F.countDistinct("i").alias("n_hits"), F.max("best").cast("long").alias("n_matched"), F.min("i").cast("long").alias("first_word")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with no verified overlap (see ``overlaps``), all columns as they are.
    Clean rows all stay, repeated ones too; every copy of a contaminated row goes."""
    found = overlaps(docs, benchmark, id_col=id_col, text_col=text_col, **options).select(F.col("doc_hash").alias("hash")).distinct()
    return with_row(docs, hash=F.xxhash64(id_col, text_col)).join(found, "hash", "left_anti").select("row.*")
