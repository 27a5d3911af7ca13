"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct word n-grams, each a 64-bit hash; the global order is the
order of the hashes.  That order is cut into fragments twice:

* **Candidates.**  Sets of similar size use the same cut.  If two sets link, at most ``H``
  n-grams are in only one of them, so with more than ``H`` fragments at least one fragment
  holds the same n-grams in both.  Each set sends a hash of every fragment that is not
  empty; linked sets share one.  (If the only equal fragments were empty, every non-empty
  fragment of both sets would differ, so both would have at most ``H`` of them; such rare
  sets also send the n-grams of their prefix, which finds those pairs.)  No n-gram
  frequency is needed, and a passage that many documents share makes no bucket unless it
  fills a whole fragment.
* **Verification.**  Each candidate pair's overlap is counted apart in every one of
  ``PARTS`` fragments and summed per pair; the exact Jaccard test follows.

Between the two, exact filters thin the candidates out.  A set that links with any other
shares at least (fragments - H) of its non-empty fragments with it, so a set with fewer shared
fragments goes.  Among the sets that stay, n-grams are ordered by how many sets hold them,
rare ones first, and only a set's prefix in that order makes buckets; positions in it
bound a pair's overlap before it is counted.

Documents with equal sets form one class and are never paired.  A bucket never emits all
its pairs: signature rows are range-partitioned by (bucket, class), so a hot bucket is split
over tasks, and a bucket's classes meet a few centres only, those with the fewest n-grams of
their own.  Classes that are linked need no further comparison, so each round takes only
buckets whose members are still in different components, with more centres per bucket,
until none is left.  No link between components is lost, and no cap is involved.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineark.llm.common import Cache, as_bytes, discard, map_rows, stored, with_row

PARTS = 8
#: bits of the map-side filter that keeps only candidates' texts for verification
FILTER_BITS = 1 << 25
#: centres per bucket in the first round; each later round takes ``MORE`` times as many
CENTRES, MORE = 1, 16
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x + _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct n-gram hashes of a text's words."""

    def __init__(self, width: int):
        import xxhash
        self.width = width
        self.hash = Cache(xxhash.xxh3_64_intdigest, 300_000).__getitem__
        self.odd = _mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)

    def __call__(self, data: bytes) -> np.ndarray:
        words = data.lower().split()    # bytes: A-Z only; splits at 0x20 and 0x09-0x0D
        h = np.fromiter(map(self.hash, words), np.uint64, len(words))
        n = min(self.width, len(words))
        if not n:
            return h
        end = len(words) - n + 1
        x = reduce(np.add, (h[i:i + end] * self.odd[i] for i in range(n)))
        return np.unique(_mix(x + np.uint64(n)))


class Cuts:
    """The candidate cut for each size class, for Jaccard >= num/den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.start = [1]
        while self.start[-1] < 1 << 40:
            self.start.append(self.start[-1] * den * den // (num * num) + 1)
        top = [(s - 1) for s in self.start[1:]]
        self.apart = [(den - num) * (2 * s * den // (den + num)) // den for s in top]
        #: low bits of a fragment's hash, which hold the number of its cut
        self.bits = len(self.start).bit_length()
        self.start = np.array(self.start)

    def schemes(self, size: int) -> list[int]:
        """Size classes whose cut a set of ``size`` takes: its own, and the next if a linked
        set can be that large."""
        k = int(np.searchsorted(self.start, size, "right")) - 1
        return [k, k + 1] if size * self.den // self.num >= self.start[k + 1] else [k]

    def signatures(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Fragment hashes, whose low bits name their cut, and the quota of each cut: its number * 2**32 +
        how many of the set's hashes in this cut any linked set shares at least."""
        out, quota = [], []
        tag = lambda h, k: h >> np.uint64(self.bits) << np.uint64(self.bits) | np.uint64(k)
        for k in self.schemes(len(x)):
            h = self.apart[k]
            if not h:                   # such small sets link only if they are equal
                continue
            n = h + 3 + h // 8
            at = ((x >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            name = _mix(at[first] + np.uint64(k << 40))
            out.append(tag(_mix(np.add.reduceat(_mix(x), first) ^ name), k))
            quota.append((k << 32) + max(1, len(first) - h))
            if len(first) <= h:
                keep = len(x) - -(-self.num * len(x) // self.den) + 1
                out.append(tag(_mix(x[:keep] ^ _mix(np.uint64([k + (1 << 50)]))), k))
        return (np.concatenate(out), quota) if out else (x[:0], [])


def _class_of(x: np.ndarray) -> int | None:
    return int(_mix(np.add.reduce(_mix(_mix(x)), keepdims=True) + np.uint64(len(x)))[0].astype(np.int64)) if len(x) else None


def _sets(df: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(doc_id, doc_hash, n, cid, sig, quota) of every row; cid names the set, NULL for an empty one.
    ``sig`` and ``quota`` are the class's fragment hashes and its cuts' quotas, NULL where the task gave them before."""
    def make():
        grams, cuts, seen = Shingler(width), Cuts(num, den), set()

        def step(cols):
            x = [grams(t) for t in cols["t"]]
            out = {"doc_id": cols["doc_id"], "doc_hash": cols["doc_hash"], "n": [len(v) for v in x],
                   "cid": [_class_of(v) for v in x], "sig": [], "quota": []}
            for v, c in zip(x, out["cid"]):
                sig = quota = None
                if c is not None and c not in seen:
                    seen.add(c)
                    sig, quota = cuts.signatures(v)
                    sig = sig.astype(np.int64)
                out["sig"].append(sig)
                out["quota"].append(quota)
            return out
        return step
    return map_rows(df, make, f"doc_id {dict(df.dtypes)['doc_id']}, doc_hash long, n long, cid long, sig array<long>, quota array<long>")


def _shared(batches):
    """Of rows (sig, cid) sorted by both: those of buckets with several classes, each class
    once; and those of the first and the last bucket of a partition, which may go on elsewhere."""
    import pyarrow as pa
    names, carry, opened = ["sig", "cid"], None, None

    def rows(cols, take):
        return pa.RecordBatch.from_arrays([pa.array(c[take]) for c in cols], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy() for i in range(2)]
        if carry is not None:           # the last row, and whether it was given out already
            cols = [np.concatenate((c, v)) for c, v in zip(carry[0], cols)]
        new = np.concatenate(([True], (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])))
        given = carry is not None and carry[1]
        at = np.flatnonzero(new)        # each class of each bucket once
        sig = cols[0][at]
        near = sig[1:] == sig[:-1]
        several = np.concatenate(([False], near)) | np.concatenate((near, [False]))
        if opened is None:
            opened = sig[0]
        several |= sig == opened
        if given:
            several[0] = False
        last_given = several[-1] or (given and len(at) == 1)
        if several.any():
            yield rows(cols, at[several])
        carry = ([c[at[-1]:at[-1] + 1] for c in cols], last_given)
    if carry is not None and not carry[1]:
        yield rows(carry[0], slice(None))


def _slots(col) -> F.Column:
    return F.pmod(F.xxhash64(col), F.lit(FILTER_BITS))


def _tokens(df: DataFrame, wanted: DataFrame, sets: DataFrame, width: int) -> DataFrame:
    """(cid, part, grams): the n-grams of the wanted classes, cut into ``PARTS`` fragments.

    One document of each wanted class is read again.  Which ones is told to the tasks
    by a bitmap of fixed size; documents that only share a bit add unused rows.
    """
    spark = df.sparkSession
    one = sets.join(wanted, "cid", "left_semi").groupBy("cid").agg(F.min("doc_id").alias("doc_id"))
    slot = _slots(F.col("doc_id"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in (one.select((slot + 1).alias("s")).groupBy(F.bitmap_bucket_number("s").alias("b"))   # counted from 1
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m")).toLocalIterator()):
        at = (r["b"] - 1) * len(r["m"])
        bits[at:at + len(r["m"])] = np.frombuffer(r["m"], np.uint8)
    shared = spark.sparkContext.broadcast(bits)

    def make():
        grams, on, seen = Shingler(width), shared.value, set()

        def step(cols):
            cid, part, out = [], [], []
            for t, s in zip(cols["t"], cols["s"]):
                if not on[s >> 3] >> (s & 7) & 1:
                    continue
                x = grams(t)
                c = _class_of(x)
                if c is None or c in seen:
                    continue
                seen.add(c)
                at = ((x >> np.uint64(32)) * np.uint64(PARTS)) >> np.uint64(32)
                edge = np.searchsorted(at, np.arange(PARTS + 1, dtype=np.uint64))
                for p in range(PARTS):
                    cid.append(c)
                    part.append(p)
                    out.append(x[edge[p]:edge[p + 1]].astype(np.int64))
            if cid:
                return {"cid": cid, "part": part, "grams": out}
        return step

    rows = map_rows(df.select("t", slot.alias("s")), make, "cid long, part int, grams array<long>")
    return rows.groupBy("cid", "part").agg(F.first("grams").alias("grams"))


def _verified(pairs: DataFrame, tokens: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, na, b, nb) that link: partial overlaps per fragment, summed per pair."""
    split = pairs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    left = tokens.select(F.col("cid").alias("a"), "part", F.col("grams").alias("x"))
    right = tokens.select(F.col("cid").alias("b"), "part", F.col("grams").alias("y"))
    both = split.join(left, ["a", "part"]).join(right, ["b", "part"])
    same = both.select("a", "b", "na", "nb", F.size(F.array_intersect("x", "y")).cast("long").alias("i"))
    total = same.groupBy("a", "b", "na", "nb").agg(F.sum("i").alias("i"))
    return total.where(F.col("i") * den >= num * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): (cid, comp), comp the smallest node reachable.

    Alternates star contraction steps until nothing changes; each step is a grouped
    minimum and a join, written to the shared folder in the place of the step before.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select("u", F.col("m").alias("v")).union(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        before, e = e, stored(small.distinct(), "edges")
        discard(before)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            comps = e.select(F.col("u").alias("cid"), F.col("v").alias("comp"))
            comps.stored_at = e.stored_at
            return comps
        state = now


def _candidates(members: DataFrame, quotas: DataFrame, bits: int) -> DataFrame:
    """The rows (sig, cid) of buckets with several classes, of classes that have as many of them as the
    quota of the cut asks; applied until a pass removes few rows (it only ever removes rows that
    can't matter)."""
    count, before = None, None
    cut = F.col("sig").bitwiseAND(F.lit((1 << bits) - 1)).alias("cut")
    while True:
        several = members.groupBy("sig").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo <> hi").select("sig")
        kept = members.join(several, "sig", "left_semi").select("sig", "cid", cut)
        enough = kept.groupBy("cid", "cut").agg(F.count("*").alias("k")).join(quotas, ["cid", "cut"]).where("k >= quota").select("cid", "cut")
        members = stored(kept.join(enough, ["cid", "cut"], "left_semi").select("sig", "cid"), "members")
        if before is not None:
            discard(before)
        before, last, count = members, count, members.count()
        if count == 0 or last is not None and count > 0.9 * last:
            return members


def _prefixes(tokens: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """(sig, cid, n, pos): the n-grams of each class's prefix that other classes hold too; ``pos`` is the
    n-gram's place, from 1, in the class's n-grams ordered by number of classes and hash."""
    one = tokens.select("cid", F.explode("grams").alias("sig"))
    held = one.groupBy("sig").agg(F.count("*").alias("df")).where("df > 1")
    listed = one.join(held, "sig").groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("x"))   # one text's own
    place = listed.join(classes, "cid").select("cid", "n", F.posexplode("x").alias("i", "x"), (F.col("n") - F.size("x")).alias("own"))
    place = place.select("x.sig", "cid", "n", (F.col("own") + F.col("i") + 1).alias("pos"))
    return place.where(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * num / den) + 1)


def _grouped(docs: DataFrame, width: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, doc_hash, n, g) of every row; g names its component, NULL for an empty set."""
    spark = docs.sparkSession
    df = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(id_col, text_col).alias("doc_hash"), as_bytes(F.col(text_col)).alias("t"))
    full = stored(_sets(df, width, num, den), "sets")
    sets = stored(full.drop("sig", "quota"), "rows")
    low = F.col("q").bitwiseAND(F.lit((1 << 32) - 1))
    quotas = stored(full.select("cid", F.explode("quota").alias("q")).select("cid", F.shiftright("q", 32).alias("cut"), low.alias("quota")).distinct(), "quotas")

    # from the table, so that the range sampler's extra pass does not read the texts again
    sigs = full.select(F.explode("sig").alias("sig"), "cid")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    shared = stored(sigs.repartitionByRange(parts, "sig", "cid").sortWithinPartitions("sig", "cid").mapInArrow(_shared, "sig long, cid long"), "shared")
    discard(full)
    members = _candidates(shared.distinct(), quotas, Cuts(num, den).bits)
    sizes = sets.join(members, "cid", "left_semi").select("cid", "n").distinct()
    classes = stored(sizes, "classes")
    discard(shared, members, quotas)
    tokens = stored(_tokens(df, classes.select("cid"), sets, width), "tokens")

    live = stored(_prefixes(tokens, classes, num, den), "prefixes")
    discard(classes)
    comps = spark.createDataFrame([], "cid long, comp long")
    tested = links = None
    centres, used, left_over = CENTRES, live, []
    while True:
        named = live.join(comps, "cid", "left").select("sig", "cid", "n", "pos", F.coalesce("comp", "cid").alias("comp"))
        split = named.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("sig")
        live = stored(named.join(split, "sig", "left_semi"), "live")
        discard(used, *left_over)
        used = live
        if live.isEmpty():
            break
        salt = F.pmod(F.xxhash64("cid", F.lit(centres)), F.lit(centres))
        centre = stored(live.groupBy("sig", salt.alias("salt")).agg(F.min(F.struct("pos", "cid", "n", "comp")).alias("c")).select("sig", "c"), "centres")
        # what is left of both sets at this n-gram bounds the overlap of a pair that first meets here
        needed = F.ceil((F.col("n") + F.col("c.n")) * num / (num + den))
        left = F.least(F.col("n") - F.col("pos"), F.col("c.n") - F.col("c.pos")) + 1
        smaller = F.col("c.cid") < F.col("cid")
        pairs = live.join(centre, "sig").where(F.col("comp") != F.col("c.comp")).where(left >= needed).select(
            F.least("c.cid", "cid").alias("a"), F.when(smaller, F.col("c.n")).otherwise(F.col("n")).alias("na"),
            F.greatest("c.cid", "cid").alias("b"), F.when(smaller, F.col("n")).otherwise(F.col("c.n")).alias("nb")).distinct()
        pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs.select("a", "na", "b", "nb"), "pairs")
        left_over, found = [centre], None
        if not pairs.isEmpty():
            found = stored(_verified(pairs, tokens, num, den), "links")
            tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))
        if found is not None and not found.isEmpty():
            links = found if links is None else links.union(found)
            if hasattr(comps, "stored_at"):
                left_over.append(comps)
            comps = components(links)
        live = live.join(centre.select("sig", F.col("c.cid").alias("cid")), ["sig", "cid"], "left_anti").select("sig", "cid", "n", "pos")
        centres *= MORE
    discard(live, tokens)
    return sets.join(comps, "cid", "left").select("doc_id", "doc_hash", "n", F.coalesce("comp", "cid").alias("g"))


def ngram_join(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Classes of documents joined by links: two documents link when the Jaccard similarity
    of their n-gram sets is at least ``num/den``.

    Words are runs outside white space, A-Z lower-cased; a text with fewer than ``width``
    words has its whole sequence as its one n-gram; without words (or null) it is empty and
    links with nothing.  Returns one row per input row: the id column, ``n_shingles`` LONG
    (set size), ``component_id`` (smallest id reachable by links, itself included).  Rows
    that share an id are each kept and take the smallest component of the rows with their
    own set; a null id never names a component unless all its ids are null.  Other columns
    are ignored.  N-grams and sets are told apart by 64-bit hashes.
    """
    named = _grouped(docs, width, num, den, id_col, text_col)
    least = named.where("g is not null").groupBy("g").agg(F.min("doc_id").alias("low"))
    return named.join(least, "g", "left").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("low", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row per component (that of the smallest id that is not null), all columns as
    they are.  Rows without words all stay, but of rows with equal id and text one stays."""
    named = _grouped(docs, width, num, den, id_col, text_col)
    first = named.where("g is not null").groupBy("g").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "doc_hash")).alias("x"))
    kept = first.select(F.col("x.doc_hash").alias("hash")).union(named.where("g is null").select(F.col("doc_hash").alias("hash"))).distinct()
    keyed = with_row(docs, hash=F.xxhash64(id_col, text_col))
    return keyed.join(kept, "hash", "left_semi").dropDuplicates(["hash"]).select("row.*")
