"""Secret scan: candidates by pattern, false positives removed by a random forest, with
DataFrame functions and Spark's own trees only.

Features of a candidate: its length and character classes, its character transitions (how
likely its neighbouring characters are in the corpus's own dictionary words, and how
often the class of character changes), how much of it dictionary words cover, its
document's path, and the words beside it.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineark.llm.common import per_label, stored, with_row

#: most labelled findings that training reads; those of each label with the smallest hashes
TRAIN_ROWS = 20_000
TREES, DEPTH = 24, 7
# Names that often stand before a secret, and words that mark a sample.
_NAME = r"pass[ _-]?(?:word|wd|phrase|code|key)?|pwd|secret(?:[ _-]?key)?|token|(?:api|access|private)[ _-]?key|auth(?!or)|credential"
NAMES = rf"(?i)(?:{_NAME})s?"
_SIGN = r"[\"'`\]]*+[ \t]*+(?::=|=>|==|[:=>])[ \t]*+"


def _set(names: str) -> str:
    """An identifier that holds a name (at its end or before ``_``, ``-`` or a digit) and a sign.  It is entered at the
    identifier's start only, and its loops are possessive, so that the time is linear however long identifiers
    and blanks are."""
    return rf"(?<![\w\-])(?=[\w\-]*?(?i:{names})(?i:s?)(?![A-Za-z]))[\w\-]++(?: (?i:key|word|wd|phrase|code)s?[\w\-]*+)?{_SIGN}"


_SET = _set(_NAME)
_LEAST, _LEAST_CODED = 6, 12
_END = r"\\?[\"'`](?:[\s,;:)\]}>]|\z)"
_QUOTED = lambda q: rf"(?<={q})(?=(?:[^{q}\\\r\n]|\\.){{{_LEAST}}})[^{q}\\\r\n]*+(?:\\.[^{q}\\\r\n]*+)*+(?={q})"
#: what stands before a value, and the value
FORMS = (
    # a whole private key; without its end, the lines that follow
    ("", r"-{4,5} ?BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)? ?-{4,5}(?:(?>[\s\S]*?-{4,5}) ?END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)? ?-{4,5}"
         r"|(?:(?:\s|\\[nr])*+[A-Za-z0-9+/]{16,}+={0,2})++)"),
    # a password in a URL
    (r"://[^\s/:@]*+:", r"[^\s/\"'<>]+(?=@[^\s@])"),
    # quoted or not, what a secret's name is set to (but not another name that is set itself)
    (_SET + r"[\"'`]?+", "|".join(map(_QUOTED, "\"'`"))
     + rf"|(?![\"'`])(?!{_SET})(?:(?![;&,][\w.\-]{{1,40}}=|[.,;:)\]}}]{{1,3}}(?:\s|\z)|</|{_END})\S){{{_LEAST},}}+"),
    # common encodings, one character of them a digit, that are not a name which is set
    ("", rf"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9])(?!{_SET})[A-Za-z0-9+/_\-]{{{_LEAST_CODED},}}={{0,2}}"),
)
_FORM = "|".join(f"({before})({value})" for before, value in FORMS)
#: three noncharacters, put before what stands before a value, before the value and after it
_MARKS = "\uFDD0\uFDD1\uFDD2"
_MARKED = _MARKS[0] + "".join(f"${2 * i + 1}" for i in range(len(FORMS))) + _MARKS[1] + "".join(f"${2 * i + 2}" for i in range(len(FORMS))) + _MARKS[2]
PEM = r"\A-{4,5} ?BEGIN "
IN_URL = r"://[^\s/:@]*:\z"
#: what stands where a value will be filled in, or code that gets it
UNFILLED = r"(?i)\A(?:[$%]?[{(<\[]|%\w+%|\$\w+\z|[*.x]+\z|(?:none|null|true|false|undefined|password|secret)\z)|\A[\w.]+[(\[]"
SAMPLES = r"(?i)(example|sample|dummy|placeholder|changeme|xxxx|test|todo|your[_-])"
_CLASSES = ("[a-z]", "[A-Z]", "[0-9]")


def _pieces(text: Column) -> Column:
    """A text cut behind each candidate: every piece but the last ends in one.  One pass over the text."""
    return F.split(F.regexp_replace(F.translate(text, _MARKS, "\uFFFD" * 3), _FORM, _MARKED), _MARKS[2], -1)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """One row per candidate: ``doc_id, doc_hash, i, start, end, value, before, left_word,
    right_word, path``.  ``i`` counts a document's candidates from 0; ``start`` and ``end`` are
    character positions.  ``doc_hash`` is a hash of id and text; repeated rows repeat.

    Candidates are whole private keys, passwords in URLs, at least 6 characters that a secret's name
    is set to, and at least 12 characters of common encodings with a digit.  What stands before a value
    may be of any length.  ``before`` is what belongs to the candidate's form (name, sign, quote) and 80
    characters before that; ``right_word`` is the next word if it begins within 40 characters."""
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(id_col, text_col).alias("doc_hash"),
                      F.coalesce(path, F.lit("")).alias("path"), _pieces(text).alias("piece"))
    ends = F.transform(F.slice("piece", F.lit(2), F.size("piece") - 1), lambda p: F.left(F.substring_index(p, _MARKS[0], 1), F.lit(40)))
    each = cut.select("row", "doc_id", "doc_hash", "path", F.posexplode(F.arrays_zip(F.slice("piece", F.lit(1), F.size("piece") - 1).alias("p"), ends.alias("after"))).alias("i", "c"))
    part = lambda c, mark, at: F.substring_index(c, mark, at)
    split = each.select("row", "doc_id", "doc_hash", "path", F.col("i").cast("long").alias("i"), part(F.col("c.p"), _MARKS[0], 1).alias("gap"),
                        part(part(F.col("c.p"), _MARKS[0], -1), _MARKS[1], 1).alias("form"), part(F.col("c.p"), _MARKS[1], -1).alias("value"), F.col("c.after").alias("after"))
    # positions: a running sum over the candidates of one input row
    up = F.sum(F.length("gap") + F.length("form") + F.length("value")).over(Window.partitionBy("row").orderBy("i")).cast("long")
    beside = split.select("doc_id", "doc_hash", "path", "i", "value", "after", up.alias("end"), F.concat(F.right("gap", F.lit(80)), "form").alias("before"))
    word = lambda c, at: F.lower(F.regexp_extract(c, at, 1))
    return beside.select("doc_id", "doc_hash", "i", (F.col("end") - F.length("value")).alias("start"), "end", "value", "before",
                         word(F.col("before"), r"(?<![\p{L}\p{N}_\-])([\p{L}\p{N}_\-]+)[^\p{L}\p{N}_\-]*\z").alias("left_word"),
                         word(F.col("after"), r"\A[^\p{L}\p{N}_\-]*([\p{L}\p{N}_\-]+)").alias("right_word"), "path")


def _pairs(word: Column) -> Column:
    """Neighbouring characters of a lower-cased word, digits as one class, with its edges."""
    w = F.concat(F.lit("^"), F.regexp_replace(F.lower(word), "[0-9]", "0"), F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substring(w, i, F.lit(2)))


def dictionary(docs: DataFrame, parts: DataFrame, text_col: str = "text") -> DataFrame:
    """How often each of ``parts.word`` stands as a word of the corpus: ``word``, ``n``.

    All documents are counted; partial counts are made before the only shuffle.  A word is a run
    of letters between other characters, lower-cased; it counts only where it is not part of
    a longer run of letters and digits.
    """
    words = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[^\p{L}\p{N}]+")).alias("word"))
    return parts.join(words.groupBy("word").agg(F.count("*").alias("n")), "word")


def _count(s: Column, pattern: str) -> Column:
    return (F.length(s) - F.length(F.regexp_replace(s, pattern, ""))).cast("double")


def features(found: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``found`` (distinct contexts of candidates) with the feature vector ``x``."""
    values = found.select("value").distinct()
    split = values.select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit(r"[a-z]{3,}"), 0)).alias("word"))
    split = stored(split, "parts")
    known = stored(dictionary(docs, split.select("word").distinct(), text_col), "dictionary")
    cover = split.join(known, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"), F.max("n").alias("most"))

    # transitions: log share of each pair of characters among the dictionary's words
    pairs = known.select(F.explode(_pairs(F.col("word"))).alias("pair"), F.log1p("n").alias("n")).groupBy("pair").agg(F.sum("n").alias("n"))
    first = pairs.groupBy(F.substring("pair", 1, 1).alias("c")).agg(F.sum("n").alias("all"))
    likely = pairs.join(first, F.substring("pair", 1, 1) == F.col("c")).select("pair", F.log((F.col("n") + 0.1) / (F.col("all") + 4)).alias("logp"))
    own = values.select("value", F.explode(_pairs(F.col("value"))).alias("pair"))
    moves = own.join(likely, "pair", "left").groupBy("value").agg(F.avg(F.coalesce("logp", F.lit(-6.0))).alias("transition"))

    n = F.length("value").cast("double")
    v = F.col("value")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, _CLASSES[0], "\u0001"), _CLASSES[1], "\u0002"), _CLASSES[2], "\u0003")
    changes = F.length(F.regexp_replace(kinds, r"(.)\1*", "$1")).cast("double") / n
    flags = lambda c, salt: [F.getbit(F.xxhash64(c, F.lit(salt)), F.lit(k)).cast("double") for k in range(5)]
    named = F.concat_ws(" ", "left_word", F.right("before", F.lit(24)))
    wide = found.join(cover, "value", "left").join(moves, "value", "left")
    return wide.withColumn("x", array_to_vector(F.array(
        n, *(_count(v, c) / n for c in _CLASSES), _count(v, "[^A-Za-z0-9]") / n, (~v.rlike("[^0-9a-fA-F]")).cast("double"),
        changes, F.size(F.array_distinct(F.split(v, ""))).cast("double") / F.least(n, F.lit(40.0)),
        F.coalesce("transition", F.lit(-6.0)), F.coalesce(F.col("covered") / n, F.lit(0.0)), F.log1p(F.coalesce("most", F.lit(0)).cast("double")),
        named.rlike(NAMES).cast("double"), v.rlike(PEM).cast("double"), F.col("before").rlike(IN_URL).cast("double"), v.rlike(UNFILLED).cast("double"), F.col("before").rlike(r"[:=]\s*[\"']?\z").cast("double"), F.col("before").rlike(r"[\"']\z").cast("double"),
        F.concat_ws(" ", v, "left_word").rlike(SAMPLES).cast("double"), F.length("left_word").cast("double"), F.length("right_word").cast("double"),
        F.col("path").rlike(SAMPLES).cast("double"), F.length("path").cast("double"), _count(F.col("path"), "[/.]"),
        *flags("left_word", "l"), *flags("right_word", "r"), *flags("path", "p"))))


def rule_labels(found: DataFrame) -> DataFrame:
    """Labelled findings from public rules, for corpora without reviewed ones: ``label`` 1 for a
    whole private key, a value in a vendor's key format, a password in a URL, or letters mixed with
    other characters assigned to a secret's name (16 or more, or 6 or more in quotes or for a
    password); 0 for digits only, for marked samples, for what is yet to be filled in, and for
    values beside no name, quote or assignment that are not in a key format.  Others have no
    label (null)."""
    v, near = F.col("value"), F.concat_ws(" ", "left_word", F.right("before", F.lit(24)))
    vendor = v.rlike(r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}|^xox[abprs]-|^sk_live_|^AIza")
    named = lambda names, end: F.col("before").rlike(rf"{_set(names)}{end}\z")
    mixed = v.rlike("[a-zA-Z]") & v.rlike("[^a-zA-Z\\s]") & ~v.rlike(r"\s")
    assigned = mixed & ((named(_NAME, "[\"'`]?") & v.rlike("[0-9]") & (F.length(v) >= 16)) | named(_NAME, "[\"'`]")
                        | (named("pass(?:word|wd|phrase|code)?|pwd", "") & v.rlike("[0-9]")))
    in_url = F.col("before").rlike(IN_URL)
    digits = ~v.rlike("[A-Za-z]") & ~in_url
    sample = F.concat_ws(" ", v, "left_word").rlike(SAMPLES) | v.rlike(UNFILLED) | digits
    return found.withColumn("label", F.when(v.rlike(PEM), 1.0).when(sample, 0.0).when(vendor | assigned | in_url, 1.0)
                            .when(~F.col("before").rlike(r"[:=\"']\s*\z") & ~near.rlike(NAMES), 0.0))


CONTEXT = ["value", "before", "left_word", "right_word", "path"]


def secret_scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                path_col: str | None = "source", rows: int = TRAIN_ROWS) -> DataFrame:
    """Findings of every whole text.

    ``labelled`` has reviewed findings (the columns of ``candidates`` and ``label`` 0/1); if it is
    None, ``rule_labels`` of the candidates are used.  At most ``rows`` distinct ones train the
    forest; up to half of them are of the rarer label, however rare it is.  Returns one row per candidate: ``doc_id, doc_hash, i, start, end, value`` (see
    ``candidates``), ``score`` DOUBLE (the forest's probability of a secret; 1 for a
    whole private key and for what was reviewed as a secret) and ``is_secret``
    BOOLEAN (score >= 0.5).  If all labels are of one kind, all candidates take that label; with
    none, all are kept as secrets (score 1), so that nothing leaks.  Null or empty texts have no
    candidates; repeated rows give equal, repeated findings; ids may be null; other columns
    are ignored.  The noncharacters U+FDD0 to U+FDD2 count as U+FFFD.
    """
    all_found = stored(candidates(docs, id_col, text_col, path_col), "candidates")
    distinct = all_found.select(*CONTEXT).distinct()
    if labelled is None:
        labels = rule_labels(distinct)
        vectors = stored(features(labels, docs, text_col), "features")
        sample = vectors.where("label is not null")
    else:
        marked = labelled.select(*CONTEXT, F.col("label").cast("double")).where("label in (0, 1)").groupBy(*CONTEXT).agg(F.max("label").alias("label"))
        both = distinct.withColumn("label", F.lit(None).cast("double")).withColumn("own", F.lit(True)).unionByName(marked.withColumn("own", F.lit(False)))
        both = both.groupBy(*CONTEXT).agg(F.max("label").alias("label"), F.max("own").alias("own"))
        vectors = stored(features(both, docs, text_col), "features")
        sample = vectors.where("label is not null")
        vectors = vectors.where("own")
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}      # of all labels: two rows at most
    kinds = sorted(counts)
    sample = stored(per_label(sample.select(F.xxhash64(*CONTEXT).alias("h"), "label", "x"), counts, rows, "h"), "labelled")
    # a whole private key is one by its form, however few of them the trees have seen, unless a review says otherwise
    sure = F.when(F.col("value").rlike(PEM) & F.coalesce(F.col("label") == 1, F.lit(True)), 1.0)
    if labelled is not None:
        sure = F.coalesce(sure, F.when(F.col("label") == 1, 1.0))
    if len(kinds) < 2:
        scored = vectors.select(*CONTEXT, F.coalesce(sure, F.lit(kinds[0] if kinds else 1.0)).alias("score"))
    else:
        ordered = sample.repartition(4, "h").sortWithinPartitions("h").persist()
        model = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7).fit(ordered)
        ordered.unpersist()
        scored = model.transform(vectors).select(*CONTEXT, F.coalesce(sure, vector_to_array("probability")[1]).alias("score"))
    scored = scored.withColumn("key", F.xxhash64(*CONTEXT)).drop("before", "path", "left_word", "right_word")
    return (all_found.withColumn("key", F.xxhash64(*CONTEXT)).join(scored, ["key", "value"])
            .select("doc_id", "doc_hash", "i", "start", "end", "value", "score", (F.col("score") >= 0.5).alias("is_secret")))


def redact(docs: DataFrame, findings: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every secret of ``findings`` replaced by ``mark``; all rows and columns stay."""
    each = findings.groupBy("doc_hash", "i").agg(F.max("is_secret").alias("on"))
    hits = (each.groupBy(F.col("doc_hash").alias("hash")).agg(F.array_sort(F.collect_list(F.struct("i", "on"))).alias("hits"))     # one document's own
            .where(F.exists("hits", lambda x: x["on"])))
    marked = with_row(docs, hash=F.xxhash64(id_col, text_col), text=F.col(text_col)).join(hits, "hash", "left")
    cut = marked.select("row", "text", "hits", F.when(F.col("hits").isNotNull(), _pieces(F.col("text"))).alias("pieces"))
    # every piece but the last ends in the candidate of its number
    shown = lambda p, i: F.when(F.get("hits", i)["on"], F.concat(
        F.translate(F.substring_index(p, _MARKS[1], 1), _MARKS, ""), F.lit(mark))).otherwise(F.translate(p, _MARKS, ""))
    new = F.when(F.col("hits").isNotNull(), F.array_join(F.transform("pieces", shown), "")).otherwise(F.col("text"))
    return cut.select(F.col("row").withField(f"`{text_col}`", new).alias("row")).select("row.*")
