"""Quality classifier: a factorisation machine over hashed words, structure statistics and
metadata.  Weights and low-rank factors are learned by Spark's FM solver from a bounded
sample of labelled rows; scoring uses the sum-of-squares identity, so it is linear in a
text's distinct words."""

from __future__ import annotations

from pyspark.ml.classification import FMClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler, VectorSizeHint
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineark.llm.common import fold, stored, with_row

#: most labelled rows that training reads; the rows with the smallest id hashes
TRAIN_ROWS = 20_000
HASHED_WORDS = 1 << 12
FACTORS = 4
#: entries of the statistics vector
STATISTICS = 15
#: partitions of the training rows, so that a fit does not depend on the cluster
TRAIN_PARTS = 6


def _statistics(text: Column, words: str, n_chars: Column) -> Column:
    """Structure of a text as numbers between about 0 and 3."""
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    count = lambda pattern: F.length(F.regexp_replace(text, pattern, "")).cast("double")
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    kinds = F.size(F.array_distinct(words)).cast("double")
    lines = F.split(text, "\n")
    n_lines = F.size(lines).cast("double")
    again = F.size(F.filter(F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: a == b), lambda x: x)).cast("double")
    letters = 1 - count(r"\p{L}+") / chars
    return F.array(
        letters, 1 - count(r"\p{Lu}+") / chars, 1 - count(r"\p{N}+") / chars, 1 - count(r"[\s]+") / chars,
        F.least(F.lit(1.0), 10 * (1 - count(r"[#$%&*|@^~<>{}=\\+_]+") / chars)), F.least(F.lit(1.0), 5 * (1 - count(r"[!?]+") / chars)),
        F.least(F.lit(1.0), 5 * (1 - count(r"[.,;:]+") / chars)),
        kinds / n, again / n, F.size(F.array_distinct(lines)) / n_lines,
        F.least(F.lit(3.0), chars / n / 8), F.log1p(n) / 10, F.log1p(n_lines) / 10, F.log1p(n / n_lines) / 5,
        F.log1p(F.greatest(F.coalesce(n_chars, F.length(text)).cast("double"), F.lit(0.0))) / 15)


def features(docs: DataFrame, text_col: str, size_col: str | None) -> DataFrame:
    """``docs`` with the feature vector ``__x``: structure statistics, then hashed word presence
    scaled to length 1, so that a long text's words weigh no more than a short one's."""
    size = F.col(size_col) if size_col else F.lit(None).cast("long")
    text = docs.withColumn("__text", F.coalesce(F.col(text_col), F.lit("")))
    words = text.withColumn("__words", F.split(F.lower("__text"), r"\s+"))
    stats = words.withColumn("__s", array_to_vector(_statistics(F.col("__text"), "__words", size)))
    stats = stats.withColumn("__words", F.array_distinct("__words"))
    stats = VectorSizeHint(inputCol="__s", size=STATISTICS, handleInvalid="optimistic").transform(stats)    # else a job reads a row for it
    hashed = HashingTF(numFeatures=HASHED_WORDS, binary=True, inputCol="__words", outputCol="__h").transform(stats)
    scaled = Normalizer(inputCol="__h", outputCol="__n").transform(hashed)
    return VectorAssembler(inputCols=["__s", "__n"], outputCol="__x").transform(scaled).select(*docs.columns, "__x")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars",
          label_col: str = "quality", keep: Column | None = None, rows: int = TRAIN_ROWS):
    """A model fitted on at most ``rows`` labelled rows (those with the smallest id hashes;
    ``keep``, on the column ``id``, restricts labels to some).  An id with differing labels is not
    used.  Returns None if there are no labels, or only one kind."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).where("id is not null and label in (0, 1)")
    known = known.where(keep) if keep is not None else known
    known = (known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
             .where("label = other").orderBy(F.xxhash64("id"), "id").limit(rows).select("id", "label"))
    known = stored(known, "labels")
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (F.col(size_col) if size_col else F.lit(None).cast("long")).alias("size"))
    chosen = text.join(F.broadcast(known), "id")          # at most ``rows`` labels
    sample = stored(features(chosen, "text", "size").select("id", "label", "__x"), "sample")
    if sample.select("label").distinct().count() < 2:
        return None
    sample = sample.repartition(TRAIN_PARTS, "id").sortWithinPartitions("id").persist()
    try:
        return FMClassifier(featuresCol="__x", labelCol="label", predictionCol="__predicted", probabilityCol="__p", rawPredictionCol="__raw",
                            factorSize=FACTORS, solver="adamW", stepSize=0.05, maxIter=80, regParam=1e-3, initStd=0.02, seed=7).fit(sample)
    finally:
        sample.unpersist()


def scored(docs: DataFrame, model, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with ``__score``, evaluated by Spark's model as
    bias + w.x + 0.5 * sum_f ((v_f.x)^2 - v_f^2.x^2); 0.5 without a model."""
    if model is None:
        return docs.withColumn("__score", F.lit(0.5))
    return model.transform(features(docs, text_col, size_col)).select(*docs.columns, vector_to_array("__p")[1].alias("__score"))


def quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, id_col: str = "doc_id",
            text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """Scores of every whole text, learned from labels outside the held-out fold.

    Returns one row per input row: the id column, ``held_out`` BOOLEAN (crc32 of the id as
    text modulo ``folds`` is ``held``; false for a null id), ``score`` DOUBLE (0 to 1, higher:
    label 1 likelier), ``predicted`` INT (1 if score >= 0.5).  Inputs of a score are the text
    and the ``size_col`` metadata only (null: the text's length).  Null and empty texts are
    scored like any text; with no labels, or only one kind, every score is 0.5.  Repeated
    rows get equal scores.  Other columns are ignored.
    """
    model = train(docs, labels, id_col, text_col, size_col, keep=fold(F.col("id"), folds) != held)
    size = F.col(size_col) if size_col else F.lit(None).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), size.alias("size"))
    return scored(rows, model, "text", "size").select(
        F.col("id").alias(id_col), F.coalesce(fold(F.col("id"), folds) == held, F.lit(False)).alias("held_out"),
        F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` that the classifier, learned from all ``labels``, does not reject (score
    0.5 or more), all columns as they are.  Without a model all rows stay."""
    model = train(docs, labels, id_col, text_col, size_col)
    rows = with_row(docs, text=F.col(text_col), size=F.col(size_col) if size_col else F.lit(None).cast("long"))
    return scored(rows, model, "text", "size").where("__score >= 0.5").select("row.*")
