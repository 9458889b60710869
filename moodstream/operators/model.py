"""Splitting, training, applying and judging the linear sentiment model."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.lookup import MAX_LITERAL_ENTRIES, lookup
from moodstream.functions.scores import outcome
from moodstream.functions.text import feature_tokens
from moodstream.operators.features import join_vocabulary


@dataclass(frozen=True)
class LinearModel:
    """Weights by term; a term that is not listed weighs 0."""

    weights: Mapping[str, float]
    intercept: float = 0.0


def load_linear_model(vocabulary: DataFrame, weights: DataFrame) -> LinearModel:
    """Model from (term, idx) and (idx, weight, intercept).

    The rows that come to the driver are counted first; a larger model stays a table and is applied
    by `score_by_join`.
    """
    head = weights.select("intercept").first()
    rows = (
        vocabulary.join(weights, "idx")
        .filter("weight != 0")
        .select("term", "weight")
        .limit(MAX_LITERAL_ENTRIES + 1)
        .collect()
    )
    if len(rows) > MAX_LITERAL_ENTRIES:
        raise ValueError(f"more than {MAX_LITERAL_ENTRIES} weighted terms; use score_by_join")
    intercept = head["intercept"] if head is not None and head["intercept"] is not None else 0.0
    return LinearModel({r["term"]: r["weight"] for r in rows}, intercept)


def margin(words: Column, model: LinearModel) -> Column:
    """Intercept plus the weights of all words of a message.

    Works within the row: no shuffle, no key, and so the same on a table and on a stream.
    """
    return F.aggregate(
        words,
        F.lit(float(model.intercept)),
        lambda total, word: total + F.coalesce(lookup(word, model.weights), F.lit(0.0)),
    )


def mean_weight(words: Column, model: LinearModel) -> Column:
    """Margin per word, in one pass over the words; the bare intercept without words."""
    start = F.struct(
        F.lit(float(model.intercept)).alias("total"), F.lit(0).cast("bigint").alias("n")
    )

    def add(state: Column, word: Column) -> Column:
        weight = F.coalesce(lookup(word, model.weights), F.lit(0.0))
        return F.struct((state["total"] + weight).alias("total"), (state["n"] + 1).alias("n"))

    return F.aggregate(
        words, start, add, lambda state: state["total"] / F.greatest(state["n"], F.lit(1))
    )


def decision(score: Column) -> Column:
    """1 for a margin above 0, else 0; a message without a known term is negative at intercept 0."""
    return F.when(score > 0, 1).otherwise(0)


def score_messages(messages: DataFrame, model: LinearModel, raw: Column | None = None) -> DataFrame:
    """Add `margin` and `prediction`. `raw`: the tokens of the texts, where they are known."""
    scored = messages.withColumn("margin", margin(feature_tokens(F.col("text"), raw), model))
    return scored.withColumn("prediction", decision(F.col("margin")))


def score_by_join(
    messages: DataFrame,
    weights: DataFrame,
    key: Sequence[str] = ("id",),
    intercept: float = 0.0,
    max_terms: int | None = None,
) -> DataFrame:
    """(key, margin, prediction) with the model as a (term, weight) table of any size.

    The outer steps keep messages without words and words without weight, so no join back to the
    messages is needed. `key` must be unique.
    """
    words = messages.select(
        *key, F.explode_outer(feature_tokens(F.col("text"))).alias("word")
    )
    weighted = join_vocabulary(words, weights, how="left", max_terms=max_terms)
    total = F.sum(F.coalesce("weight", F.lit(0.0))) + F.lit(float(intercept))
    return (
        weighted.groupBy(*key)
        .agg(total.alias("margin"))
        .withColumn("prediction", decision(F.col("margin")))
    )


def hash_share(key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone: 52 bits of its MD5."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 13), 16, 10).cast("double") / 2**52


def split_by_key(frame: DataFrame, key: str = "id", train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Train and test part by key: the same rows on every run, cluster and retry."""
    in_train = hash_share(F.col(key)) < train
    return frame.filter(in_train), frame.filter(~in_train)


def split_at_random(frame: DataFrame, seed: int | None = None, train: float = 0.8):
    """Train and test part by random draws."""
    return frame.randomSplit([train, 1 - train], seed)


def train_model(
    points: DataFrame,
    max_iter: int = 100,
    reg: float = 0.01,
    tol: float = 1e-3,
    points_per_task: int = 20_000,
) -> LogisticRegressionModel:
    """Logistic regression with L2 penalty and without intercept on raw counts.

    Each iteration is one distributed sum over the points, which the estimator keeps persisted. A
    small sample is put into few tasks, as starting tasks would take most of every iteration; a large
    one keeps all of its partitions.
    """
    points = points.select("label", "features").persist()
    try:
        tasks = -(-points.count() // points_per_task)  # makes the features, in all tasks of their plan
        return LogisticRegression(
            maxIter=max_iter,
            tol=tol,
            regParam=reg,
            elasticNetParam=0.0,
            fitIntercept=False,
            standardization=False,
        ).fit(points.coalesce(max(1, tasks)))
    finally:
        points.unpersist()


def long_points(points: DataFrame) -> DataFrame:
    """(id, idx, tf) of points (id, label, features): one row per term of a point."""
    features = F.unwrap_udt("features")  # the sparse vector as a struct
    entries = F.arrays_zip(features["indices"].alias("idx"), features["values"].alias("tf"))
    return points.select("id", F.explode(entries).alias("entry")).select("id", "entry.idx", "entry.tf")


def residuals(points: DataFrame, counts: DataFrame, weights: DataFrame) -> DataFrame:
    """(id, margin, label, residual) at given (idx, weight): the probability of class 1 less the label."""
    margins = counts.join(weights, "idx").groupBy("id").agg(F.sum(F.col("tf") * F.col("weight")).alias("margin"))
    placed = points.select("id", "label").join(margins, "id", "left").na.fill(0.0, ["margin"])
    return placed.withColumn("residual", 1 / (1 + F.exp(-F.col("margin"))) - F.col("label"))


def gradient(points: DataFrame, weights: DataFrame, reg: float = 0.01) -> DataFrame:
    """(idx, gradient) of the penalised mean log loss at given (idx, weight), for every weight.

    0 everywhere at the weights that `train_model` looks for. Works on tables of any size: terms meet weights, margins are summed by point, and
    residuals meet the terms again.
    """
    counts = long_points(points)
    judged = residuals(points, counts, weights).select("id", "residual")
    size = points.agg(F.count("*")).scalar()
    sums = counts.join(judged, "id").groupBy("idx").agg(F.sum(F.col("tf") * F.col("residual")).alias("total"))
    mean = F.coalesce(F.col("total"), F.lit(0.0)) / size
    return weights.join(sums, "idx", "left").select("idx", (mean + reg * F.col("weight")).alias("gradient"))


def loss(points: DataFrame, weights: DataFrame, reg: float = 0.01) -> DataFrame:
    """One row `loss`: the penalised mean log loss at given (idx, weight)."""
    judged = residuals(points, long_points(points), weights)
    signed = F.when(F.col("label") == 1, F.col("margin")).otherwise(-F.col("margin"))
    # log(1 + exp(-x)) without overflow for large -x
    each = F.greatest(-signed, F.lit(0.0)) + F.log1p(F.exp(-F.abs(signed)))
    penalty = weights.agg((F.lit(reg / 2) * F.sum(F.col("weight") * F.col("weight"))).alias("penalty"))
    return judged.agg(F.avg(each).alias("mean")).select((F.col("mean") + penalty.scalar()).alias("loss"))


def predict(model: LogisticRegressionModel, points: DataFrame) -> DataFrame:
    """Prediction next to the label, in the same row."""
    return model.transform(points).withColumn("prediction", F.col("prediction").cast("int"))


def confusion(predicted: DataFrame, label: str = "label") -> DataFrame:
    """Messages per outcome: True/False Positive/Negative."""
    cell = outcome(F.col("prediction"), F.col(label).cast("int"))
    return predicted.groupBy(cell.alias("outcome")).agg(F.count("*").alias("cnt"))


def weight_row(vocabulary: DataFrame, weights: DataFrame, intercept: float = 0.0) -> DataFrame:
    """One row {weights, intercept} in index order from (term, weight); as long as the vocabulary."""
    placed = vocabulary.join(weights, "term", "left").select(
        F.struct("idx", F.coalesce("weight", F.lit(0.0)).alias("weight")).alias("placed")
    )
    ordered = F.array_sort(F.collect_list("placed"))
    return placed.agg(
        F.transform(ordered, lambda entry: entry["weight"]).alias("weights"),
        F.lit(float(intercept)).alias("intercept"),
    )


def fitted_row(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """The same row from a fitted model."""
    row = ([float(w) for w in model.coefficients.toArray()], float(model.intercept))
    return spark.createDataFrame([row], "weights array<double>, intercept double")


def export_row(row: DataFrame, path: str) -> None:
    """Write a model row as JSON, readable by `read_model`."""
    row.coalesce(1).write.mode("overwrite").json(path)


def export_model(spark: SparkSession, model: LogisticRegressionModel, path: str) -> None:
    """Write the weights of a fitted model as JSON."""
    export_row(fitted_row(spark, model), path)


def draw_numbers(spark: SparkSession, n: int) -> DataFrame:
    """Draws 0..n-1, made in the tasks."""
    return spark.range(n).withColumnRenamed("id", "draw")


def replay(
    corpus: DataFrame, numbers: DataFrame, draws: DataFrame, key: str = "id", idx: str = "idx"
) -> DataFrame:
    """One message of a corpus per draw, with replacement.

    `numbers` gives every corpus key a dense number 0..n-1, see `numbered`; texts are joined last. A
    draw number is hashed to a row number, so a repeated or lost task draws the same messages again.
    """
    size = corpus.agg(F.count("*")).scalar()
    row = F.floor(hash_share(F.col("draw")) * size).cast("bigint")
    picked = draws.select("draw", row.alias(idx)).join(numbers.select(key, idx), idx)
    return picked.drop(idx).join(corpus, key)
