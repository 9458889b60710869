"""Training, evaluation and replay."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.operators.features import labelled_points as points_of
from moodstream.operators.features import vocabulary_terms
from moodstream.operators.model import (
    confusion,
    export_row,
    gradient,
    load_linear_model,
    loss,
    predict,
    replay,
    score_messages,
    split_by_key,
    train_model,
    weight_row,
)
from moodstream.operators.ranking import numbered, numbered_by_ranges
from moodstream.plans.messages import english, placeholders_sql, spread, tokens_sql
from moodstream.plans.registry import query
from moodstream.plans.sentiment import LEXICON, LEXICON_SQL, MODEL, scored_sql
from moodstream.plans.words import VOCABULARY, VOCABULARY_SQL, vocabulary
from moodstream.sources.readers import read_model, table
from moodstream.streaming.folders import new_folder, written

LABELLED_SQL = """labelled AS (
  SELECT doc_id AS id, quality AS sentiment, text FROM labels JOIN documents USING (doc_id)
)"""


def share_sql(key: str) -> str:
    """52 bits of an MD5 as a number in [0, 1)."""
    return (
        f"(CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE)"
        " / 4503599627370496.0::DOUBLE)"
    )


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """(id, sentiment, text) of the labelled documents."""
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("sentiment")
    )
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return labels.join(spread(documents), "id")


@query(
    f"""
    SELECT doc_id AS id, quality AS sentiment,
           CASE WHEN {share_sql('doc_id')} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part
    FROM labels
    """
)
def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled ids with the part they fall into."""
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("sentiment")
    )
    train, test = split_by_key(labels)
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query(
    f"""
    WITH {LABELLED_SQL}, {scored_sql('labelled')}
    SELECT CASE WHEN prediction = sentiment THEN 'True ' ELSE 'False ' END
           || CASE WHEN prediction = 1 THEN 'Positive' ELSE 'Negative' END AS outcome,
           count(*) AS cnt
    FROM scored JOIN labelled USING (id) GROUP BY 1
    """
)
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes of the lexicon model on the labelled documents."""
    return confusion(score_messages(labelled(spark, folder), MODEL), "sentiment")


@query(
    f"""
    WITH {VOCABULARY_SQL}, {LABELLED_SQL},
    words AS (
      SELECT sentiment, unnest({tokens_sql(placeholders_sql('text'))}) AS word FROM labelled
    )
    SELECT CAST(sentiment AS DOUBLE) AS label, CAST(idx AS INTEGER) AS idx,
           count(*) AS total
    FROM words JOIN vocabulary ON word = term GROUP BY sentiment, idx
    """
)
def labelled_points(spark: SparkSession, folder: str) -> DataFrame:
    """Sum of the feature vectors per label, as (label, index, total)."""
    terms = vocabulary_terms(vocabulary(spark, folder), VOCABULARY + 4)
    features = F.unwrap_udt("features")  # the sparse vector as a struct
    counted = points_of(labelled(spark, folder), terms).select(
        "label", F.explode(F.arrays_zip(features["indices"].alias("idx"), features["values"].alias("value"))).alias("entry")
    )
    return counted.groupBy("label", F.col("entry.idx").alias("idx")).agg(
        F.sum(F.col("entry.value").cast("bigint")).alias("total")
    )


@query(
    f"""
    WITH {VOCABULARY_SQL}, {scored_sql('english', known='word IN (SELECT term FROM vocabulary)')}
    SELECT id, margin, prediction FROM scored
    """
)
def exported_model_score(spark: SparkSession, folder: str) -> DataFrame:
    """Scores with a model that was placed in vocabulary order, written as JSON and read back."""
    path = new_folder(spark, "model")
    terms = written(vocabulary(spark, folder), "vocabulary")
    weights = spark.createDataFrame(list(LEXICON.items()), "term string, weight double")
    export_row(weight_row(terms, weights), path)
    model = load_linear_model(terms, read_model(spark, path))
    return score_messages(spread(english(spark, folder)), model).select(
        "id", "margin", "prediction"
    )


@query()
def train_and_confuse(spark: SparkSession, folder: str) -> DataFrame:
    """Train on four fifths of the labelled documents, judge on the rest."""
    terms = vocabulary_terms(vocabulary(spark, folder), VOCABULARY + 4)
    points = points_of(labelled(spark, folder), terms).select("id", "label", "features")
    train, test = split_by_key(points)
    return confusion(predict(train_model(train), test))


REG = 0.01

GRADIENT_SQL = f"""{VOCABULARY_SQL}, {LABELLED_SQL}, {LEXICON_SQL},
known AS (SELECT idx, coalesce(weight, 0.0) AS weight FROM vocabulary LEFT JOIN lexicon ON word = term),
counts AS (
  SELECT id, idx, count(*) AS tf FROM (SELECT id, unnest({tokens_sql(placeholders_sql('text'))}) AS word FROM labelled)
  JOIN vocabulary ON word = term GROUP BY id, idx
),
margins AS (
  SELECT id, sentiment, coalesce(margin, 0.0) AS margin FROM labelled
  LEFT JOIN (SELECT id, sum(tf * weight) AS margin FROM counts JOIN known USING (idx) GROUP BY id) USING (id)
)"""


def at_lexicon(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Points of the labelled documents, and (idx, weight) of the lexicon's terms; other terms weigh 0."""
    terms = written(vocabulary(spark, folder), "vocabulary")
    points = points_of(labelled(spark, folder), vocabulary_terms(terms, VOCABULARY + 4)).select("id", "label", "features")
    lexicon = spark.createDataFrame(list(LEXICON.items()), "term string, weight double")
    return points, terms.join(lexicon, "term", "left").select("idx", F.coalesce("weight", F.lit(0.0)).alias("weight"))


@query(
    f"""
    WITH {GRADIENT_SQL},
    sums AS (SELECT idx, sum(tf * (1 / (1 + exp(-margin)) - sentiment)) AS total FROM counts JOIN margins USING (id) GROUP BY idx)
    SELECT CAST(idx AS INTEGER) AS idx,
           CAST(floor((coalesce(total, 0.0) / (SELECT count(*) FROM labelled) + {REG}::DOUBLE * weight) * 1000000 + 0.5) AS BIGINT) AS millionths
    FROM known LEFT JOIN sums USING (idx)
    """
)
def loss_gradient(spark: SparkSession, folder: str) -> DataFrame:
    """Gradient of the training objective at the lexicon's weights, in millionths."""
    found = gradient(*at_lexicon(spark, folder), REG)
    millionths = F.floor(F.col("gradient") * 1_000_000 + 0.5).cast("bigint")
    return found.select(F.col("idx").cast("int").alias("idx"), millionths.alias("millionths"))


@query(
    f"""
    WITH {GRADIENT_SQL}
    SELECT CAST(floor((avg(greatest(-signed, 0.0) + ln(1 + exp(-abs(signed)))) + {REG / 2}::DOUBLE * (SELECT sum(weight * weight) FROM known))
           * 1000000 + 0.5) AS BIGINT) AS millionths
    FROM (SELECT CASE WHEN sentiment = 1 THEN margin ELSE -margin END AS signed FROM margins)
    """
)
def training_loss(spark: SparkSession, folder: str) -> DataFrame:
    """The training objective at the lexicon's weights, in millionths."""
    found = loss(*at_lexicon(spark, folder), REG)
    return found.select(F.floor(F.col("loss") * 1_000_000 + 0.5).cast("bigint").alias("millionths"))


@query(
    f"""
    WITH draws AS (
      SELECT k AS draw, CAST(floor({share_sql('k')} * (SELECT count(*) FROM documents)) AS BIGINT)
               AS idx
      FROM (SELECT event_id AS k FROM events)
    ),
    corpus AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx, doc_id, text FROM documents)
    SELECT draw, doc_id AS id, text FROM draws JOIN corpus USING (idx)
    """
)
def replay_sample(spark: SparkSession, folder: str) -> DataFrame:
    """As many draws with replacement from the documents as there are events."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    numbers = numbered(documents.select("id"), F.col("id"), F.floor(F.col("id") / 65536))
    draws = table(spark, folder, "events").select(F.col("event_id").alias("draw"))
    return replay(documents, numbers, draws).select("draw", "id", "text")


SPARSE = 1_000_003 * 1_000_003  # a factor that spreads ids over the 64-bit numbers


@query(
    f"""
    WITH draws AS (
      SELECT k AS draw, CAST(floor({share_sql('k')} * (SELECT count(*) FROM documents)) AS BIGINT)
               AS idx
      FROM (SELECT event_id AS k FROM events)
    ),
    corpus AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx, doc_id * {SPARSE} AS id, text FROM documents)
    SELECT draw, id, text FROM draws JOIN corpus USING (idx)
    """
)
def replay_sparse(spark: SparkSession, folder: str) -> DataFrame:
    """The same draws from documents whose ids are far apart."""
    sparse = (F.col("doc_id") * SPARSE).alias("id")
    documents = table(spark, folder, "documents").select(sparse, "text")
    draws = table(spark, folder, "events").select(F.col("event_id").alias("draw"))
    return replay(documents, numbered_by_ranges(documents.select("id"), "id"), draws).select("draw", "id", "text")
