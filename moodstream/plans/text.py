"""Decoding, filtering and text normalisation."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.clock import descending_time_key
from moodstream.functions.text import feature_tokens, tokens, with_placeholders
from moodstream.operators.filters import take_first, track
from moodstream.plans.messages import (
    english,
    messages,
    placeholders_sql,
    spread,
    tokens_sql,
)
from moodstream.plans.registry import SQL, query
from moodstream.sources.arrays import read_arrays, write_arrays
from moodstream.sources.payload import decode_payload as decode
from moodstream.sources.payload import encode_payload, literal_to_json, payload_text, with_defaults
from moodstream.sources.readers import read_labelled, split_bad_labels, split_labelled_lines, table
from moodstream.streaming.folders import new_folder

SUBJECTS = "great,Under,@"
FIRST = 100


@query(
    """
    SELECT doc_id AS id, text, lang, source AS screen_name, FALSE AS is_bad FROM documents
    WHERE doc_id % 10 <> 3
    UNION ALL
    SELECT CAST(NULL AS BIGINT), NULL, NULL, NULL, TRUE FROM documents WHERE doc_id % 10 = 3
    """
)
def decode_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Every message as JSON text and back; every tenth payload is cut short and must be flagged."""
    payload = F.to_json(F.struct("id", "text", "lang", "user"))
    cut = F.when(F.col("id") % 10 == 3, F.expr("left(payload, length(payload) - 1)"))
    payloads = (
        spread(messages(spark, folder))
        .select("id", payload.alias("payload"))
        .select(F.coalesce(cut, "payload").alias("payload"))
    )
    return decode(payloads).select(
        *(
            F.when(~F.col("is_bad"), F.col(source)).alias(name)
            for source, name in (
                ("id", "id"),
                ("text", "text"),
                ("lang", "lang"),
                ("user.screen_name", "screen_name"),
            )
        ),
        "is_bad",
    )


@query(
    """
    SELECT doc_id AS id, text, lang, source AS screen_name,
           CAST(octet_length(encode(text)) AS BIGINT) AS text_bytes
    FROM documents
    """
)
def payload_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Messages encoded to UTF-8 topic bytes, decoded and parsed again."""
    sent = spread(messages(spark, folder)).select(
        encode_payload("id", "text", "lang", "user").alias("value")
    )
    received = decode(sent.select(payload_text(F.col("value")).alias("payload")))
    return received.select(
        "id",
        "text",
        "lang",
        F.col("user.screen_name").alias("screen_name"),
        F.octet_length(F.encode("text", "UTF-8")).cast("bigint").alias("text_bytes"),
    )


@query(
    """
    WITH lines AS (
      SELECT CAST(l.quality AS VARCHAR) || ',' || d.text AS line
      FROM labels l JOIN documents d USING (doc_id)
    )
    SELECT CAST(split_part(line, ',', 1) AS INTEGER) AS sentiment,
           substr(line, strpos(line, ',') + 1) AS text
    FROM lines
    """
)
def labelled_sample(spark: SparkSession, folder: str) -> DataFrame:
    """`sentiment,text` lines with a header, split at the first comma."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    texts = table(spark, folder, "documents").select("doc_id", "text")
    lines = labels.join(texts, "doc_id").select(
        F.concat_ws(",", F.col("quality").cast("string"), "text").alias("value")
    )
    header = spark.createDataFrame([("sentiment,text",)], "value string")
    good, _ = split_bad_labels(split_labelled_lines(header.union(lines)))
    return good


@query(
    """
    SELECT doc_id AS id, text, source AS screen_name FROM documents
    WHERE coalesce(lang, '') = 'en' AND coalesce(text, '') <> ''
    """
)
def english_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    """Non-empty English messages."""
    return english(spark, folder).select(
        "id", "text", F.col("user.screen_name").alias("screen_name")
    )


@query(
    """
    SELECT lang, count(*) AS cnt, CAST(count_if(text = '') AS BIGINT) AS empty_texts
    FROM (SELECT coalesce(CASE WHEN doc_id % 7 <> 0 THEN lang END, '') AS lang,
                 coalesce(CASE WHEN doc_id % 5 <> 0 THEN text END, '') AS text FROM documents)
    GROUP BY lang
    """
)
def missing_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of which some lack language or text, with defaults filled in."""
    holes = messages(spark, folder).withColumns(
        {
            "lang": F.when(F.col("id") % 7 != 0, F.col("lang")),
            "text": F.when(F.col("id") % 5 != 0, F.col("text")),
        }
    )
    return (
        with_defaults(holes)
        .groupBy("lang")
        .agg(
            F.count("*").alias("cnt"),
            F.count_if(F.col("text") == "").alias("empty_texts"),
        )
    )


@query(
    """
    SELECT doc_id AS id, lang, text FROM documents
    WHERE contains(lower(text), 'great') OR contains(lower(text), 'under')
       OR contains(lower(text), '@')
    """
)
def track_subjects(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that hold any of some subjects."""
    return track(messages(spark, folder), SUBJECTS).select("id", "lang", "text")


def literal(text: Column) -> Column:
    """A text as Python writes it."""
    plain = text
    for sign, escape in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        plain = F.replace(plain, F.lit(sign), F.lit(escape))
    double = F.contains(plain, F.lit("'")) & ~F.contains(plain, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(text.isNull(), "None").when(double, F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(single)


@query(SQL["decode_payload"])
def decode_literal(spark: SparkSession, folder: str) -> DataFrame:
    """The same with messages as Python literals, the form of older producers' topics."""
    given = spread(messages(spark, folder))
    payload = F.concat(
        F.lit("{'id': "), F.col("id").cast("string"), F.lit(", 'text': "), literal(F.col("text")), F.lit(", 'lang': "), literal(F.col("lang")),
        F.lit(", 'truncated': False, 'geo': None, 'user': {'screen_name': "), literal(F.col("user.screen_name")), F.lit(", 'verified': True}}"),
    )
    cut = F.when(F.col("id") % 10 == 3, F.expr("left(payload, length(payload) - 1)"))
    payloads = given.select("id", payload.alias("payload")).select(F.coalesce(cut, "payload").alias("payload"))
    found = decode(payloads.withColumn("payload", literal_to_json("payload")))
    good = lambda name: F.when(~F.col("is_bad"), F.col(name))
    return found.select(
        good("id").alias("id"), good("text").alias("text"), good("lang").alias("lang"), good("user.screen_name").alias("screen_name"), "is_bad"
    )


@query(SQL["labelled_sample"])
def labelled_file(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled sample written as text files and read back; a line break within a text travels as another sign."""
    path = new_folder(spark, "labelled")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    texts = table(spark, folder, "documents").select("doc_id", "text")
    line = F.concat_ws(",", F.col("quality").cast("string"), F.replace("text", F.lit("\n"), F.lit("\x0b")))
    labels.join(texts, "doc_id").select(line.alias("value")).write.option("lineSep", "\n").text(path)
    good, _ = split_bad_labels(read_labelled(spark, path))
    return good.withColumn("text", F.replace("text", F.lit("\x0b"), F.lit("\n")))


@query("SELECT doc_id AS id, lang, text, source AS screen_name FROM documents")
def message_array(spark: SparkSession, folder: str) -> DataFrame:
    """Messages written as JSON arrays and read back by byte ranges."""
    path = new_folder(spark, "arrays")
    write_arrays(messages(spark, folder), path)
    return read_arrays(spark, path).select("id", "lang", "text", F.col("user.screen_name").alias("screen_name"))


@query(f"SELECT doc_id AS id, lang, text FROM documents ORDER BY doc_id LIMIT {FIRST}")
def limit_n(spark: SparkSession, folder: str) -> DataFrame:
    """Stop after a number of messages."""
    return take_first(messages(spark, folder), FIRST, "id").select("id", "lang", "text")


@query(f"SELECT doc_id AS id, {placeholders_sql('text')} AS text FROM documents")
def placeholder_text(spark: SparkSession, folder: str) -> DataFrame:
    """Placeholders in message texts."""
    return spread(messages(spark, folder)).select("id", with_placeholders(F.col("text")).alias("text"))


@query(
    f"""
    SELECT page_id AS id, {placeholders_sql("url || ' rt:@' || page_id || ' #top ' || html")} AS text
    FROM pages
    """
)
def placeholder_links(spark: SparkSession, folder: str) -> DataFrame:
    """Placeholders in texts full of links."""
    page = F.concat("url", F.lit(" rt:@"), "page_id", F.lit(" #top "), "html")
    return table(spark, folder, "pages").select(
        F.col("page_id").alias("id"), with_placeholders(page).alias("text")
    )


@query(
    f"""
    SELECT doc_id AS id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens
    FROM (SELECT doc_id, {tokens_sql('text')} AS t FROM documents)
    """
)
def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every message, in order."""
    return (
        spread(messages(spark, folder))
        .select("id", tokens(F.col("text")).alias("words"))
        .select(
            "id",
            F.size("words").cast("bigint").alias("n_tokens"),
            F.array_join("words", " ").alias("tokens"),
        )
    )


@query(
    f"""
    SELECT doc_id AS id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens
    FROM (SELECT doc_id, {tokens_sql(placeholders_sql('text'))} AS t FROM documents)
    """
)
def tokenize_features(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every message after placeholders, as the model sees them."""
    return (
        spread(messages(spark, folder))
        .select("id", feature_tokens(F.col("text")).alias("words"))
        .select(
            "id",
            F.size("words").cast("bigint").alias("n_tokens"),
            F.array_join("words", " ").alias("tokens"),
        )
    )


@query(
    """
    SELECT event_id, CAST(epoch_us(TIMESTAMP '2030-01-01') - epoch_us(ts) AS DOUBLE) / 1000000.0
             AS time_key
    FROM events
    """
)
def desc_time_key(spark: SparkSession, folder: str) -> DataFrame:
    """Descending row key of every arrival."""
    return table(spark, folder, "events").select(
        "event_id", descending_time_key(F.col("ts")).alias("time_key")
    )
