"""Message codec: topic bytes to columns and back."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodstream.schemas import MESSAGE

_CORRUPT = "_corrupt_record"


def payload_text(value: Column) -> Column:
    """Text of a topic value that arrives as UTF-8 bytes."""
    return F.decode(value.cast("binary"), "UTF-8")


def encode_payload(*columns: str | Column) -> Column:
    """JSON text of some columns as UTF-8 bytes."""
    return F.encode(F.to_json(F.struct(*columns)), "UTF-8")


def decode_payload(
    frame: DataFrame, payload: str = "payload", schema: T.StructType = MESSAGE
) -> DataFrame:
    """Add the message fields and `is_bad` to a frame with a JSON text column.

    A record that does not parse keeps its payload, gets null fields and is_bad = true, so that one
    bad record does not end the job. `split_bad` separates the two.
    """
    extended = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(payload),
        extended,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    carried = [c for c in frame.columns if c not in schema.fieldNames()]
    # A filter is pushed below a projection, with a copy of the parser for every field it names, but
    # not below a generator. So the one-element array makes sure that a payload is parsed once.
    message = F.explode_outer(F.array(parsed)).alias("message")
    fields = [F.col(f"message.{name}").alias(name) for name in schema.fieldNames()]
    bad = F.col("message").isNull() | F.col(f"message.{_CORRUPT}").isNotNull()
    return frame.select(*carried, message).select(*carried, *fields, bad.alias("is_bad"))


def split_bad(decoded: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Good messages, and the payloads for the quarantine output."""
    good = decoded.filter(~F.col("is_bad")).drop("is_bad", payload)
    return good, decoded.filter("is_bad").select(payload)


# Signs that stand in for escapes while a literal is rewritten. No literal holds them bare, as control signs are written as escapes.
_BACKSLASH, _SINGLE, _DOUBLE = "\x01", "\x02", "\x03"


def literal_to_json(payload: str | Column) -> Column:
    """JSON for payloads written as Python literals, which from_json cannot read (None, True, escapes).

    Escapes are hidden first, so that quotes left are those around texts; the literal is then cut into texts and what stands between them, and each is written as JSON
    has it. All in built-in functions. What cannot be cut without a rest is passed on as it is, for quarantine.
    """
    given = F.col(payload) if isinstance(payload, str) else payload
    hidden = F.replace(F.replace(F.replace(given, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit("\\'"), F.lit(_SINGLE)), F.lit('\\"'), F.lit(_DOUBLE))

    def text(part: Column) -> Column:
        inner = F.replace(F.substr(part, F.lit(2), F.char_length(part) - 2), F.lit('"'), F.lit(_DOUBLE))
        inner = F.regexp_replace(F.replace(inner, F.lit(_SINGLE), F.lit("'")), r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
        inner = F.replace(F.replace(_wide(inner), F.lit(_DOUBLE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
        return F.concat(F.lit('"'), inner, F.lit('"'))

    def between(part: Column) -> Column:
        for name, value in (("None", "null"), ("True", "true"), ("False", "false")):
            part = F.regexp_replace(part, rf"\b{name}\b", value)
        return part

    def rewritten(parts: Column) -> Column:
        whole = F.aggregate(parts, F.lit(0), lambda n, x: n + F.char_length(x)) == F.char_length(hidden)
        each = F.transform(parts, lambda x: F.when(F.left(x, F.lit(1)).isin("'", '"'), text(x)).otherwise(between(x)))
        return F.when(whole & ~F.contains(hidden, F.lit("\x00")), F.array_join(each, "")).otherwise(given)

    parts = F.regexp_extract_all(hidden, F.lit("'[^']*+'|\"[^\"]*+\"|[^'\"]++"), F.lit(0))
    bare = F.regexp_like(given, F.lit(f"[{_BACKSLASH}{_SINGLE}{_DOUBLE}]"))
    return F.when(bare, given).otherwise(F.get(F.transform(F.array(parts), rewritten), F.lit(0)))


def _wide(text: Column) -> Column:
    """Escapes of eight digits as the two of four digits that JSON has for them."""
    unit = lambda base, value: F.concat(F.lit("\\u"), F.lower(F.hex(F.lit(base) + value)))

    def pair(part: Column, i: Column) -> Column:
        code = F.conv(F.left(part, F.lit(8)), 16, 10).cast("bigint") - 0x10000
        wide = F.concat(unit(0xD800, F.shiftright(code, 10)), unit(0xDC00, code.bitwiseAND(0x3FF)), F.substr(part, F.lit(9)))
        return F.when(i == 0, part).otherwise(wide)

    return F.when(F.contains(text, F.lit("\\U")), F.array_join(F.transform(F.split(text, r"\\U"), pair), "")).otherwise(text)


def with_defaults(frame: DataFrame) -> DataFrame:
    """Missing text and language count as empty."""
    return frame.withColumns(
        {
            "text": F.coalesce("text", F.lit("")),
            "lang": F.coalesce("lang", F.lit("")),
        }
    )


def parse_created_at(created_at: Column) -> Column:
    """Time of a message from `Wed Oct 10 20:19:24 +0000 2018` or an ISO text; null if neither."""
    return F.coalesce(
        F.try_to_timestamp(F.substring(created_at, 5, 26), F.lit("MMM dd HH:mm:ss Z yyyy")),
        F.try_to_timestamp(created_at),
    )
