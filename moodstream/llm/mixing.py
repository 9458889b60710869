"""Mixing sources to target weights in blocks of equal size, by Sainte-Lague apportionment.

The mix has `share` times the words of all documents. Every source gets a target by weight, at most `most` times its own
words; what it can't take goes to the others by weight. The mix is so many blocks of B words. They are given to
sources, and a source's blocks to its shards, by the highest quotients weight / (2 k + 1), so quotas are whole numbers
and sum up. A shard is about SHARD documents of one source in seeded order; its words are cut into blocks of B, and its
quota is dealt over them at equal distance from a seeded start, so each is taken floor or ceil of
quota / blocks times. How often a document's words are taken follows by arithmetic from its place in the shard, without a row
per block.

B is a 64th of the smallest source, between LEAST_BLOCK and MOST_BLOCK words, so that a quota of whole blocks comes near each target.

Only one row per source passes a single task (the order of sources decides their weights); shards are bounded, so a source
with a third of all rows is many tasks. Everything depends on keys and seed only: reruns agree.

Null text: size 0. Null source: a source of its own, last in order. Documents of size 0 are taken 0 times. Rows with equal key
are separate documents next to each other. No words at all: targets 0. `mixed_texts` keeps columns not named, whatever their names, and does not read
them; `placed` replaces columns that have the names of its own. Texts of any length are one row. An empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARD = 8192
LEAST_BLOCK, MOST_BLOCK = 16, 1024
PLACED = ("size", "source_size", "target", "block", "first", "n", "quota", "shift", "docs", "source_quota")


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float = 1.5, most: int = 2, weights=WEIGHTS) -> DataFrame:
    """Adds weight, target and block to (source, docs, source_size), one row per source.

    Sources are filled in the order of most * size / weight. Each is full if its share of what is left is more than it
    can take; behind the first that is not, all get their share.
    """
    everything = Window.partitionBy(F.lit(0))
    placed = everything.orderBy(F.col("source").asc_nulls_last())
    filled = everything.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(0, Window.unboundedFollowing)
    number = F.get(F.lit(list(weights)), ((F.row_number().over(placed) - 1) % len(weights)).cast("int"))
    out = sources.withColumn("weight", number.cast("long"))
    cap = most * F.col("source_size")
    left = share * F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    out = out.withColumn("full", cap * F.sum("weight").over(after) <= F.col("weight") * left)
    level = (
        share * F.sum("source_size").over(everything) - F.sum(F.when(F.col("full"), cap).otherwise(0)).over(everything)
    ) / F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    smallest = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(everything)
    block = F.greatest(F.lit(LEAST_BLOCK), F.least(F.lit(MOST_BLOCK), F.expr("div(smallest, 64)")))
    return (
        out.withColumn("target", F.when(F.col("full"), cap.cast("double")).otherwise(F.col("weight") * level))
        .withColumn("smallest", F.coalesce(smallest, F.lit(0)))
        .withColumn("block", block.cast("long"))
        .drop("full", "smallest")
    )


def apportioned(cells: DataFrame, group: list[str], weight: str, seats: str, order: list[str]) -> DataFrame:
    """Adds `quota`: the seats of each group given to its cells by the highest quotients weight / (2 k + 1).

    Rounding weight / (mean weight of a seat) comes close. What is missing or too much in sum moves each quota one way by at
    most its share of (that number + cells) and one, so only those quotients need to be ranked.
    """
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    total = F.sum(weight).over(whole)
    near = F.coalesce(F.floor(F.try_divide(F.col(weight) * F.col(seats), total) + 0.5), F.lit(0))
    out = cells.withColumns({"__near": near.cast("long"), "__total": total, "__cells": F.count("*").over(whole)})
    off = F.abs(F.col(seats) - F.sum("__near").over(whole))
    reach = F.ceil(F.coalesce(F.try_divide(F.col(weight), F.col("__total")), F.lit(0.0)) * (off + F.col("__cells"))) + 1
    out = out.withColumn("__reach", reach.cast("long"))
    out = out.withColumn("__sure", F.greatest(F.lit(0), F.col("__near") - F.col("__reach")).cast("long"))
    out = out.withColumn("__open", F.col(seats) - F.sum("__sure").over(whole))
    tried = out.withColumn("__k", F.explode(F.sequence("__sure", F.col("__near") + F.col("__reach"))))
    ranked = Window.partitionBy(*(group or [F.lit(0)])).orderBy(
        (F.col(weight) / (2 * F.col("__k") + 1)).desc(), *(F.col(x).asc_nulls_last() for x in order)
    )
    won = (F.row_number().over(ranked) <= F.col("__open")).cast("long")
    kept = [F.first(x).alias(x) for x in cells.columns if x not in {*group, *order}]
    return (
        tried.withColumn("__won", won)
        .groupBy(*group, *(x for x in order if x not in group))
        .agg(*kept, (F.first("__sure") + F.sum("__won")).alias("quota"))
    )


def _draw(*parts: Column) -> Column:
    """Seeded digest of the given values."""
    return F.md5(F.concat_ws(":", *(F.coalesce(x.cast("string"), F.lit("")) for x in parts)))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def placed(frame: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7) -> DataFrame:
    """The frame with size, source_size, target, block, first (place of the first word in its shard), n (blocks of the shard), quota and shift."""
    sized = frame.drop(*PLACED).withColumn("size", word_count(F.col(text)))
    return placed_by_size(sized, key, source, seed)


def placed_by_size(sized: DataFrame, key: str = "doc_id", source: str = "source", seed: int = 7) -> DataFrame:
    """`placed` for a frame that has `size`."""
    named = sized.withColumn("__source", F.col(source).cast("string"))
    totals = targets(named.groupBy(F.col("__source").alias("source")).agg(F.count("*").alias("docs"), F.sum("size").alias("source_size")))
    seats = F.floor(F.sum("target").over(Window.partitionBy(F.lit(0))) / F.col("block") + 0.5).cast("long")
    totals = apportioned(totals.withColumn("seats", seats), [], "target", "seats", ["source"])
    totals = totals.select(F.col("source").alias("__of"), "docs", "source_size", "target", "block", F.col("quota").alias("source_quota"))
    drawn = _draw(F.lit(seed), F.col(key))
    shards = F.ceil(F.col("docs") / SHARD).cast("long")
    dealt = named.join(totals, F.col("__source").eqNullSafe(F.col("__of"))).withColumn("__drawn", drawn)
    dealt = dealt.withColumn("__shard", _number(F.col("__drawn")) % shards).drop("docs", "__of")
    cells = dealt.groupBy("__source", "__shard").agg(
        F.sum("size").alias("words"), F.first("source_quota").alias("source_quota"), F.first("block").alias("block")
    )
    quotas = apportioned(cells, ["__source"], "words", "source_quota", ["__shard"])
    n = F.greatest(F.lit(1), F.ceil(F.col("words") / F.col("block")).cast("long"))
    quotas = quotas.select(
        F.col("__source").alias("__s"), F.col("__shard").alias("__h"), n.alias("n"), F.least("quota", 2 * n).alias("quota"),
        (_number(_draw(F.lit(seed), F.col("__source"), F.col("__shard"))) % n).alias("shift"),
    )
    in_order = Window.partitionBy("__source", "__shard").orderBy("__drawn", F.col(key), "size")
    first = F.coalesce(F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = dealt.withColumn("first", first).join(
        quotas, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__shard") == F.col("__h"))
    )
    return joined.drop("__source", "__shard", "__drawn", "__s", "__h", "source_quota")


def times(block: str) -> str:
    """SQL for how often block number `block` of a shard is taken."""
    return f"(div(({block} + 1) * quota + shift, n) - div({block} * quota + shift, n))"


def _up_to(place: str) -> str:
    number = f"div({place}, block)"
    return f"(block * div({number} * quota + shift, n) + ({place} - block * {number}) * {times(number)})"


def taken() -> Column:
    """Words that the mix takes of a document, repeats counted, from the columns of `placed`."""
    return F.expr(f"{_up_to('(first + size)')} - {_up_to('first')}").cast("long")


def mixed_texts(frame: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 7) -> DataFrame:
    """The mix: per document one row of the words taken at least once, and one of those taken twice; none if there are none.

    White space behind a word goes with it. A text taken whole stays as it is.
    """
    own = frame.select(
        F.struct(*(F.col(f"`{x}`") for x in frame.columns if x != text)).alias("__row"),
        F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").cast("string").alias("__text"), F.col(f"`{source}`").alias("__from"),
    )
    cut = placed(own, "__key", "__text", "__from", seed).withColumn("taken", taken()).filter("taken > 0")
    units = F.regexp_extract_all(F.col("__text"), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    number = "div(first + i, block)"
    cut = cut.withColumn("__units", F.when(F.col("taken") % F.col("size") != 0, units))
    part = lambda k: F.expr(f"array_join(filter(__units, (w, i) -> {times(number)} >= {k}), '')")
    both = [
        F.when(F.col("taken") >= k * F.col("size"), F.col("__text")).when(F.col("__units").isNotNull(), part(k)).otherwise(F.lit(""))
        for k in (1, 2)
    ]
    out = cut.withColumn("__text", F.explode(F.array(*both))).filter(F.col("__text") != "")
    return out.select(*(F.col("__text" if x == text else f"__row.`{x}`").alias(x) for x in frame.columns))
