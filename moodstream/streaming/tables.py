"""Serving tables: parts that micro-batches add, named by a commit log, and reading them back as sums.

Every micro-batch writes what it adds to its batches into folders of its own and then commits all of them at once, so all
tables always show the same micro-batches. Late messages and batches that are still open need no rewriting: readers sum the parts.

A commit also says which input it covers: ranges of offsets by topic and partition, or files. A run that reads input again that another run has committed
(after a lost checkpoint) leaves the covered messages out before it counts, so each message counts once whether the new run starts at the beginning, in the middle or at the end.

The log holds the batch times of every part, and of its files, each of which holds a range of them. Views of the newest batches open only the files that can hold them, also of
parts that reach over the whole history, and `compact` merges the parts of closed periods into one, so their number does not grow with the history. `vacuum` removes files that no commit names any more.

Windows that are written once, when they are closed, wait as parts of `open`; see `Closing`.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodstream.functions.clock import window_start
from moodstream.operators.recent import recent_per_batch
from moodstream.operators.words import newest_batches, top_words
from moodstream.schemas import COVERED, RECENT_TEXT, SEEN, SENTIMENT_HISTORY, WORD_COUNTS
from moodstream.streaming.folders import release
from moodstream.streaming.log import Conflict, Log, Part, State, newest_cut

TOP = 100  # words kept per batch
SHOWN = 5  # messages kept per batch
ATTEMPTS = 20

#: Table name -> row type. `latest` holds the top words of the newest batch, `open` all words of windows not closed yet, `seen` the newest event time.
SCHEMAS = {
    "words": WORD_COUNTS,
    "recent_text": RECENT_TEXT,
    "sentiment": SENTIMENT_HISTORY,
    "latest": WORD_COUNTS,
    "covered": COVERED,
    "open": WORD_COUNTS,
    "seen": SEEN,
}

#: Tables of (batch_ts, word, cnt) whose files hold ranges of batch times.
RANGED = ("words", "open")


@dataclass(frozen=True)
class ServingTables:
    """The tables of one job below a folder."""

    folder: str

    @property
    def quarantine(self) -> str:
        return f"{self.folder}/quarantine"

    def checkpoint(self, output: str) -> str:
        return f"{self.folder}/checkpoints/{output}"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """Name of the run a checkpoint belongs to, kept beside it: a lost checkpoint gives a new run."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}.run")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    begun = files.exists(jvm.org.apache.hadoop.fs.Path(checkpoint))
    if not (begun and files.exists(path)):
        out = files.create(path, True)
        out.writeUTF(uuid.uuid4().hex)
        out.close()
    found = files.open(path)
    name = found.readUTF()
    found.close()
    return name


def _read(spark: SparkSession, tables: ServingTables, name: str, parts: list[Part]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], SCHEMAS[name])
    return spark.read.schema(SCHEMAS[name]).parquet(*(f"{tables.folder}/{x.path}" for x in parts))


def _written(tables: ServingTables, frames: dict[str, DataFrame], mark: str) -> list[Part]:
    """Write frames as parts, each below its table, and look up their batch times. Empty ones give no part.

    Words are most of it. They are dealt out by ranges of batch times, and of words within a batch, so that a file holds few batches and a large batch is several files.
    """
    paths = {name: f"{name}/{mark}-{uuid.uuid4().hex[:12]}" for name in frames}
    for name, frame in frames.items():
        rows = frame.select(SCHEMAS[name].fieldNames())
        if name in RANGED:
            rows = rows.repartitionByRange("batch_ts", "word")
        rows.write.parquet(f"{tables.folder}/{paths[name]}")
    spark = next(iter(frames.values())).sparkSession
    time = lambda name: F.unix_micros("batch_ts") if "batch_ts" in SCHEMAS[name].fieldNames() else F.lit(0).cast("bigint")
    file = lambda name: F.col("_metadata.file_name") if name in RANGED else F.lit("")
    times = [
        spark.read.schema(SCHEMAS[name]).parquet(f"{tables.folder}/{path}").select(F.lit(name).alias("name"), file(name).alias("file"), time(name).alias("t"))
        for name, path in paths.items()
    ]
    once = reduce(DataFrame.unionByName, times).distinct()  # few: a time at the edge of two files is in both
    zones = once.groupingSets([["name", "file"], ["name"]], "name", "file").agg(F.grouping("file"), F.min("t"), F.max("t"), F.count_distinct("t"))
    found = zones.collect()  # one row per table, and one per file
    files = {name: sorted(tuple([x[1], *x[3:]]) for x in found if x[0] == name and not x[2] and x[3] is not None) for name in RANGED}
    return [Part(name, paths[name], *seen, tuple(files.get(name, ())) if len(files.get(name, ())) > 1 else ()) for name, _, whole, *seen in found if whole]


def uncovered(messages: DataFrame, tables: ServingTables, state: State, run: str) -> DataFrame:
    """Messages that no other run has committed.

    A run goes through a partition's offsets in order, so all between its first and its last committed one is covered.
    """
    if "source" not in messages.columns or not set(state.epochs) - {run}:
        return messages
    ranges = _read(messages.sparkSession, tables, "covered", state.of("covered")).filter(F.col("run") != run)
    ranges = ranges.groupBy("run", "stream", "part").agg(F.min("first").alias("first"), F.max("last").alias("last")).alias("c")
    place = F.col("source.offset")
    same = (F.col("source.stream") == F.col("c.stream")) & (F.col("source.part") == F.col("c.part"))
    return messages.join(ranges, same & place.between(F.col("c.first"), F.col("c.last")), "left_anti")


def ranges_of(messages: DataFrame, run: str) -> DataFrame:
    """(run, stream, part, first, last): the input that messages come from."""
    return (
        messages.filter("source is not null")
        .groupBy("source.stream", "source.part")
        .agg(F.min("source.offset").alias("first"), F.max("source.offset").alias("last"))
        .select(F.lit(run).alias("run"), "stream", "part", "first", "last")
    )


def _snapshot(spark: SparkSession, tables: ServingTables, state: State, words: list[Part], top: int) -> tuple[list[Part], list[str]]:
    """The part of the new `latest` table and the paths it replaces; nothing if the newest batch is not among the new words."""
    old = state.of("latest")
    if not words or old and old[0].last > words[0].last:
        return [], []
    newest = words[0].last
    holding = [x for part in [*state.of("words"), *words] for x in part.pieces() if x.first <= newest <= x.last]
    rows = _read(spark, tables, "words", holding).filter(F.unix_micros("batch_ts") == newest)
    summed = rows.groupBy("batch_ts", "word").agg(F.sum("cnt").alias("cnt"))
    return _written(tables, {"latest": top_words(summed, top).coalesce(1)}, "latest"), [x.path for x in old]


def micros(spark: SparkSession, length: str) -> int:
    """An interval in microseconds, independent of time zones."""
    begin = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    found = spark.sql(f"SELECT {begin} + CAST(:length AS INTERVAL) - {begin}", args={"length": length}).first()[0]
    return found // timedelta(microseconds=1)


@dataclass(frozen=True)
class Closing:
    """Windows are closed when the newest event is `delay` past their end, as by Spark's watermark; messages that come later are dropped.

    The counts of a micro-batch are a part of `open`. With the micro-batch whose newest event closes windows, the parts that hold these are added up and their top
    words become a part of `words`; parts whose windows are all closed are taken away. Nothing is held in memory between micro-batches, and each count
    is read only when its part has a window to close. All of it is in the micro-batch's one commit.
    """

    window: str
    delay: str

    def limit(self, spark: SparkSession, seen: list[Part]) -> int:
        """Windows that end by this time are closed. To the millisecond, and not before 1970, as a watermark is."""
        delay = micros(spark, self.delay)
        if delay < 0:
            raise ValueError(f"a delay of less than nothing: {self.delay}")
        return max([0, *(x.last // 1000 * 1000 - delay for x in seen)])

    def in_time(self, messages: DataFrame, state: State) -> DataFrame:
        """Messages whose window was not closed before."""
        spark = messages.sparkSession
        over = self.limit(spark, state.of("seen")) - micros(spark, self.window)
        placed = messages.withColumn("_start", F.unix_micros(window_start(F.col("event_ts"), self.window)))
        return placed.filter(F.col("_start") > over).drop("_start")

    def newest(self, messages: DataFrame, state: State) -> DataFrame:
        """The row of `seen`: the newest event time up to now; none if there is none."""
        known = max((x.last for x in state.of("seen")), default=None)
        newest = F.greatest(F.max("event_ts"), F.timestamp_micros(F.lit(known).cast("bigint")))
        return messages.agg(newest.alias("batch_ts")).filter("batch_ts is not null")

    def closed(self, spark: SparkSession, tables: ServingTables, state: State, parts: list[Part], top: int) -> tuple[list[Part], list[str]]:
        """The part of `words` for the windows that the new parts close, and the paths that are not needed any more."""
        seen = [x for x in parts if x.table == "seen"]
        if not seen:
            return [], []
        width = micros(spark, self.window)
        over, due = (self.limit(spark, x) - width for x in (state.of("seen"), seen))
        held = [x for x in [*state.of("open"), *parts] if x.table == "open"]
        gone = [x.path for x in state.of("seen")] + [x.path for x in state.of("open") if x.last <= due]
        holding = [x for part in held for x in part.pieces() if x.first <= due and x.last > over]
        if due <= over or not holding:
            return [], gone
        rows = _read(spark, tables, "open", holding).filter(F.unix_micros("batch_ts").between(over + 1, due))
        summed = rows.groupBy("batch_ts", "word").agg(F.sum("cnt").alias("cnt"))
        return _written(tables, {"words": top_words(summed, top)}, "closed"), gone


class Outputs(dict):
    """Frames by table, and the frames behind them that are kept until these are written."""

    def __init__(self, frames: dict[str, DataFrame], kept: list[DataFrame]):
        super().__init__(frames)
        self.kept = kept


def add_batch(
    messages: DataFrame,
    tables: ServingTables,
    run: str,
    epoch: int,
    outputs: Callable[[DataFrame], dict[str, DataFrame]],
    top: int = TOP,
    closing: Closing | None = None,
    streamed: bool = False,
) -> bool:
    """Write what the messages of a micro-batch add and commit it; False if that has been done before, or, if they are `streamed`, if there are none.

    `outputs` makes the frames of the tables from the messages that count. With `closing`, those are the messages that are in time, and closed windows are written too.
    The messages that count are kept while the outputs are made, or what `outputs.narrowed` makes of them.
    """
    spark = messages.sparkSession
    log = Log(spark, tables.folder)
    narrowed = getattr(outputs, "narrowed", lambda frame: frame)
    for _ in range(ATTEMPTS):
        state = log.state()
        if state.epochs.get(run, -1) >= epoch:
            if streamed:
                messages.count()  # all of it is read, as state above needs, also where it is known already
            return False
        counted = narrowed(uncovered(messages, tables, state, run)).persist()
        kept = [counted]
        try:
            parts, replaced = [], []
            if counted.count():
                frames = outputs(counted if closing is None else closing.in_time(counted, state))
                kept += getattr(frames, "kept", [])
                if closing is not None:
                    frames["seen"] = closing.newest(counted, state)
                if "source" in messages.columns:
                    frames["covered"] = ranges_of(counted, run)
                parts = _written(tables, frames, f"{run}-{epoch:012d}")
                done, over = ([], []) if closing is None else closing.closed(spark, tables, state, parts, top)
                parts += done
                latest, old = _snapshot(spark, tables, state, [x for x in parts if x.table == "words"], top)
                parts, replaced = [*parts, *latest], [*over, *old]
            elif streamed and (not set(state.epochs) - {run} or messages.isEmpty()):
                return False
        finally:
            for frame in kept:
                frame.unpersist()
        others = {k: v for k, v in state.epochs.items() if k != run}
        while True:
            try:
                log.commit(state, parts, replaced, {run: epoch})
                return True
            except Conflict:
                state = log.state()
            if {k: v for k, v in state.epochs.items() if k != run} != others or set(replaced) - set(state.parts):
                break  # another run was there: some of these messages may be covered now
    raise Conflict(f"{run}, micro-batch {epoch}: other writers came first {ATTEMPTS} times")


def read_parts(spark: SparkSession, tables: ServingTables, name: str, newest: int | None = None) -> DataFrame:
    """All committed rows of a table, or those files and rows that can belong to the `newest` batches."""
    parts = Log(spark, tables.folder).state().of(name)
    pieces = [x for part in parts for x in part.pieces()]
    cut = None if newest is None else newest_cut(pieces, newest)
    if cut is None:
        return _read(spark, tables, name, parts)
    rows = _read(spark, tables, name, [x for x in pieces if x.last >= cut])
    return rows.filter(F.col("batch_ts") >= F.timestamp_micros(F.lit(cut)))


def read_sentiment(spark: SparkSession, tables: ServingTables, newest: int | None = None) -> DataFrame:
    """Sentiment history: per batch the sum of what the micro-batches added. `newest`: of so many batches only."""
    rows = read_parts(spark, tables, "sentiment", newest)
    summed = rows.groupBy("batch_ts").agg(F.sum("negative").alias("negative"), F.sum("positive").alias("positive"))
    return summed if newest is None else newest_batches(summed, newest)


def read_word_counts(spark: SparkSession, tables: ServingTables, newest: int | None = None) -> DataFrame:
    """Words per batch, as far as the job has kept them."""
    rows = read_parts(spark, tables, "words", newest)
    if newest is not None:
        rows = newest_batches(rows, newest)
    return rows.groupBy("batch_ts", "word").agg(F.sum("cnt").alias("cnt"))


def read_words(spark: SparkSession, tables: ServingTables, top: int = TOP, newest: int | None = None) -> DataFrame:
    """Word count history: the top words per batch."""
    return top_words(read_word_counts(spark, tables, newest), top).select(*WORD_COUNTS.fieldNames())


def read_latest(spark: SparkSession, tables: ServingTables) -> DataFrame:
    """The `latest` snapshot of the word counts: one part."""
    return read_parts(spark, tables, "latest")


def read_recent_text(spark: SparkSession, tables: ServingTables, k: int = SHOWN, newest: int | None = None) -> DataFrame:
    """k newest messages per batch. A window may have been fed by several micro-batches, each with its own newest."""
    return recent_per_batch(read_parts(spark, tables, "recent_text", newest), k)


#: How parts become one part that readers can't tell from them; `by`: what a batch also has in common.
MERGED: dict[str, Callable[..., DataFrame]] = {
    "words": lambda rows, *by: rows.groupBy("batch_ts", "word", *by).agg(F.sum("cnt").alias("cnt")),
    "open": lambda rows, *by: rows.groupBy("batch_ts", "word", *by).agg(F.sum("cnt").alias("cnt")),
    "sentiment": lambda rows, *by: rows.groupBy("batch_ts", *by).agg(F.sum("negative").alias("negative"), F.sum("positive").alias("positive")),
    "recent_text": lambda rows, *by: recent_per_batch(rows, SHOWN, ["batch_ts", *by]),
    "covered": lambda rows: rows.groupBy("run", "stream", "part").agg(F.min("first").alias("first"), F.max("last").alias("last")),
}


def compact(spark: SparkSession, tables: ServingTables, period: int = 3600, least: int = 2) -> int:
    """Merge the parts of closed periods (of so many seconds) into one part a period; the number of parts taken away.

    A period is closed if it ends before the newest batch. Parts that reach into an open one wait. A part that comes later for a closed period is merged
    the next time. Periods with one part that lies within them are left alone. `covered` becomes one part.
    """
    release(spark)  # of the micro-batches before
    log = Log(spark, tables.folder)
    state, width = log.state(), period * 1_000_000
    times = [x.last for x in state.parts.values() if x.table not in ("covered", "seen")]
    if not times:
        return 0
    closed = max(times) // width * width
    add: list[Part] = []
    gone: list[str] = []
    for name, merged in MERGED.items():
        parts = [x for x in state.of(name) if name == "covered" or x.last < closed]
        if name == "covered":
            chosen = parts if len(parts) >= least else []
        else:
            alone: dict[int, list[Part]] = {}
            for x in parts:
                for at in range(x.first // width, x.last // width + 1):
                    alone.setdefault(at, []).append(x)
            chosen = [x for x in parts if x.first // width != x.last // width or len(alone[x.first // width]) >= least]
        if not chosen:
            continue
        rows = _read(spark, tables, name, chosen)
        gone += [x.path for x in chosen]
        if name == "covered":
            add += _written(tables, {name: merged(rows).coalesce(1)}, "compact")
            continue
        mark = f"{name}/compact-{uuid.uuid4().hex[:12]}"
        at = F.floor(F.unix_micros("batch_ts") / width).cast("bigint")
        # Dealt out by period before they are merged: they are sent once, where merging by batch and word would send them again.
        rows = merged(rows.withColumn("period", at).repartition("period"), "period")
        rows.write.partitionBy("period").parquet(f"{tables.folder}/{mark}")
        typed = T.StructType([*SCHEMAS[name].fields, T.StructField("period", T.LongType())])
        back = spark.read.schema(typed).parquet(f"{tables.folder}/{mark}").select("period", F.unix_micros("batch_ts").alias("t"))
        seen = back.groupBy("period").agg(F.min("t"), F.max("t"), F.count_distinct("t"))
        add += [Part(name, f"{mark}/period={at}", *zone) for at, *zone in seen.collect()]  # one row per closed period
    for _ in range(ATTEMPTS):
        if not gone:
            return 0
        try:
            log.commit(state, add, gone)
            return len(gone) - len(add)
        except Conflict:
            state = log.state()
            if set(gone) - set(state.parts):
                break  # another compaction came first; its parts are as good
    return 0


def vacuum(spark: SparkSession, tables: ServingTables, older_than: int = 86_400) -> int:
    """Delete folders and log files that the newest state does not need, if they are `older_than` seconds; their number.

    Readers that began within that time still find what they name.
    """
    log = Log(spark, tables.folder)
    state, versions = log.state(), log.versions()
    limit = spark.sql("SELECT unix_millis(current_timestamp())").first()[0] - 1000 * older_than
    live = {"/".join(x.split("/")[:2]) for x in state.parts}
    gone = [f"{name}/{x}" for name in SCHEMAS for x, time in log.modified(name).items() if time < limit and f"{name}/{x}" not in live]
    full = next((x for x in reversed(versions) if log.read(x)["full"]), 0)
    for x, time in log.modified("log").items():
        if time < limit and (x.endswith(".draft") or x.endswith(".json") and x[:-5].isdigit() and int(x[:-5]) < full):
            gone.append(f"log/{x}")
    for path in gone:
        log.delete(path)
    return len(gone)
