"""Where the messages of a stored log are: one row for each file, with its lowest and highest position.

Every commit keeps such rows of its own files, in a hidden folder that becomes visible with it.  They answer
what a log's last positions are, how many messages stand after a cursor, and which files can hold
messages after a start, without a look at messages.  Commits without them (written before there were
any, or by others) are read for their positions instead.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from topiclake.envelope import ENVELOPE, LOG, POSITION, position
from topiclake.plans.bounded import small_side
from topiclake.plans.commits import NUMBERED, found

FOLDER = "_positions"
_PLACE = "STRUCT<ledger_id: BIGINT, entry_id: BIGINT, batch_index: INT>"
STORED = f"topic STRING, partition INT, file STRING, low {_PLACE}, high {_PLACE}, messages BIGINT, earliest TIMESTAMP, latest TIMESTAMP"
#: metadata of the columns of a stored log that are as they were stored: the log's path
LOG_PATH = "topiclake.log"


def own_ledger(ledger: Column, commit: Column) -> Column:
    """The ledger of a message: its own, or that of its numbered commit."""
    number = F.when(commit.startswith(NUMBERED), F.substring(commit, len(NUMBERED) + 1, 20).try_cast("bigint"))
    return F.coalesce(ledger, number)


def summarized(messages: DataFrame, file: Column, *more: str) -> DataFrame:
    """A row for each file of messages; ``file`` names it by its ``file_path``.

    Plain numbers are aggregated first, which hashes and combines; then only the messages of a file's lowest and highest ledger
    are looked at for their entries, so a log with as many ledgers as messages takes no more memory.
    """
    keys = [*more, *LOG, "file_path"]
    whole = messages.groupBy(*keys).agg(
        F.min("ledger_id").alias("_low"), F.max("ledger_id").alias("_high"),
        F.count("*").alias("messages"), F.min("publish_time").alias("earliest"), F.max("publish_time").alias("latest"),
    )
    # a row for each file that the scan lists in the driver anyway; a partition may be NULL
    sides = F.broadcast(whole.select(*[F.col(k).alias(f"_{k}") for k in keys], "_low", "_high", "messages", "earliest", "latest"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    ends = messages.drop("publish_time").join(sides, same).where(F.col("ledger_id").isNull() | F.col("ledger_id").isin(F.col("_low"), F.col("_high")))
    facts = [F.max("messages").alias("messages"), F.min("earliest").alias("earliest"), F.max("latest").alias("latest")]
    ledgers = ends.groupBy(*keys, "ledger_id", "batch_index").agg(F.min("entry_id").alias("low"), F.max("entry_id").alias("high"), *facts)
    low, high = (F.struct("ledger_id", F.col(c).alias("entry_id"), "batch_index") for c in ("low", "high"))
    return ledgers.groupBy(*keys).agg(F.min(low).alias("low"), F.max(high).alias("high"), *facts).withColumn("file", file).drop("file_path")


def keep(spark: SparkSession, draft: str) -> None:
    """Write the rows of a draft's files into it; of the messages only position and time are read."""
    stored = spark.read.schema(ENVELOPE).parquet(draft)
    rows = summarized(stored.select(*LOG, *POSITION, "publish_time", "_metadata.file_path"), _inside(F.col("file_path"), draft.rstrip("/").rpartition("/")[2]))
    kinds = T.StructType.fromDDL(STORED)
    rows.select(*[F.col(f.name).cast(f.dataType) for f in kinds]).coalesce(1).write.parquet(f"{draft}/{FOLDER}")


def _inside(file: Column, folder: str) -> Column:
    """The path of a file below a folder of the log."""
    return F.substring_index(file, f"/{folder}/", -1)


def commit_names(spark: SparkSession, path: str, inside: str = "") -> set[str]:
    """The commits of a log, those that have ``inside`` if given."""
    paths = [p.removesuffix(inside) for p in found(spark, f"{path}/commit=*{inside}")]
    return {p.rpartition("/")[2].removeprefix("commit=") for p in paths}


def commit_log(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The messages of some commits, with the commit's name."""
    schema = T.StructType([*ENVELOPE.fields, T.StructField("commit", T.StringType())])
    stored = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/commit={n}" for n in names])
    return stored.withColumn("ledger_id", own_ledger(F.col("ledger_id"), F.col("commit")))


def files(spark: SparkSession, path: str) -> DataFrame:
    """``commit``, ``topic``, ``partition``, ``file``, ``low``, ``high``, ``messages``, ``earliest``, ``latest`` of all files of a log."""
    path = path.rstrip("/")
    there, described = commit_names(spark, path), commit_names(spark, path, f"/{FOLDER}")
    schema = T.StructType([*T.StructType.fromDDL(STORED).fields, T.StructField("commit", T.StringType())])
    kept = spark.createDataFrame([], schema)
    if described:
        kept = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/commit=*/{FOLDER}")
        for end in ("low", "high"):
            kept = kept.withColumn(end, F.col(end).withField("ledger_id", own_ledger(F.col(f"{end}.ledger_id"), F.col("commit"))))
    if rest := sorted(there - described):
        m = commit_log(spark, path, rest).select("commit", *LOG, *POSITION, "publish_time", "_metadata.file_path")
        rows = summarized(m, F.regexp_extract(F.substring_index("file_path", "/commit=", -1), "^[^/]*/(.*)$", 1), "commit")
        kept = kept.unionByName(rows)
    return kept.select("commit", *LOG, "file", "low", "high", "messages", "earliest", "latest")


def high_water(rows: DataFrame) -> DataFrame:
    """Last position per topic partition, from rows of ``files``."""
    return rows.groupBy(*LOG).agg(F.max("high").alias("last"))


def positions(rows: DataFrame) -> DataFrame:
    """The same as columns, see ``eventtime.positions``."""
    return high_water(rows).select(*LOG, "last.*")


def can_hold(start: Column, inclusive: Column) -> Column:
    """Whether a file holds messages at or after a start; a partition without one is read from its first message."""
    return start.isNull() | (F.col("high") > start) | (inclusive & (F.col("high") == start))


def backlog(spark: SparkSession, path: str, rows: DataFrame, cursors: DataFrame) -> DataFrame:
    """``eventtime.backlog`` of a stored log: files wholly before or after a cursor count by their rows of ``files``; only a file that
    a cursor cuts is read, and of it the positions."""
    at = cursors.select(*LOG, F.struct("ledger_id", "entry_id", "batch_index").alias("_cursor"))
    seen = rows.join(small_side(at), LOG, "left")
    after = F.col("_cursor").isNull() | (F.col("low") > F.col("_cursor"))
    whole = seen.groupBy(*LOG).agg(F.sum(F.when(after, F.col("messages")).otherwise(0)).alias("backlog"), F.sum("messages").alias("messages"))
    cut = seen.where((F.col("low") <= F.col("_cursor")) & (F.col("high") > F.col("_cursor"))).select("commit", "file").collect()
    if not cut:
        return whole
    # at most one file of a partition for each commit that overlaps others; file names of metadata are escaped as in a URI
    names = [f"{path.rstrip('/')}/commit={r['commit']}/{r['file']}" for r in cut]
    schema = T.StructType([*ENVELOPE.fields, T.StructField("commit", T.StringType())])
    m = spark.read.schema(schema).option("basePath", path.rstrip("/")).parquet(*[unquote(n) for n in names])
    m = m.withColumn("ledger_id", own_ledger(F.col("ledger_id"), F.col("commit"))).select(*LOG, *POSITION)
    part = m.join(small_side(at), LOG).where(position() > F.col("_cursor")).groupBy(*LOG).agg(F.count("*").alias("cut"))
    return whole.join(part, LOG, "left").select(*LOG, (F.col("backlog") + F.coalesce("cut", F.lit(0))).alias("backlog"), "messages")


def log_path(m: DataFrame) -> str | None:
    """The path of the stored log whose messages, as they were stored, ``m`` has; None of any other DataFrame."""
    paths = {m.schema[c].metadata.get(LOG_PATH) if c in m.columns else None for c in (*LOG, *POSITION)}
    return paths.pop() if len(paths) == 1 else None


def pruned(m: DataFrame, starts: DataFrame) -> DataFrame:
    """``m`` without the files of its stored log that hold no message at or after ``starts`` (topic, partition, start, inclusive).

    Files that come later, of a stream or of another commit, are always read.  The driver gets the names of the files that are left
    out, if they are fewer, or else of those that are read: never more than the scan itself lists.  What is no stored log stays as it is.
    """
    path = log_path(m)
    if path is None:
        return m
    try:
        file = m.select("_metadata.file_path").schema and F.col("_metadata.file_path")
    except AnalysisException:  # several logs as one
        return m
    rows = files(m.sparkSession, path)
    judged = rows.join(small_side(starts), LOG, "left").select("commit", "file", F.coalesce(can_hold(F.col("start"), F.col("inclusive")), F.lit(True)).alias("needed"))
    out = [f"commit={r['commit']}/{r['file']}" for r in judged.where("not needed").select("commit", "file").collect()]
    if not out:
        return m
    return m.where(~F.concat(F.lit("commit="), F.substring_index(file, "/commit=", -1)).isin(out))
