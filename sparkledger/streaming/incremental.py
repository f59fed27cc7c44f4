"""Incremental ledgers with Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType


def read_new_files(spark: SparkSession, path: str, schema: StructType, glob: str | None = None) -> DataFrame:
    """Each file once, as it comes."""
    reader = spark.readStream.schema(schema)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(path)


def once(stream: DataFrame, key: str, time: str, late: str = "3 days") -> DataFrame:
    """Rows whose key was not there within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def daily_totals(stream: DataFrame, time: str, value: str, late: str = "3 days") -> DataFrame:
    """Rows and sum by day."""
    days = stream.withWatermark(time, late).groupBy(F.window(time, "1 day").alias("w"))
    return days.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.to_date("w.start").alias("day"), "n", "total")


def leg_candidates(outs: DataFrame, ins: DataFrame, days: int = 3) -> DataFrame:
    """Possible pairs of two streams of legs (leg_id, ts, cents, src, dst) within ``days``; choosing one to one is a batch step."""
    a = outs.withWatermark("ts", f"{days} days").selectExpr("leg_id AS left_id", "ts AS lts", "cents", "src", "dst")
    b = ins.withWatermark("ts", f"{days} days").selectExpr("leg_id AS right_id", "ts AS rts", "cents AS c2", "src AS s2", "dst AS d2")
    on = F.expr(f"cents = c2 AND src = s2 AND dst = d2 AND rts BETWEEN lts - INTERVAL {days} DAYS AND lts + INTERVAL {days} DAYS")
    return a.join(b, on).select("left_id", "right_id", "lts", "rts")


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Takes in all that is there, ends, and returns the table; with mode complete its last state."""
    spark = stream.sparkSession
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    else:
        save = lambda batch, _: batch.write.mode("overwrite").parquet(path)
        query = stream.writeStream.foreachBatch(save).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(path)


def review_queue(stream: DataFrame, path: str, checkpoint: str, resolve) -> None:
    """Each batch is joined with what was open; ``resolve(open_rows)`` gives the rows that stay open.

    A new version of the queue is written beside the old one, and a batch that runs again writes its own version again.
    """
    spark = stream.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        waiting = batch if number == 0 else batch.unionByName(spark.read.parquet(f"{path}/v={number - 1}"))
        resolve(waiting).write.mode("overwrite").parquet(f"{path}/v={number}")

    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


#: What a review log holds for each item, and the store that keyed state with timers needs.  Times are microseconds until the end.
REVIEW = "key string, status string, cents long, opened long, at long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY = 86_400_000_000


class _Review(StatefulProcessor):
    """One key's item: when it was opened, its amount, its earliest answer, and whether it was closed.

    A timer at the item's deadline (an answer's without an item) expires what is open and forgets the key.
    """

    def __init__(self, wait: int):
        self.wait = wait

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("review", "opened long, cents long, answered long, closed boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.state.get() if self.state.exists() else None
        opened, cents, answered, closed = known or (None, None, None, False)
        before, first = answered if opened is None else opened, None
        for row in rows:  # only the earliest of either kind is kept, however many rows a key has
            if row.is_answer:
                answered = row.us if answered is None else min(answered, row.us)
            else:
                place = row.us, row.cents is None, row.cents or 0
                first = place if first is None else min(first, place)
        if opened is None and first is not None:
            opened, cents = first[0], None if first[1] else first[2]
            yield Row(key=key[0], status="OPEN", cents=cents, opened=opened, at=opened)
        if opened is not None and not closed and answered is not None and answered <= opened + self.wait:
            closed = True
            yield Row(key=key[0], status="RESOLVED", cents=cents, opened=opened, at=answered)
        now = answered if opened is None else opened
        if before != now:
            if before is not None:
                self.handle.deleteTimer((before + self.wait) // 1000)
            self.handle.registerTimer((now + self.wait) // 1000)
        self.state.update((opened, cents, answered, closed))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists():
            opened, cents, _, closed = self.state.get()
            if opened is not None and not closed:
                yield Row(key=key[0], status="EXPIRED", cents=cents, opened=opened, at=opened + self.wait)
            self.state.clear()

    def close(self) -> None:
        pass


def review_log(items: DataFrame, answers: DataFrame, days: int, late: str = "1 day") -> DataFrame:
    """A stream of what becomes of items (key, ts, cents) that wait for answers (key, ts): key, status, cents, opened, at.

    An item is OPEN when its key is first seen; of several in a batch the earliest counts, and further ones are the same item
    until its deadline, ``days`` after it was opened.  An answer up to the deadline, or one from before the item that is still
    kept, resolves it; answers are kept for ``days``.  Else it is EXPIRED once the watermark has passed the deadline.  A batch
    reads and writes the state of its own keys only.  Rows without a key or time take no part; rows behind the watermark are
    late and go.  The state store must be RocksDB: see ``run_review``.
    """
    a = items.select(F.col("key").cast("string").alias("key"), "ts", F.col("cents").cast("long").alias("cents"), F.lit(False).alias("is_answer"))
    b = answers.select(F.col("key").cast("string").alias("key"), "ts", F.lit(None).cast("long").alias("cents"), F.lit(True).alias("is_answer"))
    rows = a.unionByName(b).where("key is not null and ts is not null").withWatermark("ts", late).withColumn("us", F.unix_micros("ts"))
    log = rows.groupBy("key").transformWithState(_Review(days * DAY), REVIEW, "Append", "EventTime")
    return log.select("key", "status", "cents", F.timestamp_micros("opened").alias("opened"), F.timestamp_micros("at").alias("at"))


def run_review(log: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Takes in all that is there and returns the log so far; a later call with the same places goes on from the kept state."""
    conf, name = log.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, ROCKS)
    try:
        return run_available(log, path, checkpoint)
    finally:
        conf.set(name, before) if before else conf.unset(name)


def review_status(log: DataFrame) -> DataFrame:
    """The last word on each item of a log: key, opened, cents, status, at."""
    last = F.max_by(F.struct("cents", "status", "at"), F.col("status") != "OPEN")
    return log.groupBy("key", "opened").agg(last.alias("_l")).select("key", "opened", "_l.*")


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """_path, _modified and length of all files below ``root``, without reading them."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return found.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_modification_time").alias("_modified"), F.col("_metadata.file_size").alias("length"))


def csv_rows(schema: str, glob: str = "*.csv"):
    """A reader for ``take_in``: rows of CSV files with a header; what does not fit the schema is broken."""

    def read(spark: SparkSession, root: str) -> DataFrame:
        rows = spark.read.schema(f"{schema}, _corrupt string").option("header", True).option("escape", '"').option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        rows = rows.option("columnNameOfCorruptRecord", "_corrupt").csv(root)
        return rows.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_modification_time").alias("_modified"), F.col("_corrupt").isNotNull().alias("_broken")).drop("_corrupt")

    return read


def _committed(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the batches whose log was written to its end."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/log/batch=*/_SUCCESS")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    return sorted(int(f.getPath().getParent().getName().removeprefix("batch=")) for f in found)


def file_log(spark: SparkSession, store: str) -> DataFrame | None:
    """All commits: _path, _modified, length, outcome (parsed, failed, empty), n, n_broken, batch; None before the first."""
    logs = [f"{store}/log/batch={k}" for k in _committed(spark, store)]
    return spark.read.option("basePath", f"{store}/log").parquet(*logs) if logs else None


def file_status(spark: SparkSession, store: str) -> DataFrame:
    """The last commit of each file."""
    log = file_log(spark, store)
    names = [c for c in log.columns if c != "_path"]
    return log.groupBy("_path").agg(F.max_by(F.struct(*names), "batch").alias("_l")).select("_path", "_l.*")


def take_in(spark: SparkSession, root: str, store: str, read, glob: str = "*.csv") -> int | None:
    """Takes in the files below ``root`` that are new or changed since their last commit; gives the batch's number, None if there are none.

    ``read(spark, root)`` gives rows with _path, _modified and _broken.  A file with a broken row has failed: it is reported, gives no
    rows, and is taken again once it was mended, that is, its time or length changed.  Rows are written below data/, then the
    batch's outcomes below log/; only the log makes a batch count, and a run that was cut short writes the same batch again, so
    each version of a file is taken exactly once.  One run at a time.
    """
    log = file_log(spark, store)
    files, done = list_files(spark, root, glob), _committed(spark, store)
    number = done[-1] + 1 if done else 0
    new = files if log is None else files.join(log.select("_path", "_modified", "length"), ["_path", "_modified", "length"], "left_anti")
    new.write.mode("overwrite").parquet(f"{store}/new/batch={number}")
    new = spark.read.parquet(f"{store}/new/batch={number}")
    oldest = new.agg(F.min("_modified").alias("m")).first()["m"]
    if oldest is None:
        return None
    # Files that were not changed since are not opened; of the others only new versions count.
    rows = read(spark, root).where(F.col("_modified") >= F.lit(oldest)).join(new.select("_path", "_modified"), ["_path", "_modified"], "left_semi")
    rows.write.mode("overwrite").parquet(f"{store}/data/batch={number}")
    counts = spark.read.parquet(f"{store}/data/batch={number}").groupBy("_path", "_modified").agg(F.count("*").alias("n"), F.count_if("_broken").alias("n_broken"))
    n, broken = F.coalesce("n", F.lit(0)), F.coalesce("n_broken", F.lit(0))
    outcome = F.when(n == 0, "empty").when(broken > 0, "failed").otherwise("parsed")
    said = new.join(counts, ["_path", "_modified"], "left").select("_path", "_modified", "length", outcome.alias("outcome"), n.alias("n"), broken.alias("n_broken"))
    said.write.mode("overwrite").parquet(f"{store}/log/batch={number}")
    return number


def taken(spark: SparkSession, store: str) -> DataFrame:
    """The rows of all files as last committed, with their _path; files whose last outcome is not ``parsed`` have none."""
    data = spark.read.option("basePath", f"{store}/data").parquet(*[f"{store}/data/batch={k}" for k in _committed(spark, store)])
    last = file_status(spark, store).where("outcome = 'parsed'").select("_path", "_modified", "batch")
    return data.join(last, ["_path", "_modified", "batch"], "left_semi").drop("_broken", "_modified", "batch")
