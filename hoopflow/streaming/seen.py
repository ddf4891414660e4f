"""Messages delivered more than once, as a stream with a keyed state store of seen identifiers.

Every micro-batch commits one version: the new *hot* state (identifiers whose event time is within the watermark), the identifiers
that *expired* from it (added to an archive by season, where late arrivals are looked up), the numbers of the deliveries to
*drop*, and last a commit record that names the watermark, the hot state and the archive's segments. Only what a commit record
names is read, and a replayed batch overwrites its own version, so state and output are checkpointed together. A delivery that
precedes the one kept so far takes its place, and the displaced one is dropped: the result doesn't depend on the order of arrival
or on the batches. The archive is merged by levels (``FAN`` segments of a level become one of the next), so there are few segments
and each identifier is rewritten a logarithmic number of times. What only older records than the last two name is deleted.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hoopflow.functions.ids import message_key, season_of
from hoopflow.operators.deliveries import never
from hoopflow.streaming.commits import CommitLog

STATE = "message string, at timestamp_ntz, id long"
FAN = 8


def deliveries(df: DataFrame) -> DataFrame:
    """message, at, id of each delivery that names a message; null identifiers name none and are never dropped."""
    return df.where(F.col("game_player_id").isNotNull() & F.col("delivery_id").isNotNull()).select(
        message_key(F.col("game_player_id")).alias("message"),
        F.coalesce(F.col("loaded_at").cast("timestamp_ntz"), never()).alias("at"),
        F.col("delivery_id").cast("long").alias("id"),
    )


class SeenStore:
    """The versioned state of one stream in a folder that all executors share."""

    def __init__(self, spark: SparkSession, base: str, keep_days: int = 30) -> None:
        self.spark, self.base, self.keep_days = spark, base.rstrip("/"), keep_days
        self.log = CommitLog(spark, base)

    def versions(self) -> list[int]:
        return self.log.versions()

    def record(self, version: int) -> dict:
        """watermark, hot (a folder), and archive ([level, folder] of each segment) of a committed version."""
        return self.log.record(version)

    def _state(self, folder: str | None) -> DataFrame:
        if folder is None:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(f"{self.base}/{folder}")

    def archived(self, segments: list) -> DataFrame:
        """message, at, id, season of the archive's segments; seasons are folders, so a lookup opens only those it needs."""
        rows = self.spark.createDataFrame([], STATE + ", season string")
        for _, folder in segments:
            at = f"{self.base}/{folder}"
            rows = rows.unionByName(self.spark.read.schema(STATE + ", season string").option("basePath", at).parquet(at))
        return rows

    def process(self, batch: DataFrame, version: int) -> None:
        """One micro-batch: drop list, next state and commit. The batch is read twice: for its messages, and for the copies among them."""
        done = [v for v in self.versions() if v < version]
        last = self.record(done[-1]) if done else {"watermark": "", "hot": None, "archive": []}
        new = deliveries(batch)
        newest = F.max(F.when(F.col("at") < never(), F.col("at")))
        first = new.groupBy("message").agg(F.min(F.struct("at", "id")).alias("first"), F.count(F.lit(1)).alias("n"), newest.alias("newest")).persist()
        # Seasons are few; they prune the archive's folders for the late-arrival lookup.
        seasons = first.select(season_of(F.col("message")).alias("season")).distinct()
        hot = self._state(last["hot"])
        seen = hot.select("message", F.struct("at", "id").alias("seen"))
        if last["archive"]:
            late = self.archived(last["archive"]).join(seasons, "season", "left_semi").select("message", F.struct("at", "id").alias("seen"))
            seen = seen.unionByName(late)
        known = first.join(seen.groupBy("message").agg(F.min("seen").alias("seen")), "message", "left") if done else first.withColumn("seen", F.lit(None).cast("struct<at: timestamp_ntz, id: long>"))
        again = known.where("n > 1 or seen is not null").select("message", "seen", F.least("first", "seen").alias("kept"))
        repeated = new.join(again.select("message", "kept"), "message").where("id != kept.id").select("id")
        displaced = again.where("seen.id != kept.id").select(F.col("seen.id").alias("id"))
        repeated.unionByName(displaced).write.mode("overwrite").parquet(f"{self.base}/dropped/v={version}")

        # Rows are only ever added to the state; of several rows of one message the smallest counts.
        entries = known.where("seen is null or first < seen").select("message", "first.at", "first.id").unionByName(hot)
        top = first.agg(F.max("newest").alias("t")).first()["t"]
        mark = max(last["watermark"], str(top - timedelta(days=self.keep_days)) if top else "")
        live = F.col("at") >= F.lit(mark).cast("timestamp_ntz") if mark else F.lit(True)
        entries.where(live).write.mode("overwrite").parquet(f"{self.base}/hot/v={version}")
        gone = entries.where(~live).withColumn("season", season_of(F.col("message")))
        gone.hint("rebalance", "season").write.mode("overwrite").partitionBy("season").parquet(f"{self.base}/expired/v={version}")
        segments = [*last["archive"], [0, f"expired/v={version}"]]
        self.log.commit(version, {"watermark": mark, "hot": f"hot/v={version}", "archive": self._merged(segments, version)})
        self._clean(version)
        first.unpersist()

    def _merged(self, segments: list, version: int) -> list:
        """The segments after merging; a merged segment is a new folder, the old ones stay until no kept record names them."""
        level = 0
        while len(full := [s for s in segments if s[0] == level]) >= FAN:
            folder = f"expired/v={version}-level={level + 1}"
            self.archived(full).hint("rebalance", "season").write.mode("overwrite").partitionBy("season").parquet(f"{self.base}/{folder}")
            segments = [s for s in segments if s[0] != level] + [[level + 1, folder]]
            level += 1
        return segments

    def _clean(self, version: int) -> None:
        """Deletes hot states and archive segments that neither of the last two records names."""
        kept = [self.record(v) for v in [v for v in self.versions() if v <= version][-2:]]
        named = {r["hot"] for r in kept} | {s[1] for r in kept for s in r["archive"]}
        for kind in ("hot", "expired"):
            self.log.keep_only(kind, named)

    def dropped(self) -> DataFrame:
        """The deliveries to drop, from committed versions; each occurs once."""
        paths = [f"{self.base}/dropped/v={v}" for v in self.versions()]
        frame = self.spark.read.schema("id long").parquet(*paths) if paths else self.spark.createDataFrame([], "id long")
        return frame.select(F.col("id").alias("delivery_id")).distinct()


def drop_repeats(spark: SparkSession, path: str, base: str, keep_days: int = 30, bytes_per_batch: int = 512 << 20, files_per_batch: int | None = None, schema: StructType | None = None) -> DataFrame:
    """Runs the stream over all files at ``path`` to its end and returns the deliveries to drop.

    Equal loading times are decided by the smaller delivery number; a null loading time comes last. An empty table gives no rows.
    A second call with the same ``base`` continues from the checkpoint and reads only new files.
    """
    schema = schema or spark.read.parquet(path).select("game_player_id", "delivery_id", "loaded_at").schema
    store = SeenStore(spark, base, keep_days)
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader.option("maxBytesPerTrigger", bytes_per_batch)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isFile():
        stream = reader.option("pathGlobFilter", hadoop.getName()).parquet(str(hadoop.getParent()))
    else:
        stream = reader.option("recursiveFileLookup", "true").parquet(path)
    query = (
        stream.writeStream.foreachBatch(lambda df, i: store.process(df, i))
        .option("checkpointLocation", f"{store.base}/offsets")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store.dropped()


def land_by_arrival(box: DataFrame, folder: str, periods: int = 4) -> int:
    """Lays a table's deliveries out as they came in: ``periods`` stretches of loading time with about as many rows each, deliveries
    without a loading time in the last. Returns how many files a stretch has at most, 0 for an empty table.

    The stream takes files by their time of modification, so the stretches get rising ones. Where a file system can't set them they
    come in another order; the result is the same, only more identifiers are looked up in the archive.
    """
    spark = box.sparkSession
    at = F.unix_micros(F.col("loaded_at").cast("timestamp"))
    edges = box.agg(F.percentile_approx(at, [k / periods for k in range(1, periods)], 1000).alias("e")).first()["e"] or []
    period = sum((F.when(F.coalesce(at, F.lit(1 << 62)) > e, 1).otherwise(0) for e in edges), F.lit(0))
    box.select("game_player_id", "delivery_id", "loaded_at", period.alias("period")).write.mode("overwrite").partitionBy("period").parquet(folder)
    fs = spark._jvm.org.apache.hadoop.fs
    top = fs.Path(folder)
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    most = 0
    for p in (s.getPath() for s in system.listStatus(top) if s.isDirectory()):
        files = [f.getPath() for f in system.listStatus(p) if f.getPath().getName().endswith(".parquet")]
        most = max(most, len(files))
        for f in files:
            system.setTimes(f, 1_000_000_000_000 + 60_000 * int(p.getName().partition("=")[2]), -1)
    return most


def repeats(box: DataFrame, base: str, periods: int = 4) -> DataFrame:
    """The deliveries to drop from a whole table: it lands in stretches of loading time, and the stream takes about one a batch."""
    files = land_by_arrival(box, f"{base}/landed", periods)
    schema = box.select("game_player_id", "delivery_id", "loaded_at").schema
    return drop_repeats(box.sparkSession, f"{base}/landed", base, files_per_batch=files, schema=schema) if files else SeenStore(box.sparkSession, base).dropped()
