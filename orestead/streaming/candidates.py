"""Structured Streaming slices: first-seen candidates, daily quotas and saturation over arriving queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _timed(stream: DataFrame, time: str) -> DataFrame:
    """Watermarks need a timestamp with a zone."""
    return stream.withColumn(time, F.col(time).cast("timestamp"))


def first_seen(stream: DataFrame, keys: list[str], time: str = "ts", delay: str = "1 day") -> DataFrame:
    """The first row of each key to arrive; a key is forgotten `delay` after the watermark has passed it, so state stays bounded."""
    return _timed(stream, time).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def daily_counts(stream: DataFrame, service: str, time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Requests by service and day, final once the watermark has passed the day."""
    day = F.window(time, "1 day")
    return _timed(stream, time).withWatermark(time, delay).groupBy(service, day).agg(F.count("*").alias("used")).select(service, F.col("window.start").cast("date").alias("day"), "used")


def over_quota(counts: DataFrame, limit: int) -> DataFrame:
    return counts.withColumn("refused", F.greatest(F.lit(0), F.col("used") - F.lit(limit)))


class Ledger:
    """A foreachBatch sink: merges each micro-batch's candidates into a table of first-seen keys, once per batch id.

    The table is kept as one folder per version, named by the batch id. A batch builds on the last version below it that
    was written to its end, as the storage shows it: so a driver that starts anew goes on with the history, and a batch
    that is run again replaces its own version.
    """

    def __init__(self, path: str, keys: list[str], order: str):
        self.path, self.keys, self.order = path.rstrip("/"), keys, order

    def _versions(self, spark: SparkSession) -> list[int]:
        at = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(at):
            return []
        found = [f.getPath() for f in system.listStatus(at)]
        done = [p.getName() for p in found if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(n) for n in done if n.isdigit())

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.groupBy(*self.keys).agg(F.min(self.order).alias(self.order))
        before = [v for v in self._versions(spark) if v < batch_id]
        if before:
            held = spark.read.parquet(f"{self.path}/{before[-1]}")
            fresh = held.unionByName(fresh.join(held.select(*self.keys), self.keys, "left_anti"))
        fresh.write.mode("overwrite").parquet(f"{self.path}/{batch_id}")

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{self._versions(spark)[-1]}")
