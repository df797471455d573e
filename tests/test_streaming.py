"""Streaming slices against their batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from orestead.streaming import candidates

SF = "/root/testdata/sf0.001/events.parquet"


def test_ledger_equals_batch(spark, tmp_path):
    events = spark.read.parquet(SF)
    for i in range(3):
        events.where(F.col("event_id") % 3 == i).write.parquet(str(tmp_path / f"in/part={i}"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    ledger = candidates.Ledger(str(tmp_path / "out"), ["user_id", "event_type"], "event_id")
    q = stream.writeStream.foreachBatch(ledger).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    keys = events.select("user_id", "event_type").distinct()
    assert ledger.table(spark).count() == keys.count() == ledger.table(spark).select("user_id", "event_type").distinct().count()


def test_first_seen_stream(spark):
    events = spark.read.parquet(SF)
    stream = spark.readStream.schema(events.schema).parquet(SF.replace("events.parquet", "event[s].parquet"))
    q = candidates.first_seen(stream, ["user_id"], delay="1000 days").writeStream.format("memory").queryName("seen").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("seen").count() == events.select("user_id").distinct().count()


def test_ledger_goes_on_after_a_restart(spark, tmp_path):
    rows = lambda *ids: spark.createDataFrame([(i, 10 * i + 1) for i in ids], "k long, at long")
    path = str(tmp_path / "ledger")
    candidates.Ledger(path, ["k"], "at")(rows(1, 2), 0)
    candidates.Ledger(path, ["k"], "at")(rows(2, 3), 1)  # a new driver
    candidates.Ledger(path, ["k"], "at")(rows(2, 3), 1)  # the same batch again
    (tmp_path / "ledger" / "2").mkdir()  # a version that wasn't finished
    candidates.Ledger(path, ["k"], "at")(rows(4), 2)
    assert sorted(r.k for r in candidates.Ledger(path, ["k"], "at").table(spark).collect()) == [1, 2, 3, 4]
