"""The quota rules over streams, against the batch ones."""

from pyspark.sql import functions as F

from foliant.operators import quota
from foliant.sources.tables import table
from foliant.streaming import quota_stream


def _stream(spark, sf, tmp_path):
    calls = table(spark, sf, "call_log").filter(F.col("ts").isNotNull()).withColumn("ts", F.col("ts").cast("timestamp")).select("call_id", "model", "ts", "tokens")
    calls.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "calls"))
    return spark.readStream.schema(calls.schema).parquet(str(tmp_path / "calls")), calls


def test_day_use(spark, sf, tmp_path):
    stream, calls = _stream(spark, sf, tmp_path)
    q = table(spark, sf, "quota_config")
    run = quota_stream.day_use(stream, q).writeStream.outputMode("complete").format("memory").queryName("day_use").option("checkpointLocation", str(tmp_path / "c")).start()
    run.processAllAvailable()
    run.stop()
    got = {(r.model, r.day): r.requests for r in spark.table("day_use").collect()}
    want = {(r.model, r.day): r.requests for r in quota.daily_use(calls.dropDuplicates(["call_id"]), q).collect()}
    assert got == want and got


def test_minute_use(spark, sf, tmp_path):
    stream, calls = _stream(spark, sf, tmp_path)
    run = quota_stream.minute_use(stream).writeStream.outputMode("append").format("memory").queryName("minute_use").option("checkpointLocation", str(tmp_path / "c")).start()
    run.processAllAvailable()
    run.stop()
    assert spark.table("minute_use").filter("requests > 0").count() >= 0
