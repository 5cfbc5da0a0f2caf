"""The quota rules over a stream of calls: requests and tokens of each model by minute and quota day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators.quota import MINUTE_US


def minute_use(calls: DataFrame, late: str = "10 minutes", slide: str = "10 seconds") -> DataFrame:
    """model, start, end, requests, tokens of each sliding minute; calls later than ``late`` are left out, deliveries of one call count once."""
    once = calls.withWatermark("ts", late).dropDuplicatesWithinWatermark(["call_id"])
    g = once.groupBy("model", F.window("ts", "1 minute", slide)).agg(F.count("*").alias("requests"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    return g.select("model", F.col("window.start").alias("start"), F.col("window.end").alias("end"), "requests", "tokens")


def day_use(calls: DataFrame, quotas: DataFrame, late: str = "2 days") -> DataFrame:
    """model, day, requests, tokens, limit, over of each quota day so far; the quota table is static.

    Days are windows over the model's own clock, set back by its reset time, and the watermark is that
    clock's: a day's state is dropped when it is over by ``late``, which covers the zones' distance.
    """
    q = quotas.filter(F.col("quota_type") == "requests_per_day").select("model", F.col("quota_limit").alias("limit"), "reset_time", "reset_timezone")
    minutes = F.coalesce(F.split("reset_time", ":")[0].cast("int") * 60 + F.split("reset_time", ":")[1].cast("int"), F.lit(0))
    local = F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.coalesce("reset_timezone", F.lit("UTC")))
    own = F.timestamp_micros(F.unix_micros(local) - minutes.cast("long") * MINUTE_US)
    d = calls.join(q, "model", "left").withColumn("own", own).withWatermark("own", late).dropDuplicatesWithinWatermark(["call_id"])
    g = d.groupBy("model", F.window("own", "1 day")).agg(F.count("*").alias("requests"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.max("limit").alias("limit"))
    return g.select("model", F.to_date("window.start").alias("day"), "requests", "tokens", "limit", F.coalesce(F.col("requests") > F.col("limit"), F.lit(False)).alias("over"))
