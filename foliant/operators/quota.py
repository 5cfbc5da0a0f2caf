"""Request quotas: sliding minutes, days with a local reset, and admission in order of time."""

from __future__ import annotations

import datetime as dt
from collections import deque
from collections.abc import Callable, Iterator
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MINUTE_US, HOUR_US = 60_000_000, 3_600_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def rolling_minute(calls: DataFrame, model: str = "model", ts: str = "ts", tokens: str = "tokens") -> DataFrame:
    """Calls with requests and tokens of their model in the 60 seconds up to and with each.

    A model may make any share of the calls: its time is cut into hours, and the calls of an hour's last
    minute are also shown to the next hour, where they count but give no row. Null times give no row.
    """
    w = Window.partitionBy(model, "_hour").orderBy("_us").rangeBetween(-(MINUTE_US - 1), 0)
    d = calls.withColumn("_us", micros(F.col(ts))).withColumn("_own", F.floor(F.col("_us") / HOUR_US)).filter(F.col("_us").isNotNull())
    late = F.pmod("_us", F.lit(HOUR_US)) >= HOUR_US - MINUTE_US
    d = d.withColumn("_hour", F.explode(F.when(late, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array("_own"))))
    d = d.withColumn("requests_60s", F.count("*").over(w)).withColumn("tokens_60s", F.coalesce(F.sum(tokens).over(w), F.lit(0)))
    return d.filter(F.col("_hour") == F.col("_own")).drop("_us", "_own", "_hour")


def quota_day(ts: Column, reset_time: Column, zone: Column) -> Column:
    """The local date on which the quota day of a moment began: days begin at the reset's wall clock time."""
    local = F.from_utc_timestamp(ts.cast("timestamp"), F.coalesce(zone, F.lit("UTC")))
    minutes = F.split(reset_time, ":")[0].cast("int") * 60 + F.split(reset_time, ":")[1].cast("int")
    return F.to_date(F.timestamp_micros(F.unix_micros(local) - minutes.cast("long") * MINUTE_US))


def next_reset(ts: Column, reset_time: Column, zone: Column) -> Column:
    """The next reset after a moment, in UTC; null without a reset time."""
    hour = F.concat_ws(" ", F.date_add(quota_day(ts, reset_time, zone), 1).cast("string"), F.concat(reset_time, F.lit(":00")))
    return F.when(reset_time.isNotNull(), F.to_utc_timestamp(hour.cast("timestamp"), F.coalesce(zone, F.lit("UTC"))))


def seconds_to_reset(ts: Column, reset_time: Column, zone: Column, compat: bool = True) -> Column:
    """Whole seconds to the next reset, at least 0; 60 where it isn't known.

    compat: by the wall clock, so an hour off on days of a clock change; else by elapsed time.
    """
    z = F.coalesce(zone, F.lit("UTC"))
    us = lambda c: F.unix_micros(c)
    reset = next_reset(ts, reset_time, zone)
    elapsed = us(F.from_utc_timestamp(reset, z)) - us(F.from_utc_timestamp(ts.cast("timestamp"), z)) if compat else us(reset) - us(ts.cast("timestamp"))
    return F.when(reset.isNull(), 60).otherwise(F.greatest((elapsed / 1_000_000).cast("int"), F.lit(0)))


def daily_use(calls: DataFrame, quotas: DataFrame) -> DataFrame:
    """model, day, requests, tokens, limit, rejected: use of each quota day against requests_per_day.

    A model without such a quota counts by UTC days and has no limit. The quota table is small by nature.
    """
    q = quotas.filter(F.col("quota_type") == "requests_per_day").select("model", F.col("quota_limit").alias("limit"), "reset_time", "reset_timezone")
    d = calls.join(q, "model", "left").withColumn("day", quota_day(F.col("ts"), F.coalesce("reset_time", F.lit("00:00")), F.col("reset_timezone")))
    g = d.groupBy("model", "day").agg(F.count("*").alias("requests"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.max("limit").alias("limit"))
    return g.withColumn("rejected", F.coalesce(F.greatest(F.col("requests") - F.col("limit"), F.lit(0)), F.lit(0)))


ADMISSION = T.StructType([
    T.StructField("call_id", T.LongType()), T.StructField("model", T.StringType()), T.StructField("admitted", T.BooleanType()), T.StructField("reason", T.StringType()), T.StructField("waited_s", T.IntegerType()), T.StructField("starts_us", T.LongType()),
])


class Gate:
    """Admission of one model's calls, one after the other: waits a minute where a minute's quota is full."""

    def __init__(self, limits: dict[str, int]):
        self.limits = limits
        self.minute: deque[tuple[int, int]] = deque()
        self.minute_tokens = 0
        self.day: object = None
        self.day_requests = self.day_tokens = 0
        self.free_us = 0

    def _forget(self, now: int) -> None:
        while self.minute and now - self.minute[0][0] >= MINUTE_US:
            self.minute_tokens -= self.minute.popleft()[1]

    def ask(self, at: int, day: object, tokens: int) -> tuple[bool, str, int, int]:
        """(admitted, reason, seconds to wait, when it starts) of a call; nothing is counted yet, a wait delays the ones behind it."""
        now, waited = max(at, self.free_us), 0
        if day != self.day:
            self.day, self.day_requests, self.day_tokens = day, 0, 0
        self._forget(now)
        limit = self.limits.get
        if (n := limit("requests_per_minute")) is not None and len(self.minute) >= n:
            now, waited = now + MINUTE_US, waited + 60
            self._forget(now)
        if tokens > 0 and (n := limit("tokens_per_minute")) is not None and self.minute_tokens + tokens > n:
            now, waited = now + MINUTE_US, waited + 60
            self._forget(now)
        self.free_us = now
        if tokens > 0 and (n := limit("tokens_per_request")) is not None and tokens > n:
            return False, "tokens_per_request", waited, now
        if (n := limit("requests_per_day")) is not None and self.day_requests >= n:
            return False, "requests_per_day", waited, now
        if tokens > 0 and (n := limit("tokens_per_day")) is not None and self.day_tokens + tokens > n:
            return False, "tokens_per_day", waited, now
        return True, "ok", waited, now

    def record(self, now: int, tokens: int) -> None:
        """Counts a call that went through."""
        self.minute.append((now, tokens))
        self.minute_tokens += tokens
        self.day_requests += 1
        self.day_tokens += tokens

    def call(self, at: int, day: object, tokens: int) -> tuple[bool, str, int, int]:
        """The gate's answer to a call that goes through if it is admitted."""
        got = self.ask(at, day, tokens)
        if got[0]:
            self.record(got[3], tokens)
        return got


def local_day(at: float, reset_time: str | None, zone: str | None) -> dt.date:
    """The quota day of a moment (seconds since 1970), as ``quota_day`` has it for columns."""
    hours, _, minutes = (reset_time or "00:00").partition(":")
    local = dt.datetime.fromtimestamp(at, ZoneInfo(zone or "UTC")).replace(tzinfo=None)
    return (local - dt.timedelta(hours=int(hours), minutes=int(minutes or 0))).date()


def seconds_until_reset(at: float, reset_time: str | None, zone: str | None) -> int:
    """Whole seconds to the next reset by the wall clock; 60 where none is set."""
    if not reset_time:
        return 60
    hours, _, minutes = reset_time.partition(":")
    local = dt.datetime.fromtimestamp(at, ZoneInfo(zone or "UTC")).replace(tzinfo=None)
    reset = dt.datetime.combine(local_day(at, reset_time, zone) + dt.timedelta(days=1), dt.time(int(hours), int(minutes or 0)))
    return max(0, int((reset - local).total_seconds()))


class Turnstile:
    """A model's gate with a clock: waits where a minute's quota is full, refuses beyond the others, counts what went through."""

    def __init__(self, rows: list[tuple[str, int, str | None, str | None]], now: Callable[[], float], sleep: Callable[[float], None]):
        """rows: quota_type, limit, reset_time, zone of one model; without any, every call is let through."""
        self.gate = Gate({q: n for q, n, _, _ in rows})
        self.resets = {q: (r, z) for q, _, r, z in rows}
        self.now, self.sleep = now, sleep

    def enter(self, tokens: int = 0) -> str:
        """``ok``, or the quota that refuses the call."""
        at = self.now()
        admitted, reason, wait, _ = self.gate.ask(int(at * 1e6), local_day(at, *self.resets.get("requests_per_day", (None, None))), tokens)
        if wait:
            self.sleep(wait)
        return "ok" if admitted else reason

    def went_through(self, tokens: int = 0) -> None:
        self.gate.record(int(self.now() * 1e6), tokens)

    def to_reset(self) -> int:
        return seconds_until_reset(self.now(), *self.resets.get("requests_per_day", (None, None)))


def admissions(calls: DataFrame, quotas: DataFrame, use_tokens: bool = True) -> DataFrame:
    """call_id, model, admitted, reason, waited_s, starts_us of each call, in order of time.

    Each decision depends on all before it of the same model, which is what the gate models: calls come
    sorted to one task per model and stream through it in Arrow batches, with a minute's calls in memory.
    Models without quotas are admitted at once and never grouped. use_tokens=False leaves all token quotas
    without effect.
    """
    limits: dict[str, dict[str, int]] = {}
    for r in quotas.select("model", "quota_type", "quota_limit").collect():  # a configuration file
        limits.setdefault(r.model, {})[r.quota_type] = r.quota_limit
    daily = quotas.filter(F.col("quota_type") == "requests_per_day").select("model", "reset_time", "reset_timezone")
    d = calls.select("call_id", "model", "ts", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens")).filter(F.col("ts").isNotNull())
    d = d.join(daily, "model", "left").withColumn("us", micros(F.col("ts"))).withColumn("day", quota_day(F.col("ts"), F.col("reset_time"), F.col("reset_timezone")).cast("string"))
    known = F.coalesce(F.col("model").isin(*limits), F.lit(False)) if limits else F.lit(False)
    free = d.filter(~known).select("call_id", "model", F.lit(True).alias("admitted"), F.lit("no quota").alias("reason"), F.lit(0).alias("waited_s"), F.col("us").alias("starts_us"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gates: dict[str, Gate] = {}
        for b in batches:
            rows = []
            for call_id, model, us, day, tokens in zip(b["call_id"], b["model"], b["us"], b["day"], b["tokens"], strict=True):
                gate = gates.setdefault(model, Gate(limits[model]))
                rows.append((call_id, model, *gate.call(us, day, tokens if use_tokens else 0)))
            yield pd.DataFrame(rows, columns=ADMISSION.names)

    ordered = d.filter(known).select("call_id", "model", "us", "day", "tokens").repartition("model").sortWithinPartitions("model", "us", "call_id")
    return ordered.mapInPandas(run, ADMISSION).unionByName(free)
