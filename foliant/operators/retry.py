"""Retries of page corrections: classes of errors, delays, attempts and temperatures."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

RETRY_FREELY = ("error_429", "error_503")  # fixed values: statuses that use up no attempt
PACE_S, STEP, DAY_ID, MINUTE_ID = 60, 0.1, "PerDay", "PerMinute"


def error_status(code: Column) -> Column:
    return F.when(code == 429, "error_429").when(code == 503, "error_503").otherwise("error")


def extra_delay(code: Column, quota_id: Column, to_reset: Column) -> Column:
    """Seconds to wait besides those for the attempt: by code, and for a day's quota until its reset, or an hour if that is over 23 hours away."""
    a_day = F.coalesce(quota_id.contains(DAY_ID), F.lit(False))
    daily = F.when(to_reset > 23 * 3600, 3600).otherwise(to_reset)
    return F.when(code.isNull(), 0).when(code == 503, 120).when((code == 429) & a_day, daily).otherwise(60)


def retry_delay(attempt: Column, extra: Column) -> Column:
    return 60 * attempt + extra


def pace(elapsed: Column) -> Column:
    """Seconds to wait after a page that went through, so that pages are a minute apart."""
    return F.greatest(F.lit(float(PACE_S)) - elapsed, F.lit(0.0))


def temperatures(start: float, attempts: int, compat: bool = True) -> list[float]:
    """Temperature of each attempt.

    compat: each failed attempt's temperature is read again as the next one's start (0 as one step), and
    the attempt's own rise comes on top, so the rises add up; else each attempt is one step above the last.
    """
    out, base, saved = [], start, None
    for k in range(attempts):
        if compat and saved is not None:
            base = STEP if saved == 0 else saved
        t = min(1.0, base + STEP * k)
        out.append(t)
        saved = t
    return out


@dataclass
class Outcome:
    """What an attempt came to."""

    status: str
    extra: int = 0
    elapsed: float = 0.0
    text: str = ""


@dataclass
class Run:
    """The attempts at one page: statuses, temperatures and waits in order."""

    statuses: list[str] = field(default_factory=list)
    temperatures: list[float] = field(default_factory=list)
    waits: list[float] = field(default_factory=list)
    answers: list[str] = field(default_factory=list)
    text: str | None = None
    gave_up: bool = False


def outcome_of(e: Exception, to_reset: int) -> Outcome:
    """What a failed call comes to: by the ``code`` of its exception, and by the ``quota_id`` of one that names a quota."""
    code, quota = getattr(e, "code", None), getattr(e, "quota_id", None) or ""
    if code == 503:
        return Outcome("error_503", 120, text=str(e))
    if code == 429:
        return Outcome("error_429", (3600 if to_reset > 23 * 3600 else to_reset) if DAY_ID in quota else 60, text=str(e))
    return Outcome("error", 60 if code is not None else 0, text=str(e))


def correct_page(ask, start: float = 0.0, max_attempts: int = 1, compat: bool = True, most_calls: int = 1_000, sleep=None) -> Run:
    """Ask until a page is right: ``ask(temperature) -> Outcome``; waits are returned, and slept where ``sleep`` is given.

    Quota and overload errors use up no attempt; ``most_calls`` bounds all calls for a page, where compat is
    off. A delay of no seconds ends the page unfinished, as the workflow has it.
    """
    if not 0 <= start <= 1 or max_attempts < 1:
        raise ValueError("temperature in [0, 1] and at least one attempt")
    run, attempt, base, saved = Run(), 0, start, None

    def wait(seconds: float) -> None:
        run.waits.append(float(seconds))
        if sleep is not None and seconds > 0:
            sleep(seconds)

    while attempt < max_attempts and (compat or len(run.statuses) < most_calls):
        if compat and saved is not None:
            base = STEP if saved == 0 else saved
        t = min(1.0, base + STEP * attempt)
        got = ask(t)
        run.statuses.append(got.status)
        run.temperatures.append(t)
        run.answers.append(got.text)
        if got.status == "ok":
            run.text = got.text
            wait(max(0.0, PACE_S - got.elapsed))
            return run
        if got.status not in RETRY_FREELY:
            attempt += 1
            saved = t
        if attempt < max_attempts or got.status in RETRY_FREELY:
            seconds = 60 * attempt + got.extra
            if seconds == 0:
                break
            wait(seconds)
    run.gave_up = True
    return run
