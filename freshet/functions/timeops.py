"""Time columns: parsing, bucket ends, alignment, zones, forecast cycles, windows and axes.

Stations keep local time without a zone, grids keep UTC without a zone; only the functions here convert.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Sao_Paulo"
#: Hours at which forecasts start.
CYCLE_HOURS = (0, 6, 12, 18)


def check_timestep(hours: int) -> int:
    if hours < 1 or 24 % hours:
        raise ValueError(f"a timestep must divide 24 hours: {hours}")
    return hours


def day(ts: Column) -> Column:
    """Midnight of the day."""
    return F.to_date(ts).cast("timestamp_ntz")


def minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def plus_hours(ts: Column, hours: Column | int) -> Column:
    return (ts + F.make_dt_interval(F.lit(0), F.lit(hours) if isinstance(hours, int) else hours.cast("int"))).cast("timestamp_ntz")


def hours_between(start: Column, end: Column) -> Column:
    """Whole and part hours from start to end."""
    return F.timestamp_diff("SECOND", start, end) / 3600.0


_OFFSET = r"(?:Z|[+-]\d{2}:?\d{2})$"


def _with_offset(text: Column) -> Column:
    """An ISO text with Z or an offset as UTC without zone: the wall time less the offset."""
    wall = F.try_to_timestamp(F.regexp_replace(F.regexp_replace(text, _OFFSET, ""), "T", " ")).cast("timestamp_ntz")
    sign = F.when(F.regexp_extract(text, r"([+-])\d{2}:?\d{2}$", 1) == "-", -1).otherwise(1)
    hours = F.coalesce(F.try_cast(F.nullif(F.regexp_extract(text, r"[+-](\d{2}):?\d{2}$", 1), F.lit("")), "int") if hasattr(F, "try_cast") else F.nullif(F.regexp_extract(text, r"[+-](\d{2}):?\d{2}$", 1), F.lit("")).cast("int"), F.lit(0))
    minutes = F.coalesce(F.nullif(F.regexp_extract(text, r"[+-]\d{2}:?(\d{2})$", 1), F.lit("")).cast("int"), F.lit(0))
    return (wall - F.make_dt_interval(F.lit(0), sign * hours, sign * minutes)).cast("timestamp_ntz")


def to_naive_utc(text: Column) -> Column:
    """Text with an offset as UTC, text without one as it is, text that is no time as null."""
    t = F.trim(text)
    return F.when(t.rlike(_OFFSET) & t.rlike(r"\d:\d"), _with_offset(t)).otherwise(F.try_to_timestamp(F.regexp_replace(t, "T", " ")).cast("timestamp_ntz"))


def utc_to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def local_to_utc(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def parse_observed(text: Column, zone: str = LOCAL_ZONE) -> Column:
    """ISO or ``yyyy-MM-dd HH:mm[:ss]`` as local minutes; an offset or Z is converted; null where it is no time."""
    t = F.trim(text)
    offset = t.rlike(_OFFSET) & t.rlike(r"\d:\d")
    return minute(F.when(offset, utc_to_local(_with_offset(t), zone)).otherwise(to_naive_utc(t)))


def parse_provider(text: Column, zone: str = LOCAL_ZONE) -> Column:
    """As :func:`parse_observed`, and also ``dd/MM/yyyy HH:mm[:ss]`` and milliseconds since 1970 (UTC)."""
    t = F.trim(text)
    epoch = utc_to_local(F.timestamp_millis(F.when(t.rlike(r"^-?\d{9,}$"), t.cast("bigint"))).cast("timestamp_ntz"), zone)
    dashed = F.regexp_replace(t, r"^(\d{2})/(\d{2})/(\d{4})", "$3-$2-$1")
    return F.when(t.rlike(r"^-?\d{9,}$"), minute(epoch)).otherwise(parse_observed(dashed, zone))


def bucket_end(ts: Column, timestep_hours: int) -> Column:
    """End of the right-closed timestep, counted from midnight, that holds the minute; an edge is its own end."""
    step = 60 * check_timestep(timestep_hours)
    t = minute(ts)
    return plus_hours(day(t), F.ceil((F.hour(t) * 60 + F.minute(t)) / step) * timestep_hours)


def is_aligned(ts: Column, timestep_hours: int) -> Column:
    """Whether a time is a whole hour that the timestep divides."""
    whole = F.date_trunc("hour", ts).cast("timestamp_ntz")
    return (ts == whole) & (F.hour(ts) % check_timestep(timestep_hours) == 0)


def misaligned(df: DataFrame, column: str, timestep_hours: int) -> DataFrame:
    """``n, first``: how many times aren't aligned, and the earliest of them."""
    return df.where(~is_aligned(F.col(column), timestep_hours)).agg(F.count("*").alias("n"), F.min(column).alias("first"))


def forecast_cycle(utc: Column, cycle_hours: tuple[int, ...] = CYCLE_HOURS) -> Column:
    """Latest cycle start at or before a UTC time: today's last hour so far, else the last hour of the day before."""
    hours = sorted(set(cycle_hours))
    today = F.array_max(F.filter(F.array(*map(F.lit, hours)), lambda h: h <= F.hour(utc)))
    return plus_hours(day(utc), F.coalesce(today, F.lit(hours[-1] - 24)))


def cycle_candidates(df: DataFrame, cycle: str, lookback: int = 12, cycle_hours: tuple[int, ...] = CYCLE_HOURS) -> DataFrame:
    """A row for each of the ``lookback`` latest cycles at or before ``cycle``: ``candidate, rank`` (0 is the newest).

    Hours needn't be regular: candidates come from days x hours.
    """
    hours = sorted(set(cycle_hours), reverse=True)
    days = -(-lookback // len(hours)) + 1
    grid = F.expr(f"flatten(transform(sequence(0, {days}), d -> transform(array({', '.join(map(str, hours))}), h -> h - 24 * d)))")
    shifted = F.transform(grid, lambda h: plus_hours(day(F.col(cycle)), h))
    kept = F.slice(F.filter(shifted, lambda c: c <= F.col(cycle)), 1, lookback)
    return df.select("*", F.posexplode(kept).alias("rank", "candidate"))


def axis(start: Column, end: Column, timestep_hours: int) -> Column:
    """Array of the times from start to end, both included, one timestep apart."""
    steps = F.floor(F.timestamp_diff("HOUR", start, end) / timestep_hours)
    return F.when(steps >= 0, F.transform(F.sequence(F.lit(0), steps.cast("int")), lambda i: plus_hours(start, i * timestep_hours))).otherwise(F.array().cast("array<timestamp_ntz>"))


def horizon_window(reference: Column, days_before: int, horizon_days: int, timestep_hours: int) -> list[Column]:
    """``start_time, forecast_start, end_time, nt, forecast_nt`` of a run at a local reference time.

    It starts at midnight ``days_before`` days before and ends ``horizon_days`` after the first forecast step, which is one
    timestep after the reference. Without a horizon there are no forecast steps.
    """
    check_timestep(timestep_hours)
    start = (F.date_sub(F.to_date(reference), days_before)).cast("timestamp_ntz")
    first = plus_hours(reference, timestep_hours)
    n = horizon_days * 24 // timestep_hours + 1 if horizon_days > 0 else 0
    end = plus_hours(first, (n - 1) * timestep_hours) if n else reference
    nt = (F.timestamp_diff("HOUR", start, end) / timestep_hours).cast("long") + 1
    return [start.alias("start_time"), first.alias("forecast_start"), end.alias("end_time"), nt.alias("nt"), F.lit(n).cast("long").alias("forecast_nt")]


def analysis_window(reference: Column, input_days: int, horizon_days: int) -> list[Column]:
    """``start_time, cutoff_time, forecast_end``: days before the reference day, the reference, the end left out."""
    start = F.date_sub(F.to_date(reference), input_days).cast("timestamp_ntz")
    end = F.date_add(F.to_date(reference), horizon_days + 1).cast("timestamp_ntz")
    return [start.alias("start_time"), reference.alias("cutoff_time"), end.alias("forecast_end")]


def row_bounds(start: Column, first: Column, last: Column, timestep_hours: int, nt: Column) -> list[Column]:
    """``row_first, row_after``: rows of an axis of ``nt`` steps from ``start`` with times in [first, last), cut to the axis."""

    def offset(t: Column) -> Column:
        return F.ceil(F.timestamp_diff("SECOND", start, t) / (3600 * timestep_hours))

    low = F.greatest(offset(first), F.lit(0))
    return [low.cast("long").alias("row_first"), F.greatest(F.least(offset(last), nt), low).cast("long").alias("row_after")]


def segments(df: DataFrame, index: str, start: Column, reference: Column, timestep_hours: int) -> DataFrame:
    """Adds ``dt`` and ``time_segment`` to rows with a step index: 0 up to the reference, 1 after it."""
    current = F.timestamp_diff("HOUR", start, reference) / timestep_hours + 1
    return df.withColumns({"dt": plus_hours(start, F.col(index) * timestep_hours), "time_segment": F.when(F.col(index) < current, 0).otherwise(1)})


def request_days(start: Column, end: Column, latest: Column | None = None) -> Column:
    """Days from the later of the window's start and the latest day observed, to the window's end; both included."""
    first = F.to_date(start) if latest is None else F.greatest(F.to_date(start), F.to_date(latest))
    return F.when(first <= F.to_date(end), F.sequence(first, F.to_date(end))).otherwise(F.array().cast("array<date>"))


def last_days(reference: Column, days: int) -> Column:
    """The ``days`` calendar days that end with the reference's."""
    return F.sequence(F.date_sub(F.to_date(reference), days - 1), F.to_date(reference))
