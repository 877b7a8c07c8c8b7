"""Scalar column functions. All are built-in expressions; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
ORIGIN = "1970-01-01 00:00:00"

# Calendar of the simulated step counter.
EPOCH = "2023-01-01 00:00:00"
STEP_MINUTES = 60
FIRST_V2_STEP = 400
TRAFFIC_PERIODS = {"Payday": (168, 192), "Holiday": (336, 360)}

# Populations and shares of the generated attributes.
SEGMENTS = {"Student": 20, "Traveler": 15, "Business": 25, "High Spender": 15, "Family": 25}
DEVICE_TYPES = {"iPhone": 35, "Android": 35, "Web": 20, "Tablet": 10}
RISK_PROFILES = {"Low": 65, "Medium": 25, "High": 10}
DISPUTE_OUTCOMES = {"Approved": 70, "Denied": 20, "Under Review": 10}
OPERATING_SYSTEMS = {
    "iPhone": {"iOS 16": 1, "iOS 17": 1},
    "Android": {"Android 13": 1, "Android 14": 1},
    "Web": {"Chrome/Windows": 1, "Safari/macOS": 1, "Firefox/Linux": 1},
    "Tablet": {"iPadOS 16": 1, "Android 13": 1},
}

STRICT_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"
ZONED_TIME = r"([zZ]|[+-]\d{2}:?\d{2})$"


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone.

    ``ts`` occurs once in the expression, so nesting does not multiply it.
    """
    since = (ts - F.expr(f"timestamp_ntz'{ORIGIN}'")).cast("interval second")
    return (since.cast("decimal(20,6)") * MICROS).cast("bigint")


def from_micros(us: Column) -> Column:
    """Inverse of :func:`micros`."""
    seconds = us.cast("decimal(18,0)") * F.expr("0.000001")
    return F.expr(f"timestamp_ntz'{ORIGIN}'") + _seconds(seconds)


def _seconds(amount: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), amount.cast("decimal(18,6)"))


def whole_second(ts: Column) -> Column:
    """``ts`` without its fraction of a second."""
    return ts - _seconds(F.extract(F.lit("SECOND"), ts) % 1)


def plus_seconds(ts: Column, seconds: Column | int) -> Column:
    seconds = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return ts + _seconds(seconds)


def ntz_literal(time) -> Column:
    """A zone-less datetime as a column, whatever zones Python and the session are in."""
    return F.lit(None if time is None else time.isoformat(sep=" ")).cast("timestamp_ntz")


def strict_time(text: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` and nothing else; anything different is NULL."""
    return F.when(text.rlike(STRICT_TIME), text.try_cast("timestamp_ntz"))


def iso_time_utc(text: Column) -> Column:
    """Any ISO time. Without a zone it is UTC; with one it is converted to UTC."""
    since_1970 = F.unix_micros(text.try_cast("timestamp"))
    return F.when(text.rlike(ZONED_TIME), from_micros(since_1970)).otherwise(
        text.try_cast("timestamp_ntz")
    )


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def step_time(step: Column, epoch: str = EPOCH, minutes: int = STEP_MINUTES) -> Column:
    """Event time of a step: ``epoch`` plus ``step`` intervals."""
    return F.expr(f"timestamp_ntz'{epoch}'") + F.make_dt_interval(
        F.lit(0), F.lit(0), step.cast("int") * minutes
    )


def schema_version(step: Column, first_v2: int = FIRST_V2_STEP) -> Column:
    return F.when(step >= first_v2, "v2").otherwise("v1")


def traffic_period(step: Column) -> Column:
    """Seasonality tag; both ends of a period belong to it."""
    tag = F.lit("Normal")
    for name, (first, last) in TRAFFIC_PERIODS.items():
        tag = F.when(step.between(first, last), name).otherwise(tag)
    return tag


def device_id(customer: Column, slot: Column) -> Column:
    """The same customer and slot always give the same device."""
    digest = F.md5(F.concat(customer, F.lit(":slot"), slot.cast("string")))
    return F.concat(F.lit("DEV-"), F.upper(F.substring(digest, 1, 12)))


def new_device(age_days: Column, days: int = 2) -> Column:
    return F.when(age_days < days, 1).otherwise(0)


def finite(value: Column) -> Column:
    """NaN and infinities become NULL: in Spark ``NaN >= x`` is true."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def known_text(value: Column) -> Column:
    """The text a missing value leaves behind when it is printed becomes NULL."""
    return F.when(F.lower(value) != "nan", value)


def cents(value: Column) -> Column:
    """Money as an exact decimal, so sums do not depend on row order; NULL where it does not fit."""
    return value.try_cast("decimal(18,2)")


def digest(key: Column, salt: str) -> Column:
    """Uniform lower-case hex text of a key; prefixes compare like numbers."""
    return F.md5(F.concat(key.cast("string"), F.lit("|" + salt)))


def share_limits(weights: dict[str, float]) -> list[tuple[str, str]]:
    """(value, upper bound of its 8-digit hex range) in the given order."""
    total, reached, out = sum(weights.values()), 0, []
    for value, weight in weights.items():
        reached += weight
        out.append((value, format(int(2**32 * reached / total), "08x")))
    return out


def assign_stable(key: Column, weights: dict[str, float], salt: str) -> Column:
    """Weighted choice that is a function of the key: no state, no lookup table."""
    part = F.substring(digest(key, salt), 1, 8)
    limits = share_limits(weights)
    choice = F.lit(limits[-1][0])
    for value, limit in reversed(limits[:-1]):
        choice = F.when(part < limit, value).otherwise(choice)
    return F.when(key.isNotNull(), choice)


def stable_int(key: Column, low: int, high: int, salt: str) -> Column:
    """Integer in [low, high], a function of the key."""
    number = F.conv(F.substring(digest(key, salt), 1, 8), 16, 10).cast("bigint")
    return (number % (high - low + 1) + low).cast("int")
