"""Scalar expressions of the reference.

Each returns a ``Column`` built only from ``pyspark.sql.functions``, so the
expressions stay inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelens.schema import (
    BIKE_CODES,
    BIKE_LABELS,
    BIKE_OTHER_CODE,
    CASUAL_VALUE,
    EARTH_RADIUS_M,
    FIRST_MONTH,
    LAST_MONTH,
    MEMBER_LABELS,
    MEMBER_VALUE,
    MONTH_LEVELS,
    WEEKDAY_NAMES,
    RAW_BIKE_TYPES,
    SEGMENT_PREFIXES,
)


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null_text(c: Column | str) -> Column:
    """Text as the reference's CSV loader keeps it: a missing or blank field is
    ``''`` and the literal ``NA`` is NULL (SURVEY T2)."""
    c = as_col(c)
    return F.when(c.isNull(), F.lit("")).when(c == "NA", F.lit(None).cast("string")).otherwise(c)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """``TIMESTAMPDIFF(MINUTE, start, end)``: whole minutes, truncated toward zero.

    Zone-less timestamps subtract to an exact day-time interval; casting it to
    ``INTERVAL MINUTE`` drops the finer fields. No time zone is involved, so a
    daylight-saving change of the session zone cannot shift the result, and
    the arithmetic stays on longs inside codegen.
    """
    return (as_col(end) - as_col(start)).cast("interval minute").cast("long")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """``TIMESTAMPDIFF(SECOND, start, end)``: whole seconds, truncated toward zero."""
    return (as_col(end) - as_col(start)).cast("interval second").cast("long")


def member_flag(c: Column | str) -> Column:
    """'member' -> TRUE; anything else, NULL included, -> FALSE."""
    return F.when(as_col(c) == MEMBER_VALUE, F.lit(True)).otherwise(F.lit(False))


def bike_code(c: Column | str) -> Column:
    """electric_bike 1, classic_bike 2, anything else (NULL too) 3 (P10)."""
    c = as_col(c)
    expr = None
    for name, code in BIKE_CODES.items():
        expr = (F.when if expr is None else expr.when)(c == name, F.lit(code))
    return expr.otherwise(F.lit(BIKE_OTHER_CODE))


def bike_label(code: Column | str) -> Column:
    """Code -> label; an unknown code gives NULL."""
    code = as_col(code)
    expr = None
    for value, label in BIKE_LABELS.items():
        expr = (F.when if expr is None else expr.when)(code == value, F.lit(label))
    return expr


def member_label(flag: Column | str) -> Column:
    """1/TRUE -> Member, 0/FALSE -> Casual, else NULL."""
    flag = as_col(flag).cast("int")
    return F.when(flag == 1, F.lit(MEMBER_LABELS[True])).when(flag == 0, F.lit(MEMBER_LABELS[False]))


def segment_label(member: Column | str, code: Column | str) -> Column:
    """'M-'/'C-' plus the bike label from the codes; the final ELSE catches
    NULLs and unknown codes as 'C-Electric Scooter' (P13)."""
    m = as_col(member).cast("int")
    code = as_col(code)
    expr = None
    for prefix, flag in ((SEGMENT_PREFIXES[True], 1), (SEGMENT_PREFIXES[False], 0)):
        for value, label in BIKE_LABELS.items():
            cond = (m == flag) & (code == value)
            expr = (F.when if expr is None else expr.when)(cond, F.lit(prefix + label))
    return expr.otherwise(F.lit(SEGMENT_PREFIXES[False] + BIKE_LABELS[BIKE_OTHER_CODE]))


def segment_label_raw(member_casual: Column | str, rideable_type: Column | str) -> Column:
    """Segment label from the raw strings; unmatched -> NULL."""
    mc, rt = as_col(member_casual), as_col(rideable_type)
    raw = {name: code for code, name in enumerate(RAW_BIKE_TYPES, start=1)}
    expr = None
    for prefix, who in ((SEGMENT_PREFIXES[True], MEMBER_VALUE), (SEGMENT_PREFIXES[False], CASUAL_VALUE)):
        for name, value in raw.items():
            cond = (mc == who) & (rt == name)
            expr = (F.when if expr is None else expr.when)(cond, F.lit(prefix + BIKE_LABELS[value]))
    return expr


def month_order(year: Column | str, month: Column | str) -> Column:
    """Sort key of a (year, month) pair."""
    return as_col(year).cast("int") * 12 + as_col(month).cast("int")


def _label_of(number: Column, labels: list[str]) -> Column:
    """labels[number - 1], NULL outside 1..len(labels); no time zone involved."""
    return F.element_at(F.array(*[F.lit(v) for v in labels]), number.cast("int"))


def month_label(
    year: Column | str,
    month: Column | str,
    first: tuple[int, int] = FIRST_MONTH,
    last: tuple[int, int] = LAST_MONTH,
) -> Column:
    """'Mon.YYYY' for months inside the label levels, else NULL."""
    key = month_order(year, month)
    lo, hi = first[0] * 12 + first[1], last[0] * 12 + last[1]
    label = F.concat(
        _label_of(as_col(month), MONTH_LEVELS), F.lit("."), F.lpad(as_col(year).cast("string"), 4, "0")
    )
    return F.when(key.between(lo, hi), label)


def weekday_order(dayofweek: Column | str) -> Column:
    """Monday 1 .. Sunday 7 from a 1 = Sunday day number."""
    return (as_col(dayofweek).cast("int") + 5) % 7 + 1


def weekday_abbr(ts: Column | str) -> Column:
    """Sun..Sat from the day number, 1 = Sunday (E6). Zone-free, unlike a
    formatted timestamp, which a daylight-saving gap of the session zone
    can shift."""
    return _label_of(F.dayofweek(as_col(ts)), WEEKDAY_NAMES)


def month_abbr(ts: Column | str) -> Column:
    """Jan..Dec from the month number."""
    return _label_of(F.month(as_col(ts)), MONTH_LEVELS)


def to_minutes(seconds: Column | str, mode: str = "half_even") -> Column:
    """Seconds to whole minutes; R rounds half to even, SQL half away from zero."""
    x = as_col(seconds).cast("double") / F.lit(60.0)
    if mode == "half_even":
        return F.bround(x, 0)
    if mode == "half_up":
        return F.round(x, 0)
    raise ValueError(f"unknown rounding mode {mode!r}")


def exact_ratio(a: Column | str, b: Column | str, scale: int = 4) -> Column:
    """a / b of integers rounded half away from zero to ``scale`` decimals,
    as an exact decimal division does (T13), returned as a double.

    Computed in integer arithmetic, ``sign(a) * floor((2*10^s*|a| + b) / 2b)``,
    on DECIMAL(38,0) so large sums cannot overflow; rounding a double quotient
    instead could round twice. NULL when b is 0 or NULL.
    """
    a = as_col(a).cast("decimal(38,0)")
    b = as_col(b).cast("decimal(38,0)")
    factor = 10**scale
    q = F.abs(a) * F.lit(2 * factor).cast("decimal(38,0)") + b
    d = b * F.lit(2).cast("decimal(38,0)")
    # q >= 0 and d > 0: floor(q / d) = (q - q mod d) / d, an exact quotient.
    units = ((q - F.pmod(q, d)) / d).cast("decimal(38,0)")
    signed = F.when(a < 0, -units).otherwise(units)
    # Exact decimal division by 10^s, then one correctly rounded conversion.
    return F.when(b > 0, (signed / F.lit(factor).cast("decimal(38,0)")).cast("double"))


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL when b is 0 or NULL."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def haversine_m(
    lng1: Column | str,
    lat1: Column | str,
    lng2: Column | str,
    lat2: Column | str,
    radius: float = EARTH_RADIUS_M,
    strict: bool = False,
) -> Column:
    """Great-circle distance in metres on a sphere (E8), unrounded.

    ``strict=True`` raises on coordinates out of range, as a strict server does.
    """
    lng1, lat1, lng2, lat2 = (as_col(c).cast("double") for c in (lng1, lat1, lng2, lat2))
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    s_lat = F.sin((phi2 - phi1) / 2.0)
    s_lng = F.sin((F.radians(lng2) - F.radians(lng1)) / 2.0)
    a = s_lat * s_lat + F.cos(phi1) * F.cos(phi2) * (s_lng * s_lng)
    dist = F.lit(2.0 * radius) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))
    if strict:
        bad = (
            (F.abs(lat1) > 90) | (F.abs(lat2) > 90) | (F.abs(lng1) > 180) | (F.abs(lng2) > 180)
        )
        dist = F.when(bad, F.raise_error(F.lit("coordinate out of range"))).otherwise(dist)
    return dist
