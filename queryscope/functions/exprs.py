"""Reusable Column builders.

All helpers return plain ``pyspark.sql.Column`` expressions built from
built-in functions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from queryscope.functions import vocab as V

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct2(n: ColumnOrName, d: ColumnOrName) -> Column:
    """``ROUND(100 * n / d, 2)`` with exact HALF_UP rounding, as DOUBLE.

    Integer arithmetic only: ``(n*20000 + d) div (2*d) / 100``.
    ``d = 0`` or NULL gives NULL.
    """
    return div_half_up(_c(n).cast("bigint") * 10000, d) / 100.0


def safe_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b as DOUBLE, NULL when b is 0 or NULL (never throws under ANSI)."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def ratio0(a: ColumnOrName, b: ColumnOrName) -> Column:
    """DAX ``DIVIDE(a, b, 0)``: a / b, 0.0 when the quotient is undefined."""
    return F.coalesce(safe_ratio(a, b), F.lit(0.0))


def is_event(name: str, col: ColumnOrName = "event_name") -> Column:
    return _c(col) == F.lit(name)


def epoch_micros(ts: ColumnOrName) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ, independent of session zone."""
    return F.timestamp_diff(
        "MICROSECOND", F.lit(_dt.datetime(1970, 1, 1)).cast("timestamp_ntz"), _c(ts)
    )


def date_minus_days(as_of: _dt.date | str, days: int) -> Column:
    d = _dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return F.lit(d - _dt.timedelta(days=days))


def search_type_of(label: ColumnOrName) -> Column:
    """First matching label suffix, else 'other' (NULL label -> 'other')."""
    label = _c(label)
    expr = None
    for suffix, kind in V.SEARCH_TYPE_SUFFIXES:
        cond = label.endswith(suffix)
        expr = F.when(cond, kind) if expr is None else expr.when(cond, kind)
    return expr.otherwise(V.SEARCH_TYPE_OTHER)


def click_position_of(label: ColumnOrName, name: ColumnOrName | None = "event_name") -> Column:
    """2nd '|' field of the label as INT; malformed -> NULL.

    With ``name`` given, only click events get a position.
    """
    pos = F.split_part(_c(label), F.lit("|"), F.lit(2)).try_cast("int")
    if name is None:
        return pos
    return F.when(_c(name) == V.CLICK, pos)


def region_of(country: ColumnOrName) -> Column:
    """B3d: country code -> region bucket; unknown and NULL -> 'Other'."""
    country = _c(country)
    expr = None
    for region, codes in V.REGION_COUNTRIES:
        cond = country.isin(codes)
        expr = F.when(cond, region) if expr is None else expr.when(cond, region)
    return expr.otherwise(V.REGION_OTHER)


def norm_term(term: ColumnOrName) -> Column:
    """pandas ``str.lower().str.strip()``: lower case, strip Unicode whitespace."""
    return F.regexp_replace(F.lower(_c(term)), r"(?U)^\s+|\s+$", "")


def div_half_up(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Integer ``num / den`` rounded HALF_UP (both non-negative) as BIGINT.

    Computed in DECIMAL(38,0), where doubling a sum cannot overflow; the
    quotient is taken as ``(x - x % y) / y``, which is exact.  ``den = 0``
    or NULL gives NULL.
    """
    wide = "decimal(38,0)"
    num = _c(num).cast(wide)
    den = F.nullif(_c(den).cast(wide), F.lit(0).cast(wide))
    x = (num * 2 + den).cast(wide)
    y = (den * 2).cast(wide)
    return ((x - x % y) / y).cast("bigint")


def round2_avg(total: ColumnOrName, n: ColumnOrName) -> Column:
    """``ROUND(AVG(x), 2)`` from an exact integer total and a count, as DOUBLE."""
    return div_half_up(_c(total) * 100, n) / 100.0


def round2_money_avg(total: ColumnOrName, n: ColumnOrName) -> Column:
    """``ROUND(AVG(money), 2)`` from an exact DECIMAL(…,2) total, as DOUBLE."""
    cents = (_c(total).cast("decimal(38,2)") * 100).cast("decimal(38,0)")
    return div_half_up(cents, n) / 100.0


def money_avg(total: ColumnOrName, n: ColumnOrName) -> Column:
    """Average of money: exact DECIMAL total divided by count, as DOUBLE."""
    return F.try_divide(_c(total).cast("double"), _c(n).cast("double"))


def pct_text(a: ColumnOrName, b: ColumnOrName, decimals: int = 1) -> Column:
    """``a / b`` as a percent string with ``decimals`` places, HALF_UP on the
    exact ratio (integer arithmetic, so every engine prints the same text).
    An undefined ratio prints as 0 (DAX ``DIVIDE(a, b, 0)``).
    """
    scale = 10 ** decimals
    q = F.coalesce(div_half_up(_c(a).cast("bigint") * (100 * scale), b), F.lit(0).cast("bigint"))
    whole = ((q - q % scale) / scale).cast("bigint")
    return F.format_string(f"%d.%0{decimals}d%%", whole, q % scale)


def float_percent_text(rate: ColumnOrName) -> Column:
    """``f"{rate:.2%}"`` of a non-negative double: two places of ``rate * 100``,
    rounded from its exact binary value, ties to even (1/800 is 0.12%).

    ``rate * 100 * 100`` is taken as a double plus its rounding error (the
    factor split into halves whose products are exact), so a value next to
    a tie is told from the tie itself.
    """
    x = _c(rate) * 100.0
    split = x * 134217729.0
    high = split - (split - x)
    low = x - high
    p = x * 100.0
    error = (high * 100.0 - p) + low * 100.0
    q = F.floor(p).cast("bigint")
    over = (p - q.cast("double") - 0.5) + error
    n = q + F.when((over > 0) | ((over == 0) & (q % 2 == 1)), 1).otherwise(0)
    return F.format_string("%d.%02d%%", ((n - n % 100) / 100).cast("bigint"), n % 100)
