"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from breakwater import constants as C


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def severity_of(break_type: Column, severities: dict[str, str] | None = None) -> Column:
    """Severity of a break type; types that are not in the map count as MEDIUM."""
    by_severity: dict[str, list[str]] = {}
    for kind, severity in (severities or C.SEVERITY_BY_BREAK).items():
        by_severity.setdefault(severity, []).append(kind)
    out = F.lit(C.DEFAULT_SEVERITY)
    for severity, kinds in by_severity.items():
        out = F.when(break_type.isin(kinds), severity).otherwise(out)
    return out


def severity_rank(severity: Column) -> Column:
    """1 for the gravest severity; anything unknown sorts last."""
    out = F.lit(len(C.SEVERITIES) + 1)
    for rank, name in reversed(list(enumerate(C.SEVERITIES, start=1))):
        out = F.when(severity == name, rank).otherwise(out)
    return out


def notional(quantity: Column, price: Column) -> Column:
    """|quantity x price| as an exact decimal, so that sums don't depend on row order; NULL where one
    of them is beyond its decimal."""
    return F.abs(price.try_cast("decimal(20,8)") * quantity.try_cast("decimal(17,0)"))


def to_money(amount: Column, places: int = 2) -> Column:
    return F.round(amount, places).cast("double")


def percent(part: Column, whole: Column) -> Column:
    """part / whole in percent, rounded half up to two places in integer arithmetic; 0 for an empty whole."""
    scaled = F.lit(20000) * part + whole
    step = F.lit(2) * whole
    return F.when(whole > 0, (scaled - scaled % step) / step / F.lit(100.0)).otherwise(F.lit(0.0))


def plain_price(price: Column) -> Column:
    """Price as text without exponent and without padding zeros: 972.0, 972.11, 10000000.0."""
    digits = F.rtrim(price.try_cast("decimal(28,10)").cast("string"), F.lit("0"))
    padded = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.coalesce(padded, price.cast("string"))


def break_id(*columns: Column) -> Column:
    """Stable key of a break: md5 over the given fields, NULLs read as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def contains_text(needle: str, columns: Sequence[str]) -> Column:
    """Case-insensitive substring search over several columns; NULL reads as empty text."""
    wanted = F.lit(needle.lower())
    hits = [F.lower(F.coalesce(F.col(c), F.lit(""))).contains(wanted) for c in columns]
    return reduce(lambda a, b: a | b, hits)


def is_iso_date(text: Column) -> Column:
    """True for year-month-day text that names a real day; month and day may be unpadded."""
    shaped = text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
    return F.coalesce(shaped & F.try_to_timestamp(text, F.lit("yyyy-M-d")).isNotNull(), F.lit(False))


def control_band(rate: Column) -> Column:
    """Status line of the executive brief."""
    return F.when(rate >= 90, "HEALTHY").when(rate >= 80, "WARNING").otherwise("CRITICAL")


def dashboard_band(rate: Column) -> Column:
    """Badge next to the match rate."""
    return F.when(rate >= 95, "OPTIMAL").when(rate >= 90, "ACCEPTABLE").otherwise("ATTENTION")
