"""Column expressions shared by the layers. All are built-in Catalyst
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyflow.functions import domain


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_text(c: str | Column) -> Column:
    """Null, or only (ASCII) whitespace. ``trim`` strips spaces only, so the
    regex, not trim, decides blankness (``" \\t "`` is blank)."""
    c = col_(c)
    return c.isNull() | c.rlike(r"^\s*$")


def amount_input(amount: str = "amount", legacy: str = "amount_usd") -> Column:
    """First non-null of the v3 ``amount`` and legacy ``amount_usd`` as text.
    A malformed non-null ``amount`` does not fall back to the legacy value."""
    return F.coalesce(F.col(amount).cast("string"), F.col(legacy).cast("string"))


def safe_amount(c: str | Column) -> Column:
    """ANSI-safe cast to decimal(18,2), HALF_UP; garbage, NaN, +-Infinity
    and overflow give null instead of failing the job."""
    return col_(c).try_cast(domain.AMOUNT_TYPE)


def normalized_status(c: str | Column = "status") -> Column:
    """lower(trim(status))."""
    return F.lower(F.trim(col_(c)))


def normalized_currency(c: str | Column = "currency") -> Column:
    """Null means USD; then upper(trim()). Blank stays blank (and is rejected)."""
    return F.upper(F.trim(F.coalesce(col_(c), F.lit(domain.DEFAULT_CURRENCY))))


def event_time_utc(c: str | Column = "event_timestamp") -> Column:
    """P5: ANSI-safe ISO-8601 parse; offsets honoured, zone-less text is read in
    the session zone (UTC by contract)."""
    return F.try_to_timestamp(col_(c))


def date_parts(ts: str | Column = "event_timestamp_utc") -> list[Column]:
    """Zero-padded ``year``/``month``/``day`` strings of the event time."""
    ts = col_(ts)
    return [
        F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
    ]


def band(value: str | Column, edges, top: str) -> Column:
    """``CASE WHEN v < e1 THEN b1 WHEN v < e2 ... ELSE top``."""
    value = col_(value)
    expr = None
    for edge, name in edges:
        cond = value < F.lit(edge)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(top)


def event_band(c: str | Column = "amount_decimal") -> Column:
    """Band of one event's amount."""
    return band(c, domain.EVENT_BANDS, domain.EVENT_BAND_TOP)


def daily_band(c: str | Column = "amount") -> Column:
    """Band of a daily summed amount."""
    return band(c, domain.DAILY_BANDS, domain.DAILY_BAND_TOP)


def reasons(rules: list[tuple[str, Column]]) -> Column:
    """Array of the names of every rule whose predicate is true, in rule order.
    A null predicate counts as not violated (``when(null)`` is null and is
    dropped).

    Nulls are dropped with ``array_except(.., [null])`` rather than
    ``array_compact``/``filter``: those are lambda (higher-order) functions
    without code generation, and one of them in the rule projection would pull
    the whole projection (regexes, casts, timestamp parsing) out of
    whole-stage codegen. Rule names are distinct, so the set semantics of
    ``array_except`` change nothing; it keeps the first array's order."""
    flagged = F.array(*[F.when(p, F.lit(n)) for n, p in rules])
    return F.array_except(flagged, F.array(F.lit(None).cast("string")))


def full_date(year="year", month="month", day="day") -> Column:
    """``yyyy-MM-dd`` text from the three partition strings."""
    return F.concat(col_(year), F.lit("-"), col_(month), F.lit("-"), col_(day))
