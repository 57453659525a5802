"""String, number and formatting column functions (FN-1..10, PRJ-3/4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.time import parse_iso_time
from tessera.schemas import IP_REGEX


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def valid_ip(col: Column | str) -> Column:
    """Dotted quad, whole-string match; NULL counts as invalid."""
    return F.coalesce(_c(col).rlike(IP_REGEX), F.lit(False))


def ratio(num: Column | str, den: Column | str, scale: float = 1.0) -> Column:
    """``num * scale / den`` as DOUBLE, NULL (not an error) when ``den`` is 0."""
    return F.try_divide(_c(num).cast("double") * F.lit(scale), _c(den).cast("double"))


def percent_text(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as text with two decimals and ``%``, e.g. ``66.67%``.

    Exact decimal arithmetic rounded HALF_UP, like the JDK formatter. NULL when
    ``den`` is 0 (``format_string`` would print ``nu%``).
    """
    pct = F.try_divide(_c(num).cast("decimal(20,0)") * F.lit(100), _c(den).cast("decimal(20,0)"))
    return F.concat(pct.cast("decimal(18,2)").cast("string"), F.lit("%"))


def typed_line_columns(fields_prefix: str = "") -> list[Column]:
    """Typed columns derived from the string fields: event code, event time, validity, reason."""
    code = F.col(f"{fields_prefix}eventType").try_cast("int")
    ts = parse_iso_time(F.col(f"{fields_prefix}time"))
    reason = (
        F.when(F.col(f"{fields_prefix}time").isNull(), F.lit("short line"))
        .when(code.isNull(), F.lit("bad event type"))
        .when(ts.isNull(), F.lit("bad time"))
    )
    return [
        code.alias("event_code"),
        ts.cast("timestamp_ntz").alias("event_ts"),
        reason.isNull().alias("is_valid"),
        reason.alias("reason"),
    ]
