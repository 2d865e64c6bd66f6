"""Column expressions (all built-in Spark functions; no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def type_match(event_type: Column, types: Iterable[str], case_sensitive: bool) -> Column:
    """True when ``event_type`` is one of ``types`` (null-safe: null -> False)."""
    types = list(types)
    if case_sensitive:
        cond = event_type.isin(types)
    else:
        cond = F.lower(event_type).isin([t.lower() for t in types])
    return F.coalesce(cond, F.lit(False))


def count_where(cond: Column) -> Column:
    """Exact integer count of rows where ``cond`` holds (0 over no rows)."""
    return F.coalesce(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("bigint")


def lenient_long(raw: Column) -> Column:
    """Integer read of a JSON scalar the way a lenient reader does it.

    Numbers and numeric text truncate toward zero; null or junk reads as
    null (the caller decides the default).
    """
    return raw.try_cast("double").try_cast("bigint")


def strict_long(raw: Column) -> Column:
    """Strict integer cast (the batch job's rule): unreadable input raises
    under ANSI mode instead of becoming null."""
    return raw.cast("bigint")


def iso_instant(ts: Column) -> Column:
    """ISO-8601 UTC text: ``2024-01-01T10:00:30Z``, with the fraction in
    groups of three digits only as far as needed (``.112Z``, ``.112465Z``)."""
    micros = F.date_format(ts, "SSSSSS")
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    millis = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return (F.when(micros == "000000", whole)
             .when(F.substring(micros, 4, 3) == "000", millis)
             .otherwise(full))


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ (UTC)."""
    return F.unix_millis(ts.cast("timestamp"))


def freshness_pct(age_ms: Column, horizon_ms: int = 300_000) -> Column:
    """100 at age 0 falling to 0 at the horizon; only the low end is clamped."""
    return F.greatest(F.lit(0.0), F.lit(100.0) - age_ms.cast("double") / F.lit(float(horizon_ms)) * F.lit(100.0))


def _tenths_text(tenths: Column) -> Column:
    return F.concat((tenths / 10).cast("bigint").cast("string"), F.lit("."),
                    (tenths % 10).cast("string"))


def format_duration(ms: Column) -> Column:
    """Human duration: '—' if negative, 'N ms', 'N.N s' or 'N.N min'.

    One decimal, rounded half up on the exact millisecond count, computed in
    integers so every engine prints the same text.
    """
    ms = ms.cast("bigint")
    secs = _tenths_text(F.floor((ms + F.lit(50)) / F.lit(100)).cast("bigint"))
    mins = _tenths_text(F.floor((ms + F.lit(3000)) / F.lit(6000)).cast("bigint"))
    return (F.when(ms.isNull(), F.lit(None).cast("string"))
            .when(ms < 0, F.lit("—"))
            .when(ms < 1000, F.concat(ms.cast("string"), F.lit(" ms")))
            .when(ms < 60000, F.concat(secs, F.lit(" s")))
            .otherwise(F.concat(mins, F.lit(" min"))))


def format_value(v: Column) -> Column:
    """A numeric feature value shown with four decimals."""
    return F.format_string("%.4f", v)


_PAIR_SHIFT = 10 ** 20
_PAIR_OFFSET = 2 ** 63


def packed_order(major, minor):
    """Order-preserving DECIMAL(38,0) for the pair (major, minor) of BIGINTs.

    ``major * 10^20 + (minor + 2^63)``: numeric order equals lexicographic
    order of the pair for every long ``minor`` and any ``major`` up to
    ±1.7e17.  A single fixed-width key lets ``max_by``/``min`` run as a
    hash aggregate (a struct key would force a sort-based one).
    """
    from decimal import Decimal
    dec = "decimal(38,0)"
    return (major.cast(dec) * F.lit(Decimal(_PAIR_SHIFT)).cast(dec)
            + (minor.cast(dec) + F.lit(Decimal(_PAIR_OFFSET)).cast(dec))).cast(dec)
