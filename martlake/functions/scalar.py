"""Column expressions shared by every plan.

All helpers return built-in Catalyst expressions, so they stay inside
whole-stage code generation; nothing here is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order statuses that are not commercial (cancelled or never
# available); every revenue mart excludes them.
COMMERCIAL_EXCLUDED = ("canceled", "unavailable")

# Ten decimals and 18 integer digits an amount; a sum has 28 integer digits, so neither the
# amounts' own digits are cut nor can a sum of them overflow.
MONEY_TYPE = "decimal(28,10)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col) -> Column:
    """A currency amount as an exact decimal number (no rounding to cents)."""
    return _c(col).cast(MONEY_TYPE)


def money_sum(col) -> Column:
    """Exact currency sum returned as double.

    Summing doubles depends on the order rows arrive in, which differs between
    partitions, retries and engines.  Summing the decimal value is exact and
    therefore the same on every run; the one cast back to double keeps the
    public schema.
    """
    return F.sum(money(col)).cast("double")


def ratio(num, den) -> Column:
    """num / den with a zero or null denominator giving null (ANSI-safe)."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def commercial(status_col="order_status") -> Column:
    """Commercial filter: status NOT IN (canceled, unavailable).

    Three-valued, like SQL: a null status yields null and the row drops out.
    """
    return ~_c(status_col).isin(*COMMERCIAL_EXCLUDED)


def ntz(text: str) -> Column:
    """A timezone-free timestamp literal (``YYYY-MM-DD[ HH:MM:SS]``)."""
    return F.lit(text).cast("timestamp_ntz")


def month_start(ts) -> Column:
    """First instant of the month, as timestamp_ntz, without time-zone math."""
    return F.trunc(F.to_date(_c(ts)), "month").cast("timestamp_ntz")


def delivery_days(purchase="order_purchase_timestamp",
                  delivered="order_delivered_customer_date") -> Column:
    """Calendar-day boundaries crossed between purchase and delivery; null if undelivered."""
    return F.when(_c(delivered).isNotNull(),
                  F.datediff(_c(delivered), _c(purchase)).cast("bigint"))


def is_late(delivered="order_delivered_customer_date",
            estimated="order_estimated_delivery_date") -> Column:
    """Delivered after the estimate (full timestamps); null if undelivered."""
    return F.when(_c(delivered).isNotNull(), _c(delivered) > _c(estimated))


def seconds_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def hours_between(start, end) -> Column:
    """Fractional hours from start to end (null if either is null)."""
    return seconds_between(start, end) / F.lit(3600.0)


def days_between(start, end) -> Column:
    """Fractional days from start to end (null if either is null)."""
    return seconds_between(start, end) / F.lit(86400.0)


def day_floor(start, end) -> Column:
    """Whole days (floor of 24-hour periods) from start to end."""
    return F.floor(seconds_between(start, end) / F.lit(86400.0))


def null_safe_bool(cond) -> Column:
    """A predicate where unknown counts as false."""
    return F.coalesce(_c(cond), F.lit(False))


# The characters stripped from text: everything Unicode counts as white space, and the four
# ASCII separators.  None lies above U+3000.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(col) -> Column:
    """Remove leading and trailing whitespace of any kind (tabs, newlines too).

    ``trim`` only removes spaces; ``btrim`` with the whitespace set is a plain
    character trim (no regular expression), so it stays cheap in codegen.
    """
    return F.btrim(_c(col), F.lit(WHITESPACE))


def _parts(c) -> tuple[Column, Column]:
    """Non-negative money as whole units and ten decimal places, both whole numbers."""
    x = money(c)
    whole = F.floor(x).cast("decimal(18,0)")
    return whole, ((x - whole) * F.lit(10_000_000_000)).cast("decimal(10,0)")


def _exact(product: Column) -> Column:
    """Aggregate: sum of whole-number products, exact, then a double."""
    return F.coalesce(F.sum(product.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("double")


def square_sum(c) -> Column:
    """Aggregate: sum of the squares of non-negative money, as a double.

    An amount is h1 * 10^9 + h0 + low / 10^10, and the products of the three parts are summed apart, each
    exactly: no decimal place is cut from a square, and amounts of 10^16 don't overflow.
    Only the last step, which adds the six sums, is in doubles.
    """
    whole, low = _parts(c)
    h1, h0 = F.floor(whole / F.lit(10 ** 9)).cast("decimal(9,0)"), F.pmod(whole, F.lit(10 ** 9)).cast("decimal(9,0)")
    units = _exact(h1 * h1) * 1e18 + _exact(h1 * h0) * 2e9 + _exact(h0 * h0)
    return units + (_exact(h1 * low) * 2e9 + _exact(h0 * low) * 2.0) / 1e10 + _exact(low * low) / 1e20


def weighted_sum(weight: Column, c) -> Column:
    """Aggregate: sum of a whole ``weight`` times non-negative money, as a double; units and decimal places
    are summed apart, each exactly."""
    whole, low = _parts(c)
    w = weight.cast("decimal(18,0)")
    return _exact(w * whole) + _exact(w * low) / 1e10
