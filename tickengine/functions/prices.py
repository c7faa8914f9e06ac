"""Price and volume expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tickengine.functions.exact import exact_sum


def minor_units(price: Column, decimals: int) -> Column:
    """A price as a whole number of its smallest unit.

    NULL for a price that is no number. A price of more than 18 digits, or with more
    ``decimals`` than said, is an error: to drop or to round it would change sums unseen.
    """
    scaled = price * F.lit(float(10**decimals))
    units = F.round(scaled)
    infinite = F.isnan(price) | (F.abs(price) == float("inf"))
    too_long = F.abs(units) >= F.lit(1e18)
    # What a double cannot tell from a whole number of units passes.
    too_fine = F.abs(scaled - units) > 1e-6 + F.abs(scaled) * 1e-12
    told = F.concat(F.lit(f"price does not fit {decimals} decimals and 18 digits: "), price.cast("string"))
    return (
        F.when(price.isNull() | infinite, F.lit(None).cast("decimal(18,0)"))
        .when(too_long | too_fine, F.raise_error(told).cast("decimal(18,0)"))
        .otherwise(units.try_cast("decimal(18,0)"))
    )


def vwap_sums(
    price: str = "price",
    volume: str = "volume",
    *,
    complete_rows: bool = True,
    decimals: int | None = None,
    exact: bool = False,
) -> tuple[Column, Column]:
    """The aggregates of a VWAP, price times volume and volume; both can be summed again.

    (Those of ``exact`` are rounded already, so summing them again is not exact.)
    """
    p, v = F.col(price), F.col(volume)
    if decimals is not None:
        p = minor_units(p, decimals)
    weight = F.sum(F.when(p.isNotNull(), v) if complete_rows else v)
    if exact:
        return exact_sum(p * v), weight
    # 18 and 19 digits: a product always fits 38 digits, and beyond that the sum raises.
    return F.sum(p * v if decimals is None else p * v.cast("decimal(19,0)")), weight


def vwap_of(units: Column, weight: Column, decimals: int | None = None) -> Column:
    """The VWAP of summed price times volume and summed volume; no volume gives NULL."""
    if decimals is None:
        return F.try_divide(units, weight)
    scale = F.lit(float(10**decimals))
    return F.try_divide(units.cast("double"), weight.cast("double") * scale)


def vwap_expr(
    price: str = "price",
    volume: str = "volume",
    *,
    complete_rows: bool = True,
    decimals: int | None = None,
    exact: bool = False,
) -> Column:
    """Aggregate ``sum(price * volume) / sum(volume)``; no volume gives NULL.

    ``complete_rows`` leaves a volume out of the divisor when its price is NULL, so
    that both sums cover the same rows. Sums of doubles depend on the order in which rows
    arrive, in the last digits. ``decimals`` sums whole price units, ``exact`` the products as
    they are, rounded once at the end: both make the result independent of the order. Prices
    that do not fit are an error. Where both are given, ``decimals`` counts.
    """
    exact = exact and decimals is None
    return vwap_of(*vwap_sums(price, volume, complete_rows=complete_rows, decimals=decimals, exact=exact), decimals)


def pct_change(opening: Column, closing: Column) -> Column:
    """Change in percent of the opening price; opening price 0 gives NULL."""
    return F.try_divide(closing - opening, opening) * 100


def deviation(price: Column, reference: Column) -> Column:
    """Distance of a price from a reference, relative to the reference."""
    return F.try_divide(F.abs(price - reference), reference)


def time_order(time: str, tie: str | None = None) -> Column:
    """Ordering value for first and last prices.

    A tie-breaking LONG column is packed with the time into one decimal. A struct
    would do the same but turns the hash aggregation into a sort-based one.
    """
    if tie is None:
        return F.col(time)
    micros = F.unix_micros(F.col(time).cast("timestamp")).cast("decimal(18,0)")
    step = F.lit("10000000000000000000").cast("decimal(20,0)")
    return micros * step + F.col(tie).cast("decimal(19,0)")
