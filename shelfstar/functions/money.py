"""Money arithmetic, decimal unless said otherwise."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from .text import as_column


def line_total(quantity: Column | str, price: Column | str, discount_pct: Column | str) -> Column:
    """Discounted line amount, exact, rounded half up to cents. The price has at most two decimals.

    Worked out in whole cents times percent, which is several times faster than decimal division.
    """
    cents = (as_column(price) * 100).cast("bigint")
    kept = F.try_multiply(cents, F.lit(100) - as_column(discount_pct))
    hundredths = F.try_multiply(as_column(quantity).cast("bigint"), kept)
    return (F.round(hundredths, -2) * F.lit(Decimal("0.0001"))).try_cast("decimal(12,2)")


def line_total_double(quantity: Column | str, price: Column | str, discount_pct: Column | str) -> Column:
    """Same amount with the discount factor in binary floating point, as the event feed computes it.

    Differs from ``line_total`` by a cent on some rounding ties.
    """
    gross = as_column(quantity) * as_column(price)
    factor = F.lit(1) - as_column(discount_pct) / F.lit(100)
    return F.round(gross * factor, 2).try_cast("decimal(12,2)")


def cost_total(quantity: Column | str, unit_cost: Column | str) -> Column:
    """NULL when the product, and so its cost, is unknown. Exact, in a type wide enough for any product: a table's
    contract takes it to the published type and counts what doesn't fit."""
    return as_column(quantity) * as_column(unit_cost)


def divide(numerator: Column, denominator: Column) -> Column:
    """NULL on a zero or missing denominator."""
    return F.try_divide(numerator, denominator)


def variation_pct(actual: Column | str, target: Column | str) -> Column:
    """Signed distance from target in percent, two decimals; in a wide type, as ``cost_total``.

    The distance is taken at 22 digits, so that the quotient keeps 15 decimals whatever the type of a sum; the target has 12 at most.
    """
    actual, target = as_column(actual), as_column(target)
    return F.round(divide((actual - target).cast("decimal(22,2)"), target) * F.lit(100), 2)
