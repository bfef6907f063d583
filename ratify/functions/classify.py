"""Classification and weight expressions (all built-in, codegen friendly)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratify.sources import rules as R


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_true(flag: Column | str) -> Column:
    """Three-valued flag -> boolean: only TRUE is true (NULL counts as false)."""
    return F.coalesce(_c(flag), F.lit(False))


def vehicle_family(family: Column | str, category: Column | str) -> Column:
    """Model family, falling back to the family category, then to the default."""
    family, category = _c(family), _c(category)
    family_unknown = family.isNull() | family.isin(*R.FAMILY_UNKNOWN)
    category_unknown = category.isNull() | category.isin(*R.CATEGORY_UNKNOWN)
    return (F.when(~family_unknown, family)
            .when(~category_unknown, category)
            .otherwise(F.lit(R.FAMILY_DEFAULT)))


def maintenance_kind(description: Column | str, mtype: Column | str) -> Column:
    """Claim by description, preventive by type (exact), else corrective."""
    return (F.when(_c(description) == R.KIND_CLAIM, F.lit(R.KIND_CLAIM))
            .when(_c(mtype) == R.KIND_PREVENTIVE, F.lit(R.KIND_PREVENTIVE))
            .otherwise(F.lit(R.KIND_CORRECTIVE)))


def item_band(n_items: Column | str) -> Column:
    """Item count -> band label, from the band rule table (0 falls in the first band)."""
    n = _c(n_items)
    expr = None
    for upper, label in R.ITEM_BANDS:
        if upper is None:
            return expr.otherwise(F.lit(label))
        cond = n <= upper
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def extra_review_minutes(n_reviews: Column | str) -> Column:
    """5 minutes per review interaction; none/unknown -> 0."""
    n = _c(n_reviews)
    return F.when(n >= 1, n * R.MINUTES_PER_REVIEW).otherwise(F.lit(0))


def extra_quote_minutes(n_quotes: Column | str, customer_class: Column | str) -> Column:
    """Special customer: 5 per quote up to a cap; others: a flat 5 for any quote."""
    n, cls = _c(n_quotes), _c(customer_class)
    special = cls == F.lit("special")
    return (F.when(special & (n >= R.SPECIAL_QUOTE_CAP_AT), F.lit(R.SPECIAL_QUOTE_CAP))
            .when(special & (n >= 1), n * R.MINUTES_PER_QUOTE)
            .when(n >= 1, F.lit(R.MINUTES_PER_QUOTE))
            .otherwise(F.lit(0)))


def extra_public_market_minutes(n_items: Column | str, customer_class: Column | str) -> Column:
    """Public-market customers: items + 5; the special customer: 1.5 * items + 5."""
    n, cls = _c(n_items), _c(customer_class)
    return (F.when(cls == F.lit("public"), (n + R.PUBLIC_MARKET_BASE).cast("decimal(20,1)"))
            .when(cls == F.lit("special"),
                  (n.cast("decimal(20,0)") * F.lit(R.SPECIAL_ITEM_MULTIPLIER)
                   + R.PUBLIC_MARKET_BASE).cast("decimal(20,1)"))
            .otherwise(F.lit(Decimal("0")).cast("decimal(20,1)")))


def _correction(severity_factor: Column, partner_price: Column) -> Column:
    price = F.when(is_true(partner_price), F.lit(R.PARTNER_PRICE_FACTOR)).otherwise(
        F.lit(Decimal("1.0")))
    return severity_factor.cast("decimal(2,1)") * price.cast("decimal(2,1)")


def daily_target(total_minutes: Column | str, severity_factor: Column | str,
                 partner_price: Column | str) -> Column:
    """Orders per day the weighted order allows: 448.8 / T / (severity * price)."""
    t = _c(total_minutes).cast("decimal(20,1)")
    return (F.lit(R.DAILY_MINUTES) / t) / _correction(_c(severity_factor), _c(partner_price))


def order_weight(total_minutes: Column | str, severity_factor: Column | str,
                 partner_price: Column | str) -> Column:
    """Weight of one order = round(1 / daily_target, 2) = round(T*s*p / 448.8, 2), HALF_UP."""
    t = _c(total_minutes).cast("decimal(20,1)")
    raw = t * _correction(_c(severity_factor), _c(partner_price)) / F.lit(R.DAILY_MINUTES)
    return F.round(raw, 2).cast("decimal(18,2)")
