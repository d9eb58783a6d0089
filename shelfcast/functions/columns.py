"""Column functions shared by the plans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Raw market labels and the market they stand for.
MARKET_MAP = {"Pan-EU": "EU", "DE": "EU", "GB": "UK", "North America": "US"}
PAN_EU = {"Pan-EU": "EU"}
PLAN_MARKETS = {"Pan-EU": "EU", "DE": "EU"}


def normalize_market(market: Column, mapping: Mapping[str, str] = MARKET_MAP) -> Column:
    cases = F
    for raw, name in mapping.items():
        cases = cases.when(market == raw, F.lit(name))
    return cases.otherwise(market)


def item_of(listing: Column, sku: Column, blank: str = "trim") -> Column:
    """The listing, or the sku where there is no listing.

    `blank` says what counts as none besides NULL: "trim" any blank text, "empty" only the empty
    text, "null" nothing else.
    """
    if blank == "trim":
        known = F.when(F.trim(listing) != "", listing)
    elif blank == "empty":
        known = F.nullif(listing, F.lit(""))
    elif blank == "null":
        known = listing
    else:
        raise ValueError(f"blank: {blank!r}")
    return F.coalesce(known, sku)


def ref_of(item: Column, market: Column) -> Column:
    return F.concat(item, market)


def ref_market(ref: Column, market_chars: Column) -> Column:
    """The market a ref ends with, given its number of characters."""
    return F.right(ref, market_chars)


def ref_item(ref: Column, market_chars: Column) -> Column:
    """The item a ref begins with, given the number of characters of its market."""
    return F.left(ref, F.length(ref) - market_chars)


def stock_item(listing: Column) -> Column:
    """Stock without a listing is kept under its market alone."""
    return F.coalesce(F.when(F.trim(listing) != "", listing), F.lit(""))


def german_date(text: Column) -> Column:
    """Date written as DD.MM.YYYY, with or without leading zeros; NULL when it is not one.

    Turning the parts round for a plain cast, which takes days and months of one digit, is several
    times faster than a date pattern.
    """
    parts = [F.split_part(text, F.lit("."), F.lit(n)) for n in (3, 2, 1)]
    return F.when(text.rlike(r"^[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4}$"), F.concat_ws("-", *parts).try_cast("date"))


def clean_numeric(value: Column, default: float = 0) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(float(default)))


def safe_divide(numerator: Column, denominator: Column, default: float = 0) -> Column:
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(float(default)))


def format_number(value: Column) -> Column:
    """Whole number with thousands separators, rounded half to even."""
    return F.format_number(F.bround(value, 0), 0)


def col_or(df: DataFrame, name: str, default) -> Column:
    return F.col(name) if name in df.columns else F.lit(default)


def floor_at_zero(value: Column) -> Column:
    """max(value, 0) that keeps NULL, which plain greatest() would skip."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0)))


def size_tier(weight: Column, height: Column, length: Column, width: Column) -> Column:
    """Parcel size class; an unknown measure makes the parcel Oversize."""
    longest = F.greatest(length, height, width)
    girth = length + 2 * (height + width)
    # Parcel limits in kilograms and centimetres.
    small = (
        (weight <= 0.45)
        & (longest <= 38.1)
        & (length <= 33.02)
        & (width <= 27.94)
        & (height <= 5.08)
    )
    large = (weight <= 9.07) & (longest <= 45.72) & (girth <= 330.2)
    return F.when(small | large, F.lit("Standard")).otherwise(F.lit("Oversize"))


def received_quantity(substatus: Column, received: Column, remaining: Column) -> Column:
    """Units booked in: none before the shipment has a sub-status, never a negative count."""
    booked = F.when(received >= 0, received).otherwise(remaining)
    return F.when(substatus.isNull(), F.lit(0)).otherwise(booked)


def units(text: Column) -> Column:
    """Whole number kept as text at the source; nothing counts as 0."""
    return F.coalesce(text.cast("long"), F.lit(0))


def check_columns(df: DataFrame, required: list[str], name: str = "table") -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return df


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [column for column in required if column not in df.columns]
