"""Codes to labels, cohorts and bands."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from coffer.functions.dates import DateLike, day

# Code lists of the core banking tables.
CLIENT_STATUS = {"0": "Invalid", "100": "Pending", "300": "Active", "600": "Closed"}
CLIENT_GENDER = {"29": "Male", "30": "Female"}
CLIENT_TYPE = {"64": "Personal", "65": "Official", "66": "Business"}
MARITAL_STATUS = {"61": "Single", "62": "Married", "63": "Divorcee"}
CLIENT_TIER = {"99": "Tier 1", "100": "Tier 2", "101": "Tier 3"}


def decode(code: Column | str, labels: Mapping[str, str]) -> Column:
    """Label of a code; null for a code outside the list."""
    code = (F.col(code) if isinstance(code, str) else code).cast("string")
    chain: Column | None = None
    for key, label in labels.items():
        chain = F.when(code == key, label) if chain is None else chain.when(code == key, label)
    return chain


def generation_cohort(dob_text: Column) -> Column:
    """Generation from a date-of-birth text whose last four characters are the year. 1945 has no cohort."""
    year = F.right(dob_text, F.lit(4))
    return (
        F.when(dob_text.isNull(), "Not Found")
        .when(year < "1945", "Silent Generation")
        .when(year.between("1946", "1964"), "Baby Boomers")
        .when(year.between("1965", "1979"), "Generation X")
        .when(year.between("1980", "1994"), "Millennials")
        .when(year.between("1995", "2012"), "Generation Z")
        .when(year > "2012", "Generation Alpha")
    )


def stickiness(days_idle: Column) -> Column:
    return F.when(days_idle <= 30, "sticky").otherwise("non sticky")


def activity_status(days_idle: Column) -> Column:
    """Active up to 90 days, inactive 91 to 180, dormant beyond."""
    return F.when(days_idle <= 90, "active").when(days_idle.between(91, 180), "inactive").otherwise("dormant")


def risk_band(score: Column) -> Column:
    """Low through 1.5, high from 4, medium between; null score gives null."""
    return (
        F.when(score <= 1.5, "Low risk")
        .when((score > 1.5) & (score < 4), "Medium risk")
        .when(score >= 4, "High risk")
    )


def maturity_band(maturity: Column, as_of: DateLike) -> Column:
    left = F.datediff(maturity, day(as_of))
    return (
        F.when(left > 60, "above 60 days")
        .when(left >= 31, "btw 31-60 days")
        .when(left < 31, "30 days and below")
    )


def first_valid_account(*candidates: Column) -> Column:
    """First account number that is neither null, blank nor '0'."""
    cleaned = [F.nullif(F.nullif(F.trim(c), F.lit("")), F.lit("0")) for c in candidates]
    return F.coalesce(*cleaned)


def card_type_by_charge(charge: Column) -> Column:
    return F.when(charge <= 1000, "Virtual").when(charge > 1000, "Physical").otherwise("Unclassified")


def expires_in_year(expiry_yymm: Column, as_of: dt.date) -> Column:
    """True where a YYMM expiry code falls in the year of ``as_of``."""
    return F.left(expiry_yymm, F.lit(2)) == F.lit(f"{as_of.year % 100:02d}")
