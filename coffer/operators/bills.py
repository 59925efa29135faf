"""Bills and airtime out of settlements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.functions.text import airtime_brand, biller_name, code_or_remarks
from coffer.operators.joins import left_join_known


def with_code_text(purchases: DataFrame) -> DataFrame:
    """Biller code, or the remarks where the code is the placeholder."""
    return purchases.withColumn("biller_code", code_or_remarks(F.col("biller_code"), F.col("remarks")))


def classified_codes(purchases: DataFrame, width: int | None = None) -> DataFrame:
    """Each known ``biller_code`` in use once, with its airtime ``brand`` and its ``biller_by_rule``.

    Codes are few and purchases many: dozens of rules look at each text once, and purchases take the answer by an equi
    join. Spark broadcasts the codes where their size allows it.
    """
    codes = purchases.select("biller_code").filter(F.col("biller_code").isNotNull()).distinct()
    upper = F.upper("biller_code")
    return codes.select(
        "biller_code", airtime_brand(upper).alias("brand"), biller_name(upper, F.col("biller_code"), width).alias("biller_by_rule")
    )


def with_biller(purchases: DataFrame, width: int | None = None) -> DataFrame:
    """Purchases with the biller by rule; one without a code has none."""
    return left_join_known(purchases, classified_codes(purchases, width).drop("brand"), "biller_code").select(*purchases.columns, "biller_by_rule")


def airtime_transactions(purchases: DataFrame) -> DataFrame:
    """Purchases whose code names an airtime brand, with the brand."""
    coded = with_code_text(purchases)
    branded = classified_codes(coded).filter(F.col("brand").isNotNull()).drop("biller_by_rule")
    return coded.join(branded, "biller_code").select(*coded.columns, "brand")


def bills_transactions(purchases: DataFrame) -> DataFrame:
    """Purchases that are not airtime, with the biller by rule. A purchase without a code is kept; no rule knows it."""
    coded = with_code_text(purchases)
    others = classified_codes(coded).filter(F.col("brand").isNull()).drop("brand")
    named = coded.join(others, "biller_code").select(*coded.columns, "biller_by_rule")
    return named.unionByName(coded.filter(F.col("biller_code").isNull()).withColumn("biller_by_rule", F.lit(None).cast("string")))


def unmapped_codes(purchases: DataFrame, known: DataFrame) -> DataFrame:
    """Codes in use that the known list lacks."""
    return purchases.select("biller_code").distinct().subtract(known.select("biller_code"))
