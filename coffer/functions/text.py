"""Text rules as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Airtime brands, looked for in this order.
AIRTIME_BRANDS: Sequence[tuple[str, tuple[str, ...]]] = (
    ("MTN", ("MTN",)),
    ("AIRTEL", ("AIRTEL",)),
    ("GLO", ("GLO",)),
    ("9MOBILE", ("9MOBILE",)),
)

# Biller names and the marks that identify them. The order decides: first match wins.
BILLER_RULES: Sequence[tuple[str, tuple[str, ...]]] = (
    ("GOTV CABLE SERVICE", ("GOTV",)),
    ("BET9JA", ("BET 9JA", "BET9JA")),
    ("SPORTYBET", ("SPORTYBET", "SPORTY BET")),
    ("IKEJA ELECTRIC", ("IKEJA", "IKEDC")),
    ("DSTV CABLE SERVICE", ("DSTV",)),
    ("ABUJA ELECTRIC", ("ABUJA",)),
    ("EKO ELECTRIC", ("EKO", "EKEDC")),
    ("IBADAN ELECTRIC", ("IBADAN", "IBEDC")),
    ("BETKING", ("BETKING", "BET KING")),
    ("1XBET", ("1XBET", "1X BET")),
    ("STARTIMES CABLE SERVICE", ("STARTIMES", "STAR TIMES")),
    ("SMILE INTERNET SERVICE", ("SMILE",)),
    ("NAIRABET", ("NAIRABET",)),
    ("ENUGU ELECTRIC", ("ENUGU", "EEDC")),
    ("XBOX", ("XBOX",)),
    ("MERRYBET", ("MERRYBET", "MERRY BET")),
    ("SWIFT INTERNET SERVICE", ("SWIFT",)),
    ("BENIN ELECTRIC", ("BENIN", "BEEDC")),
    ("GOOGLE PLAY SERVICE", ("GOOGLE",)),
    ("BETWAY", ("BETWAY", "BET WAY")),
    ("IPNX", ("IPNX",)),
    ("SONY PLAYSTATION", ("SONY PLAYSTATION",)),
    ("AMAZON", ("AMAZON",)),
    ("SPOTIFY", ("SPOTIFY",)),
    ("BANGBET", ("BANGBET", "BANG BET")),
    ("PORTHARCOURT ELECTRIC", ("PORTHARCOURT", "PHEDC", "PEDC")),
    ("KADUNA ELECTRIC", ("KADUNA",)),
    ("TSTV CABLE SERVICE", ("TSTV",)),
    ("ARIK AIRLINE", ("ARIK",)),
    ("KANO ELECTRIC", ("KANO",)),
    ("AXA MANSARD", ("AXA",)),
    ("NAIJABET", ("NAIJABET",)),
    ("WINNERS CHAPEL", ("WINNERS CHAPEL",)),
    ("SPECTRANET INTERNET SERVICE", ("SPECTRANET",)),
    ("MLOTTO BET", ("MLOTTO",)),
    ("WINNERS GOLDEN BET", ("WINNERS GOLDEN CHANCE", "WGB")),
    ("FLEXI INTERNET", ("FLEXI",)),
)

# Segment names by recency and frequency score.
RFM_SEGMENTS: Sequence[tuple[str, str]] = (
    ("[1-2][1-2]", "Hibernating"),
    ("[1-2][3-4]", "At Risk"),
    ("[1-2]5", "Cant Loose"),
    ("3[1-2]", "About To Sleep"),
    ("33", "Need Attention"),
    ("[3-4][4-5]", "Loyal Customers"),
    ("41", "Promising"),
    ("51", "New Customers"),
    ("[4-5][2-3]", "Potential Loyalists"),
    ("5[4-5]", "Champions"),
)


def first_mark(upper: Column, rules: Sequence[tuple[str, tuple[str, ...]]]) -> Column:
    """Name of the first rule with a mark contained in the (upper-case) text; null where none is.

    The rules are data, one constant array, so the generated code stays as small as it is for a single rule. Meant for
    distinct codes, see ``operators.bills``.
    """
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, marks)).alias("marks")) for name, marks in rules])
    hits = F.filter(table, lambda rule: F.exists(rule["marks"], lambda mark: F.contains(upper, mark)))
    return F.get(hits, F.lit(0))["name"]


def airtime_brand(upper: Column) -> Column:
    return first_mark(upper, AIRTIME_BRANDS)


def biller_name(upper: Column, code: Column, width: int | None = None) -> Column:
    """Biller of a code, given in upper case and as it is; a code without a rule is its own name.

    ``width`` cuts such a name, for reports that print 27 characters. Codes that agree so far then share a name, so
    nothing here groups by it unless asked to.
    """
    return F.coalesce(first_mark(upper, BILLER_RULES), code if width is None else F.left(code, F.lit(width)))


def rfm_segment(score_pair: Column) -> Column:
    chain: Column | None = None
    for pattern, name in RFM_SEGMENTS:
        hit = score_pair.rlike(f"^{pattern}$")
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain


def code_or_remarks(code: Column, remarks: Column, blank: str = "Blank") -> Column:
    """The code, or the remarks where the code is missing or the placeholder."""
    return F.when(code.isNull() | (code == blank), remarks).otherwise(code)


def clip_strings(df: DataFrame, limits: dict[str, int] | int, only: Iterable[str] | None = None) -> DataFrame:
    """Cuts string columns to a length: one limit for all of them or one per column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    wanted = set(only) if only is not None else set(texts)
    out = {}
    for name in texts:
        limit = limits if isinstance(limits, int) else limits.get(name)
        if limit is not None and name in wanted:
            out[name] = F.left(F.col(name), F.lit(limit))
    return df.withColumns(out) if out else df


def clip_beside(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Adds ``<column>_clipped`` and ``<column>_was_cut`` for each column with a limit; the column itself stays whole."""
    out = {}
    for name, limit in limits.items():
        out[f"{name}_clipped"] = F.left(F.col(name), F.lit(limit))
        out[f"{name}_was_cut"] = F.coalesce(F.char_length(F.col(name)) > limit, F.lit(False))
    return df.withColumns(out)


def pan_head(pan: Column) -> Column:
    return F.left(pan, F.lit(6))


def pan_tail(pan: Column) -> Column:
    return F.right(pan, F.lit(4))


def id_head(ids: Column) -> Column:
    """Part of a dash-joined id list before the first dash."""
    return F.substring_index(ids, "-", 1)


def strip_codes(text: Column, codes: Sequence[str]) -> Column:
    """Removes each literal code, in the order given."""
    for code in codes:
        text = F.replace(text, F.lit(code), F.lit(""))
    return text


def explode_list_text(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows from a list held as text, ``[a,b,c]``."""
    bare = F.regexp_replace(F.col(column), r"[\[\]\s]", "")
    return df.withColumn(name, F.explode(F.split(bare, ",")))


def suffix_resource(resource: Column, value: Column, resources: Sequence[str], suffix: str = "-account") -> Column:
    """Marks a call of one of ``resources`` by ``suffix`` where its value holds a slash."""
    relabel = resource.isin(list(resources)) & F.contains(value, F.lit("/"))
    return F.when(relabel, F.concat(resource, F.lit(suffix))).otherwise(resource)


def thousands(value: Column, decimals: int = 0, prefix: str = "") -> Column:
    """Number as text with thousands separators."""
    text = F.format_number(value, decimals)
    return F.concat(F.lit(prefix), text) if prefix else text


def percent_text(value: Column, decimals: int = 2) -> Column:
    return F.concat(F.format_number(value, decimals), F.lit("%"))
