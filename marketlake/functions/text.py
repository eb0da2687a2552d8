"""String cleaning as Column expressions (JVM side, codegen friendly).

Every function takes and returns a ``Column``; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.functions._util import as_col

# --- fixed values that must equal the reference's ---------------------------
# Predefined targeting expressions (match type TARGETING_EXPRESSION_PREDEFINED).
PREDEFINED_TARGETING = ["close-match", "loose-match", "substitutes", "complements"]
# Placement labels of the console history and the API label they map to.
PLACEMENT_LABELS = {
    "First page Top of Search on Amazon": "Top of Search on-Amazon",
    "Top of Search": "Top of Search on-Amazon",
    "Product pages on Amazon": "Detail Page on-Amazon",
    "Product Pages": "Detail Page on-Amazon",
    "Rest of search on Amazon": "Other on-Amazon",
    "Rest of Search": "Other on-Amazon",
    "Search on-Amazon": "Other on-Amazon",
}
# Text spellings treated as missing values.
NULL_TOKENS = ["--", "", "-", "None", "nan", "NaN"]
# Marker of the campaign segment that keeps its full name in campaign_key.
AU_SEGMENT = "| AU |"
# -----------------------------------------------------------------------------


def product_code(c, sep: str = "-", all_code: str | None = None) -> Column:
    """X01 (X18 CASE): first ``sep``-separated segment when the text contains ``sep``, else NULL.

    With ``all_code`` set, the literal value ``all_code`` maps to itself
    (the 'ALL' portfolio of the brand marts).
    """
    c = as_col(c)
    out = F.when(c.contains(sep), F.split_part(c, F.lit(sep), F.lit(1)))
    if all_code is not None:
        out = F.when(c == F.lit(all_code), F.lit(all_code)).otherwise(out)
    return out


def campaign_key(c) -> Column:
    """Bracketed text and ``{ARCHIVE}`` removed, trimmed; when the name starts
    with three pipe-terminated segments and does not contain the AU segment, only
    those segments are kept (trimmed)."""
    c = as_col(c)
    base = F.trim(F.replace(F.trim(F.regexp_replace(c, r"\[.*\]", "")), F.lit("{ARCHIVE}"), F.lit("")))
    lead = F.regexp_extract(base, r"^((?:[^|]*\|){3})", 1)
    return F.when((lead != F.lit("")) & ~base.contains(AU_SEGMENT), F.trim(lead)).otherwise(base)


def canonical_targeting(c) -> Column:
    """``[Close Match]`` → ``close-match``; ``B0…`` → ``asin="B0…"`` upper-cased."""
    c = as_col(c)
    bracket = F.trim(F.replace(F.lower(F.regexp_extract(c, r"^\[(.*)\]", 1)), F.lit(" "), F.lit("-")))
    return (F.when(c.startswith("["), bracket)
             .when(c.startswith("B0"), F.concat(F.lit('asin="'), F.upper(c), F.lit('"')))
             .otherwise(c))


def match_type(targeting, current) -> Column:
    """X07 (X16 upper): ``asin…`` → TARGETING_EXPRESSION; predefined names →
    TARGETING_EXPRESSION_PREDEFINED; otherwise the current match type upper-cased."""
    t, cur = as_col(targeting), as_col(current)
    return (F.when(t.startswith("asin"), F.lit("TARGETING_EXPRESSION"))
             .when(t.isin(PREDEFINED_TARGETING), F.lit("TARGETING_EXPRESSION_PREDEFINED"))
             .otherwise(F.upper(cur)))


def placement_label(c) -> Column:
    """Map console placement labels to API labels; unknown labels pass through."""
    c = as_col(c)
    m = F.create_map(*[F.lit(x) for kv in PLACEMENT_LABELS.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), c)


def digits_only(c) -> Column:
    """Keep digits; empty result → NULL."""
    return F.nullif(F.regexp_replace(as_col(c), r"\D", ""), F.lit(""))


def norm_key(c, upper: bool = False) -> Column:
    """X11: trim + lower (or upper)."""
    c = F.trim(as_col(c))
    return F.upper(c) if upper else F.lower(c)


def repair_search_query(c) -> Column:
    """Four spaces → one; a backslash → ``(?)``."""
    return F.replace(F.replace(as_col(c), F.lit("    "), F.lit(" ")), F.lit("\\"), F.lit("(?)"))


def strip_non_word(c) -> Column:
    """Remove every non-word character."""
    return F.regexp_replace(as_col(c), r"\W", "")


def bracketed_id(c) -> Column:
    """The first ``["…"]`` value in a text (empty → NULL)."""
    return F.nullif(F.regexp_extract(as_col(c), r'\["(.*?)"\]', 1), F.lit(""))


def last_chars(c, n: int = 3) -> Column:
    """Last ``n`` characters."""
    return F.right(as_col(c), F.lit(n))


def null_if_token(c, tokens=NULL_TOKENS) -> Column:
    """P16 on one column: known missing-value spellings → NULL."""
    c = as_col(c)
    return F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c)


def currency_code(marketplace) -> Column:
    """P14 fixed: marketplace → ISO currency via a map instead of ``mk + 'D'``."""
    m = F.create_map(*[F.lit(x) for kv in MARKETPLACE_CURRENCY.items() for x in kv])
    return F.try_element_at(m, as_col(marketplace))


# Currency of each marketplace country code (ISO 4217); replaces the
# reference's ``marketplace + 'D'`` which is wrong outside US/CA/AU.
MARKETPLACE_CURRENCY = {
    "US": "USD", "CA": "CAD", "MX": "MXN", "BR": "BRL", "UK": "GBP", "GB": "GBP",
    "DE": "EUR", "FR": "EUR", "IT": "EUR", "ES": "EUR", "NL": "EUR", "BE": "EUR",
    "IE": "EUR", "SE": "SEK", "PL": "PLN", "TR": "TRY", "EG": "EGP", "SA": "SAR",
    "AE": "AED", "IN": "INR", "ZA": "ZAR", "SG": "SGD", "AU": "AUD", "JP": "JPY",
}
