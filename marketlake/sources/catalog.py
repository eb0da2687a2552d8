"""Report catalog (S11), primary keys (§1.4) and the type rule of report metrics.

The catalog maps ``ad product → report type → groupBy`` to a target table: every report of the
reporting API's version 3 and, under its own report names, of version 2.  Which metrics a report
has is not written down here: that is what was asked for when it was requested, so it is a
parameter (``report_schema(metrics)``) or is read from the landed reports (``landed_metrics``).
A metric's type follows from its name by ``TYPE_RULES``; a name that no rule knows is an error,
never a guess.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.names import normalise_name

# --- fixed values: reports and their tables, names of metric kinds, primary keys -------------------
# version 3: ad product, report type, groupBy, table
REPORTS: list[tuple[str, str, str, str]] = [
    ("SPONSORED_PRODUCTS", "spCampaigns", "['campaign']", "campaign"),
    ("SPONSORED_PRODUCTS", "spCampaigns", "['campaign', 'adGroup']", "campaign_adgroup"),
    ("SPONSORED_PRODUCTS", "spCampaigns", "['campaign', 'campaignPlacement']", "campaign_placement"),
    ("SPONSORED_PRODUCTS", "spTargeting", "['targeting']", "targeting"),
    ("SPONSORED_PRODUCTS", "spSearchTerm", "['searchTerm']", "search_term"),
    ("SPONSORED_PRODUCTS", "spAdvertisedProduct", "['advertiser']", "advertised_product"),
    ("SPONSORED_PRODUCTS", "spPurchasedProduct", "['asin']", "purchased_product"),
    ("SPONSORED_PRODUCTS", "spGrossAndInvalids", "['campaign']", "gross_and_invalid_traffic"),
    ("SPONSORED_BRANDS", "sbCampaigns", "['campaign']", "campaign"),
    ("SPONSORED_BRANDS", "sbAdGroup", "['adGroup']", "adgroup"),
    ("SPONSORED_BRANDS", "sbCampaignPlacement", "['campaignPlacement']", "campaign_placement"),
    ("SPONSORED_BRANDS", "sbTargeting", "['targeting']", "targeting"),
    ("SPONSORED_BRANDS", "sbSearchTerm", "['searchTerm']", "search_term"),
    ("SPONSORED_BRANDS", "sbAds", "['ads']", "ad"),
    ("SPONSORED_BRANDS", "sbPurchasedProduct", "['purchasedAsin']", "purchased_product"),
    ("SPONSORED_BRANDS", "sbGrossAndInvalids", "['campaign']", "gross_and_invalid_traffic"),
    ("SPONSORED_DISPLAY", "sdCampaigns", "['campaign']", "campaign"),
    ("SPONSORED_DISPLAY", "sdCampaigns", "['campaign', 'matchedTarget']", "matched_target_campaign"),
    ("SPONSORED_DISPLAY", "sdAdGroup", "['adGroup']", "adgroup"),
    ("SPONSORED_DISPLAY", "sdTargeting", "['targeting']", "targeting"),
    ("SPONSORED_DISPLAY", "sdTargeting", "['targeting', 'matchedTarget']", "targeting_matched_asin"),
    ("SPONSORED_DISPLAY", "sdAdvertisedProduct", "['advertiser']", "advertised_product"),
    ("SPONSORED_DISPLAY", "sdGrossAndInvalids", "['campaign']", "gross_and_invalid"),
]

# version 2: ad product, report, table
REPORTS_V2: list[tuple[str, str, str]] = [
    ("SPONSORED_BRANDS", "campaigns", "campaign_v2"),
    ("SPONSORED_BRANDS", "campaigns - placement", "campaign_placement_v2"),
    ("SPONSORED_BRANDS", "adGroups", "adgroup_v2"),
    ("SPONSORED_BRANDS", "targets", "targeting_v2"),
    ("SPONSORED_BRANDS", "keywords", "keyword_v2"),
    ("SPONSORED_BRANDS", "keywords - query", "search_term_v2"),
    ("SPONSORED_BRANDS", "ads", "ad_v2"),
    ("SPONSORED_DISPLAY", "campaigns", "campaign_v2"),
    ("SPONSORED_DISPLAY", "adGroups", "adgroup_v2"),
    ("SPONSORED_DISPLAY", "productAds", "advertised_product_v2"),
    ("SPONSORED_DISPLAY", "targets", "targeting_v2"),
    ("SPONSORED_DISPLAY", "campaigns - matchedTarget", "matched_target_campaign_v2"),
    ("SPONSORED_DISPLAY", "adGroups - matchedTarget", "matched_target_adgroup_v2"),
    ("SPONSORED_DISPLAY", "targets - matchedTarget", "matched_target_targeting_v2"),
]

# a metric's type by its name; the first rule that matches the whole name counts
TYPE_RULES: list[tuple[str, T.DataType]] = [
    (r"date|startDate|endDate", T.DateType()),
    # names, states and codes
    (r"currency|keyword|targeting|searchTerm|asin|sku|asinBrandHalo", T.StringType()),
    (r".*(Name|Status|Strategy|Type|CurrencyCode|Text|Expression|Asin|Sku|Category|Classification|Optimization|RuleId)",
     T.StringType()),
    (r"\w+Id", T.LongType()),
    # money, bids, rates and shares
    (r"(cost|spend|sales|acos|roas|eCP|vctr|vtr|avg).*", T.DoubleType()),
    (r".*(Sales|Rate|Percentage|Share|Royalties|Average|ECP).*", T.DoubleType()),
    (r".*(Budget|Amount|Bid)", T.DoubleType()),
    # counts of events
    (r"(impressions|clicks|purchases|unitsSold|orders|conversions|addToCart|brandedSearches|detailPageViews|dpv|"
     r"cumulativeReach)\w*", T.LongType()),
    (r"(video|view|gross|invalid|newToBrand|attributed|kindle)\w*(Views?|Impressions|Clicks|ClickThroughs|Purchases|"
     r"UnitsSold|UnitsOrdered|Orders|Conversions|BrandedSearches|PagesRead|videoUnmutes|Unmutes)\w*", T.LongType()),
]

# Primary keys of stored tables (drive upsert, de-dup and partitioning).
KEYS: dict[str, list[str]] = {
    "search_query_performance_asin_view": ["reporting_date", "reporting_range", "marketplace", "asin", "search_query"],
    "cerebro_amazon": ["country", "category", "date", "Keyword Phrase"],
    "h10_keyword_tracker": ["asin", "keyword", "marketplace", "date_added"],
    "campaigns": ["campaign_id"],
    "amazon_advertising_portfolios": ["portfolio_id"],
    "inventory.fba": ["date", "marketplace", "asin"],
    "inventory.fba_planning_inventory": ["marketplace", "snapshot_date", "sku", "condition"],
    "listings_items.summaries": ["sku", "date", "marketplace"],
    "listings_items.issues": ["sku", "date", "marketplace", "code", "message"],
    "listings_items.offers": ["sku", "date", "marketplace", "offer_type"],
    "product_pricing.competitive_pricing": ["asin", "date", "marketplace", "customer_type"],
    "orders.amazon_orders": ["amazon_order_id"],
    "orders.amazon_order_items": ["order_item_id"],
    "business_reports.fba_fee_preview": ["date", "asin", "sku", "fnsku", "amazon_store"],
    "sponsored_products.targeting": ["date", "ad_group_id", "targeting", "match_type"],
    "sponsored_products.campaign_placement": ["date", "campaign_id", "placement_classification"],
    "exchangerate_host.rates": ["recorded_at", "base", "target"],
}
# -----------------------------------------------------------------------------

_DECLARED: dict[str, T.DataType] = {}      # by ``declare_types``


def declare_types(types: dict[str, T.DataType]) -> None:
    """Types of metrics that no rule knows, or that a rule gets wrong."""
    _DECLARED.update(types)


def column_type(name: str) -> T.DataType:
    """The type of a report metric; a name that no rule knows is a KeyError."""
    if name in _DECLARED:
        return _DECLARED[name]
    for pattern, kind in TYPE_RULES:
        if re.fullmatch(pattern, name):
            return kind
    raise KeyError(f"no type rule knows the metric {name!r}; see declare_types")


def metric_names(metrics: str | Sequence[str]) -> list[str]:
    """Metric names without repeats, from a list or from a text with commas."""
    names = metrics.split(",") if isinstance(metrics, str) else metrics
    return list(dict.fromkeys(n.strip() for n in names if n.strip()))


def report_schema(metrics: str | Sequence[str], time_unit: str = "DAILY") -> T.StructType:
    """Raw (camelCase) schema of a report with these metrics for a time unit."""
    from marketlake.operators.shape import report_columns
    names = metric_names(report_columns(metric_names(metrics), time_unit))
    return T.StructType([T.StructField(c, column_type(c)) for c in names])


def stored_schema(metrics: str | Sequence[str], time_unit: str = "DAILY") -> T.StructType:
    """Stored (snake_case) schema: tenant, marketplace, then the normalised metrics."""
    raw = report_schema(metrics, time_unit)
    fields = [T.StructField("tenant_id", T.IntegerType()), T.StructField("marketplace", T.StringType())]
    fields += [T.StructField(normalise_name(f.name), f.dataType) for f in raw.fields]
    return T.StructType(fields)


def register_report(product: str, report_type: str, group_by: str, table: str,
                    types: dict[str, T.DataType] | None = None) -> None:
    """Add a report; ``types`` declares those of its metrics that no rule knows."""
    declare_types(types or {})
    REPORTS.append((product, report_type, group_by, table))


def lookup(product: str, report_type: str, group_by: str) -> str:
    """Table of a version 3 report."""
    return next(t for p, r, g, t in reversed(REPORTS) if (p, r, g) == (product, report_type, group_by))


def lookup_v2(product: str, report_type: str) -> str:
    """Table of a version 2 report (one day per file; the day comes from the file name)."""
    return next(t for p, r, t in REPORTS_V2 if (p, r) == (product, report_type))


def catalog_frame(spark: SparkSession) -> DataFrame:
    """The catalog as a small DataFrame (for routing joins)."""
    rows = [(p, r, g, f"{p.lower()}.{t}") for p, r, g, t in REPORTS]
    return spark.createDataFrame(rows, "ad_product string, report_type string, group_by string, table_name string")


def route(files: DataFrame, spark: SparkSession) -> DataFrame:
    """Attach the target table to each row/file by its (product, type, groupBy)
    parsed from the file name (the catalog is tiny and fixed: broadcast)."""
    return files.join(F.broadcast(catalog_frame(spark)), ["ad_product", "report_type", "group_by"], "left")


def landed_metrics(spark: SparkSession, path: str, glob: str = "*.json.gz") -> DataFrame:
    """Table and metrics of every kind of report below ``path``, from the reports themselves:
    ad_product, report_type, group_by, table_name, metrics (sorted names that any record has).

    Every file is a JSON array of records; names are reduced map-side, so what is shuffled is one
    row per file and name at most."""
    from marketlake.sources.files import REPORT_NAME, _reader, name_parts, source_file
    text = _reader(spark, None, glob, wholetext=True).text(path).select(source_file().alias("f"), "value")
    records = text.select("f", F.explode(F.from_json("value", "array<map<string,string>>")).alias("r"))
    parts = name_parts(F.col("f"), REPORT_NAME, ["ad_product", "_country", "report_type", "group_by"])
    names = records.select(*[parts[n].alias(n) for n in ("ad_product", "report_type", "group_by")],
                           F.explode(F.map_keys("r")).alias("metric")).distinct()
    kinds = names.groupBy("ad_product", "report_type", "group_by").agg(F.sort_array(F.collect_list("metric")).alias("metrics"))
    return route(kinds, spark).select("ad_product", "report_type", "group_by", "table_name", "metrics")
