"""Ingest flows (C17–C32): landed report → clean, keyed batch → keyed table.

Each function is DataFrame in, DataFrame out (the batch for ``KeyedTable.upsert``
or ``append_once``); reading is done by ``marketlake.sources`` and writing by
``marketlake.sinks``, so one lazy plan covers all files, tenants and
marketplaces of a load and the only shuffles are on the table keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import functions as mf
from marketlake.functions._util import ts_lit
from marketlake.operators.dedupe import assert_unique, dedupe, duplicate_rows, latest_snapshot
from marketlake.operators.incremental import DEFAULT_WATERMARK
from marketlake.operators.joins import broadcast_if_small, cleaned_key_join, map_lookup, missing_children
from marketlake.operators.names import drop_where, normalise_names, rename, select_until, strip_prefix
from marketlake.operators.sequence import carry_down, request_batches
from marketlake.operators.setops import union_by_name
from marketlake.operators.shape import conform, explode_records, fill_defaults, flatten, last_of_list, null_tokens, tag
from marketlake.sources.catalog import KEYS
from marketlake.sources.dimensions import marketplaces

# --- fixed values that must equal the reference's -----------------------------
SEARCH_TERM_RENAME = {"Date": "date", "Campaign": "campaign_name", "Keyword": "targeting", "State": "ad_keyword_status",
                      "Match": "match_type", "Clicks": "clicks", "Orders": "purchases_7d", "Sales": "sales_7d",
                      "Units": "units_sold_clicks_7d", "Cost": "cost", "Current Bid": "keyword_bid",
                      "CPC": "cost_per_click", "ACOS": "acos_clicks_7d", "ROAS": "roas_clicks_7d",
                      "Search Terms": "search_term", "AdGroup": "ad_group_name", "Impressions": "impressions"}
SEARCH_TERM_DROP = ("Conversion", "Last Activity", "Sponsored", "Actions")
TARGETING_RENAME = {"Date": "date", "Campaign": "campaign_name", "AdGroup": "ad_group_name", "Keyword": "targeting",
                    "Match": "match_type", "State": "ad_keyword_status", "Impressions": "impressions",
                    "Clicks": "clicks", "Orders": "purchases_7d", "Units": "units_sold_clicks_7d", "Sales": "sales_7d",
                    "Spent": "cost", "Cost Per Click": "cost_per_click", "Clickthrough Rate %": "click_through_rate",
                    "ACOS %": "acos_clicks_7d", "ROAS": "roas_clicks_7d",
                    "TOS Impression Share %": "top_of_search_impression_share", "Current Bid": "keyword_bid"}
TARGETING_DROP = ("ASIN", "SKU", "Short Name", "Type", "Conversion %", "Cost of Goods Sold", "FBA Fees", "P&L",
                  "Break Even Bid")
PLACEMENT_RENAME = {"Date": "date", "State": "campaign_status", "Campaign": "campaign_name",
                    "Placement": "placement_classification", "Impressions": "impressions", "Clicks": "clicks",
                    "Orders": "purchases_7d", "Units": "units_sold_clicks_7d", "Sales": "sales_7d", "Spent": "cost",
                    "Cost Per Click": "cost_per_click", "Clickthrough Rate %": "click_through_rate",
                    "ACOS %": "acos_clicks_7d", "ROAS": "roas_clicks_7d"}
PLACEMENT_DROP = ("Type", "Conversion %")
MONEY_COLUMNS = ("cost_per_click", "cost", "sales_7d", "attributed_sales_same_sku_7d", "sales_other_sku_7d")
GRID_TEXT = ("Campaign", "Keyword", "State", "Match", "Last Activity", "Sponsored", "Search Terms", "Actions", "AdGroup")
GRID_PERCENT = ("Total CTR", "CTR", "Conversion", "Total Conversion", "ACOS", "Total ACOS")
FEE_TYPES = {"est_referral_fee": "ReferralFee", "est_variable_closing_fee": "VariableClosingFee",
             "est_per_item_fee": "PerItemFee", "est_fba_fee": "FBAFees"}
SKU_PATTERN = "^BB_|^R_"
AWD_RENAME = {"createdAt": "shipment_create_date_utc", "updatedAt": "shipment_last_update_date_utc"}
KEYWORD_RANK_KEYS = ["Keyword", "ASIN", "Date Added", "Marketplace"]
SQP_KEYS = ["reporting_date", "reporting_range", "marketplace", "asin", "search_query"]
# -----------------------------------------------------------------------------


# ---------------------------------------------------------------- C20 ads reports
def ads_report_batch(raw: DataFrame, tenants: DataFrame | None = None, ids=("ad_group_id", "campaign_id")) -> DataFrame:
    """C20: raw camelCase report rows (``read_json_reports``) → stored form:
    names normalised first (so the id defaults apply, E12), NULL ids → 0, the
    account mapped to its tenant, rows without a date dropped."""
    df = normalise_names(raw.drop("source_file"))
    df = fill_defaults(df, {c: 0 for c in ids})
    if tenants is not None and "account" in df.columns:
        t = tenants.select(F.col("company").alias("account"), "tenant_id")
        df = df.join(broadcast_if_small(t), "account", "left")
    return df.dropna(subset=[c for c in ("date",) if c in df.columns])


# ---------------------------------------------------------------- C21 orders
def orders_batch(order_pages: DataFrame, current: DataFrame | None, tenant_id: int, marketplace: str) -> DataFrame:
    """``Orders`` pages → flat rows tagged with tenant/marketplace, keeping
    only orders updated after the stored high-water mark of that
    (tenant, marketplace) (G01)."""
    df = normalise_names(flatten(explode_records(order_pages, "Orders")))
    df = tag(df, tenant_id=F.lit(tenant_id).cast("int"), marketplace=marketplace)
    df = df.withColumns({c: F.to_timestamp(c) for c in ("purchase_date", "last_update_date") if c in df.columns})
    if current is None:
        return df
    # one group: its mark is one scalar, no join
    mine = current.where((F.col("tenant_id") == F.lit(tenant_id)) & (F.col("marketplace") == F.lit(marketplace)))
    mark = mine.select(F.max("last_update_date")).scalar()
    return df.where(F.col("last_update_date") > F.coalesce(mark, F.lit(DEFAULT_WATERMARK).cast("timestamp")))


def order_items_batch(item_pages: DataFrame, tenant_id: int, marketplace: str) -> DataFrame:
    """``OrderItems`` pages (with their ``AmazonOrderId``) → flat item rows."""
    df = explode_records(item_pages, "OrderItems", keep=["AmazonOrderId"])
    df = normalise_names(flatten(df))
    return tag(df, tenant_id=F.lit(tenant_id).cast("int"), marketplace=marketplace)


def backfill_worklist(orders: DataFrame, items: DataFrame, batch: int = 100) -> DataFrame:
    """The newest ``batch`` orders that have no items yet (one set-based pass)."""
    return (missing_children(orders, items, ["amazon_order_id"])
            .orderBy(F.col("purchase_date").desc(), F.col("amazon_order_id").desc()).limit(batch))


# ---------------------------------------------------------------- C22 finances
def finance_events(pages: DataFrame, loaded_at, tenant_id: int, marketplace: str) -> DataFrame:
    """``FinancialEvents.ShipmentEventList`` → one row per shipment item
    (``explode_outer`` keeps events without items), tagged with tenant and
    marketplace and stamped with ``loaded_at``.  Re-loads overlap by design; read
    with ``latest_load_only`` (G10)."""
    ev = explode_records(pages, "FinancialEvents.ShipmentEventList", keep=["source_file"]
                         if "source_file" in pages.columns else [])
    items = ev.select("*", F.explode_outer("ShipmentItemList").alias("__item")).drop("ShipmentItemList")
    items = items.select("*", *[F.col(f"__item.{f.name}").alias(f"item_{f.name}")
                                for f in items.schema["__item"].dataType.fields]).drop("__item")
    return tag(normalise_names(flatten(items)), tenant_id=F.lit(tenant_id).cast("int"), marketplace=marketplace,
               loaded_at=ts_lit(loaded_at))


# ---------------------------------------------------------------- C23 snapshots
def inventory_snapshot(pages: DataFrame, tenant_id: int, marketplace: str, day) -> DataFrame:
    """``inventorySummaries`` → flat rows; the ``inventoryDetails_`` prefix is
    dropped (P08); stamped with the snapshot date."""
    df = flatten(explode_records(pages, "payload.inventorySummaries" if "payload" in pages.columns
                                 else "inventorySummaries"))
    df = normalise_names(strip_prefix(df, "inventoryDetails_"))
    return tag(df, tenant_id=F.lit(tenant_id).cast("int"), marketplace=marketplace, date=F.lit(day).cast("date"))


def listing_snapshot(items: DataFrame, data_set: str, tenant_id: int, marketplace: str, day) -> DataFrame:
    """One included data set (``summaries``, ``issues``, ``offers`` …) of landed
    listing payloads (``sku`` + one array of records per data set): one row per
    record, nested lists reduced to their last value (P03), tagged with sku, date,
    marketplace and tenant."""
    df = normalise_names(flatten(last_of_list(explode_records(items, data_set, keep=["sku"]))))
    return tag(df, tenant_id=F.lit(tenant_id).cast("int"), marketplace=marketplace, date=F.lit(day).cast("date"))


def competitive_pricing(payloads: DataFrame, customer_type: str, tenant_id: int, marketplace: str, day) -> DataFrame:
    """Competitive-price payloads (one record per ASIN) flattened with ``_``;
    tagged with date, marketplace, customer type and tenant."""
    df = normalise_names(flatten(explode_records(payloads, "payload") if "payload" in payloads.columns else payloads))
    return tag(df, date=F.lit(day).cast("date"), marketplace=marketplace, customer_type=customer_type,
               tenant_id=F.lit(tenant_id).cast("int"))


def awd_inventory_batch(pages: DataFrame, tenant_id: int, day, loaded_at) -> DataFrame:
    """AWD ``inventory`` pages → flat rows with date and tenant, stamped with
    ``loaded_at``; load with the once-per-day guard (``append_once``, K06)."""
    df = normalise_names(flatten(explode_records(pages, "inventory")))
    return tag(df, date=F.lit(day).cast("date"), tenant_id=F.lit(tenant_id).cast("int"), loaded_at=ts_lit(loaded_at))


def awd_shipments(pages: DataFrame, tenant_id: int, day) -> DataFrame:
    """AWD inbound shipments; the shipment's own ``createdAt`` / ``updatedAt`` are
    renamed before the table's audit columns of that name are set; phone numbers
    reduced to digits (X10)."""
    df = normalise_names(flatten(rename(explode_records(pages, "shipments"), AWD_RENAME)))
    df = df.withColumns({c: F.to_timestamp(c) for c in AWD_RENAME.values() if c in df.columns})
    phones = [c for c in df.columns if c.endswith("phone_number")]
    df = df.withColumns({c: mf.digits_only(c) for c in phones})
    return tag(df, tenant_id=F.lit(tenant_id).cast("int"), date=F.lit(day).cast("date"))


# ---------------------------------------------------------------- C24 inbound plans
def inbound_records(pages: DataFrame, record_path: str, tenant_id: int) -> DataFrame:
    """Landed pages of shipments (``ShipmentData``), shipment items (``ItemData``) or
    plans (``inboundPlans``) → flat rows tagged with the tenant.  A plan's
    ``createdAt`` becomes ``date_created_at``, clear of the table's audit column."""
    df = rename(explode_records(pages, record_path), {"createdAt": "date_created_at"})
    return tag(normalise_names(flatten(df)), tenant_id=F.lit(tenant_id).cast("int"))


def plan_worklist(plans: DataFrame, marketplace_id: str, last_updated_at, tenant_id: int) -> DataFrame:
    """Ids of the tenant's plans of a marketplace (array containment, F12/N05)
    that changed since ``last_updated_at``."""
    return (plans.where(mf.contains_all("marketplace_ids", [marketplace_id])
                        & (F.col("last_updated_at") >= ts_lit(last_updated_at)) & (F.col("tenant_id") == tenant_id))
            .select("inbound_plan_id").distinct())


def inbound_plan_shipments(plans: DataFrame, last_updated_at=None, tenant_id: int | None = None) -> DataFrame:
    """Plans → one row per plan shipment (N02), the plan's first marketplace id
    (1-based, J14) resolved to its marketplace name; optionally only a tenant's
    plans that changed since ``last_updated_at``."""
    if last_updated_at is not None:
        plans = plans.where(F.col("last_updated_at") >= ts_lit(last_updated_at))
    if tenant_id is not None:
        plans = plans.where(F.col("tenant_id") == tenant_id)
    x = plans.select("*", F.explode("shipments").alias("__s"))
    x = x.select("*", F.col("__s.shipmentId").alias("shipment_id"), F.col("__s.status").alias("shipment_status")) \
        .drop("__s")
    x = x.withColumn("marketplace_id", mf.first_of("marketplace_ids"))
    mk = marketplaces(plans.sparkSession).select("marketplace_id", F.col("marketplace_name").alias("marketplace"))
    return x.join(mk, "marketplace_id", "left")


# ---------------------------------------------------------------- C25 fee estimates
def fee_request_batches(offers: DataFrame, size: int = 20, sku_pattern: str = SKU_PATTERN) -> DataFrame:
    """C25 request side: latest offers snapshot, priced, SKU matching the pattern,
    20 SKUs per request per (tenant, marketplace) (F06, F14, F11, W06, N09).  The
    pattern is one seller's naming rule; other tenants pass their own."""
    latest = latest_snapshot(offers, "date")
    ok = latest.where(F.col("price_amount").isNotNull() & (F.col("price_amount") != 0) & F.col("sku").rlike(sku_pattern))
    item = F.struct(F.col("sku").alias("IdValue"), F.lit("SellerSKU").alias("IdType"),
                    F.struct(F.struct(F.col("price_amount").alias("Amount"),
                                      F.col("price_currency_code").alias("CurrencyCode")).alias("ListingPrice"))
                    .alias("PriceToEstimateFees"))
    b = request_batches(ok, ["tenant_id", "marketplace"], ["sku"], item, size=size)
    return b.withColumn("request_body", F.to_json("items"))


def fee_estimates(responses: DataFrame, recorded_at) -> DataFrame:
    """C25 response side (A13, N08 null-safe nested gets): one row per estimate, fee types pivoted out of the
    fee list (last match wins), failures kept with their error code/message."""
    fees = F.col("FeesEstimate.FeeDetailList")
    def fee_is(t):  # one-argument lambda: a second argument would be the element index
        return lambda f: f["FeeType"] == t

    picks = {n: (fee_is(t), lambda f: f["FinalFee"]["Amount"]) for n, t in FEE_TYPES.items()}
    ok = F.col("Status") == "Success"
    return responses.withColumn("__fees", mf.last_matches(fees, picks)).select(
        *[c for c in ("tenant_id", "marketplace") if c in responses.columns],
        F.col("FeesEstimateIdentifier.IdValue").alias("sku"),
        F.col("FeesEstimateIdentifier.PriceToEstimateFees.ListingPrice.Amount").alias("price_to_estimate_fees_amount"),
        F.col("FeesEstimateIdentifier.PriceToEstimateFees.ListingPrice.CurrencyCode")
         .alias("price_to_estimate_fees_currency_code"),
        F.when(ok, F.col("FeesEstimate.TimeOfFeesEstimation")).alias("fees_estimated_at"),
        F.when(ok, F.col("FeesEstimate.TotalFeesEstimate.Amount")).alias("est_total_fees"),
        *[F.when(ok, F.col("__fees")[n]).alias(n) for n in picks],
        F.when(~ok, F.col("Error.Code")).alias("error_code"), F.when(~ok, F.col("Error.Message")).alias("error_message"),
        ts_lit(recorded_at).alias("recorded_at"))


# ---------------------------------------------------------------- C27 keyword ranks
def keyword_rank_batch(raw: DataFrame, zone: str = "Asia/Manila") -> tuple[DataFrame, DataFrame]:
    """Returns ``(batch, duplicates)``: every duplicated key row for the log
    (W04); the batch keeps the last row per key after sorting by date (W03),
    '-' → NULL (P16), ``>306`` style ranks bounded (X09), local dates → UTC (D03),
    and rows without an organic rank are left out (F07)."""
    dups = duplicate_rows(raw, KEYWORD_RANK_KEYS)
    df = dedupe(raw, KEYWORD_RANK_KEYS, [("Date Added", False, False)], keep="last")
    df = null_tokens(df, ["-"])
    df = df.withColumns({c: mf.bounded_int(F.col(f"`{c}`")) for c in ("Search Volume", "Organic Rank",
                                                                       "Sponsored Position") if c in df.columns})
    df = df.withColumn("Date Added", mf.to_utc(F.to_timestamp(F.col("`Date Added`")), zone))
    return df.where(F.col("`Organic Rank`").isNotNull()), dups


# ---------------------------------------------------------------- C28 search query performance
def sqp_batch(raw: DataFrame, order: Sequence[str] = ("source_file", "line_no")) -> DataFrame:
    """Week columns (D04), trimmed/lower-cased keys (X11), NULL keys dropped
    (F08), then one row per key taking each column's value from the file that was
    read first (A09); a uniqueness check (W08) is left to the caller.

    Files are put in front of those read before, so the last non-NULL value of a
    key is that of the earliest file, and of its last line.  ``order`` names the
    columns that tell the file and the line; without a line column, ties inside a
    file go to the largest value of the row's columns, so reruns agree."""
    df = raw.withColumns({
        "search_query": mf.norm_key("search_query"), "marketplace": mf.norm_key("marketplace", upper=True),
        "reporting_range": mf.norm_key("reporting_range"), "reporting_date": F.to_date("reporting_date")})
    df = df.withColumns({"end_date": F.col("reporting_date"), "start_date": mf.week_start("reporting_date"),
                         "week": mf.iso_week("reporting_date")})
    keys = [k for k in SQP_KEYS if k in df.columns]
    df = df.dropna(subset=keys)
    file_col, line_cols = order[0], [c for c in order[1:] if c in df.columns]
    ties = line_cols or [c for c in df.columns if c not in (*keys, file_col)]
    values = [c for c in df.columns if c not in keys]

    def value(c: str) -> Column:
        known = F.col(c).isNotNull()
        # per file its last known value, then the value of the first file that has one
        last = F.max_by(F.col(c), F.when(known, F.struct(*[F.col(t) for t in ties])))
        return last.alias(c)

    per_file = df.groupBy(*keys, F.col(file_col).alias("__file")).agg(*[value(c) for c in values])
    return per_file.groupBy(*keys).agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("__file"))).alias(c) for c in values])


def check_unique(df: DataFrame, keys: Sequence[str] = SQP_KEYS) -> DataFrame:
    assert_unique(df, [k for k in keys if k in df.columns])
    return df


# ---------------------------------------------------------------- C29 TSV reports
def fee_preview_batch(raw: DataFrame, tenant_id: int, day) -> DataFrame:
    """All-string TSV → '--'/'' → NULL, names normalised, one row per key (the
    first line of the first file where the reader gave ``line_no``), tagged."""
    df = normalise_names(null_tokens(raw, ["--", ""]))
    df = tag(df, tenant_id=F.lit(tenant_id).cast("int"), date=F.lit(day).cast("date"))
    return _first_line(df, KEYS["business_reports.fba_fee_preview"])


def _first_line(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the first in file order."""
    order = [c for c in ("source_file", "line_no") if c in df.columns] or [c for c in df.columns if c not in keys][:1]
    return dedupe(df, keys, order, keep="first").drop("source_file", "line_no")


# ---------------------------------------------------------------- C30 warehouse stock
def warehouse_stock(pages: DataFrame, record_path: str, warehouse: str, account: str, recorded_at) -> DataFrame:
    """Stock records → flat rows tagged with warehouse/account/recorded_at,
    sorted within partitions by SKU for the append (O05)."""
    df = flatten(explode_records(pages, record_path))
    df = tag(df, warehouse_name=warehouse, account_name=account,
             recorded_at=ts_lit(recorded_at))
    return df.sortWithinPartitions(*[c for c in ("SKU", "sku") if c in df.columns][:1] or df.columns[:1])


# ---------------------------------------------------------------- C31 keyword tool
def keyword_tool_batch(raw: DataFrame, schema: T.StructType, last_column: str, country: str, category: str,
                       key: str = "Keyword Phrase") -> DataFrame:
    """Columns up to ``last_column`` (P09), '-' → NULL (P16), conformed to the
    table schema (P10), rows without a keyword dropped (F08), tagged."""
    df = null_tokens(select_until(raw, last_column), ["-"])
    df = tag(df, country=country, category=category)
    return conform(df, schema).dropna(subset=[key])


# ---------------------------------------------------------------- C32 legacy sponsored reports
def legacy_report_batch(raw: DataFrame, header_to_column: Mapping[str, str], schema: T.StructType) -> DataFrame:
    """Report headers renamed to stored names from the column catalog
    and conformed (P10)."""
    return conform(rename(raw, header_to_column), schema)


# ---------------------------------------------------------------- C17–C19 history repair
def _money(df: DataFrame) -> DataFrame:
    """Money cleaned (X02), before a union: one source may hold text and the other numbers."""
    return df.withColumns({c: mf.clean_money(c) for c in MONEY_COLUMNS if c in df.columns})


def _in_windows(df: DataFrame, windows: Sequence[tuple[str, str]], inclusive: bool) -> DataFrame:
    """Rows in any of the date windows (F04); no window keeps everything."""
    cond = None
    for a, b in windows:
        d, lo, hi = F.col("date"), F.lit(a).cast("date"), F.lit(b).cast("date")
        one = (d >= lo) & (d <= hi) if inclusive else (d > lo) & (d < hi)
        cond = one if cond is None else cond | one
    return df if cond is None else df.where(cond)


def _with_portfolio(df: DataFrame, bulk: DataFrame) -> DataFrame:
    """The portfolio name of the export's rows by ad-group name, one per name."""
    if "portfolio_name" in df.columns or "portfolio_name" not in bulk.columns:
        return df
    return map_lookup(df, "ad_group_name", bulk, "ad_group_name", "portfolio_name")


def _with_bids(console: DataFrame | None, export: DataFrame) -> DataFrame | None:
    """Console rows have no bid; it comes from the export's row of that day, ad group and target
    (one bid each, so rows never multiply)."""
    keys = ["date", "ad_group_name", "targeting"]
    if console is None or "keyword_bid" not in export.columns:
        return console
    bids = export.where(F.col("keyword_bid").isNotNull()).groupBy(*keys).agg(F.max("keyword_bid").alias("keyword_bid"))
    return console.drop("keyword_bid").join(bids, keys, "left")


def _with_ids(df: DataFrame, bulk: DataFrame, names: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Ids of the bulk sheet by cleaned names (X05, J13); the sheet is made distinct after
    cleaning, so spellings of one campaign do not multiply rows (J12)."""
    sheet = bulk.where(F.col(ids[0]).isNotNull()).select(*names, *ids)
    return cleaned_key_join(df.drop(*ids), sheet, list(names), mf.campaign_key)


def _keywords(df: DataFrame, marketplace: str) -> DataFrame:
    """keyword, match type (X07), keyword type, upper-cased status, marketplace."""
    df = df.withColumns({"keyword": F.col("targeting"), "match_type": mf.match_type("targeting", "match_type"),
                         "ad_keyword_status": F.upper("ad_keyword_status"), "marketplace": F.lit(marketplace)})
    return df.withColumn("keyword_type", F.col("match_type"))


def search_term_history(history: Sequence[DataFrame], bulk: DataFrame, console: DataFrame | None = None,
                        windows: Sequence[tuple[str, str]] = (), marketplace: str = "US") -> DataFrame:
    """C17: third-party search-term exports + console report → sponsored_products.search_term.

    All export periods are united (the source overwrote the first, E1); only
    sponsored products; totals dropped; CTR (M01) and currency (P14) added; the
    portfolio by ad-group name; bids carried onto the console rows.  The windows
    (inclusive) cut the export only.  Targets in canonical form (X06); ids by cleaned names; the portfolio id by
    name (J11); money cleaned (X02)."""
    export = union_by_name(*history)
    if "Sponsored" in export.columns:
        export = export.where(F.col("Sponsored") == "Products")
    export = drop_where(export, lambda c: "Total" in c, SEARCH_TERM_DROP)
    export = _with_portfolio(rename(export, SEARCH_TERM_RENAME), bulk)
    more = {"campaign_budget_currency_code": mf.currency_code(F.lit(marketplace))}
    if {"clicks", "impressions"} <= set(export.columns):
        more["click_through_rate"] = mf.ratio("clicks", "impressions")
    export = export.withColumns(more)
    console = _with_bids(console, export)
    export = _in_windows(export, windows, inclusive=True)
    df = _money(export) if console is None else union_by_name(_money(console), _money(export))
    df = df.withColumn("targeting", mf.canonical_targeting("targeting"))
    df = _with_ids(df, bulk, ["campaign_name", "ad_group_name"], ["ad_group_id", "campaign_id"])
    if {"portfolio_name", "portfolio_id"} <= set(bulk.columns) and "portfolio_name" in df.columns:
        df = map_lookup(df, "portfolio_name", bulk, "portfolio_name", "portfolio_id")
    return _keywords(df, marketplace)


def targeting_history(history: Sequence[DataFrame], bulk: DataFrame, console: DataFrame | None = None,
                      impressions: DataFrame | None = None, windows: Sequence[tuple[str, str]] = (),
                      marketplace: str = "US") -> tuple[DataFrame, DataFrame]:
    """Keyword exports (their own headers) + console targeting report →
    ``(rows, unmatched)`` for sponsored_products.targeting.

    Only ``SP…`` types of the export, full-row distinct, targets in canonical form
    (X06).  Console rows get the impression share of (date, search term), then
    full-row distinct (J15), and the export's bids.  The windows (exclusive) cut
    the export only; the console report is kept whole.  Rows that find no ad group
    come back separately (the source dropped 61 rows, $201).  One row per (date,
    ad_group_id, targeting, match_type), console rows first (W03)."""
    export = union_by_name(*history)
    if "Type" in export.columns:
        export = export.where(F.col("Type").startswith("SP"))
    export = rename(drop_where(export, None, TARGETING_DROP), TARGETING_RENAME).distinct()
    export = export.withColumns({"targeting": mf.canonical_targeting("targeting"),
                                 "campaign_budget_currency_code": mf.currency_code(F.lit(marketplace))})
    export = _with_portfolio(export, bulk)
    if console is not None and impressions is not None:
        term = F.when(F.col("search_term").startswith("b0"),
                      F.concat(F.lit('asin="'), F.upper("search_term"), F.lit('"'))).otherwise(F.col("search_term"))
        share = impressions.withColumn("targeting", term).drop("search_term")
        console = console.join(share, ["date", "targeting"], "left").distinct()
    console = _with_bids(console, export)
    rank = F.lit(1).alias("__source")
    df = _money(_in_windows(export, windows, inclusive=False)).select("*", rank)
    if console is not None:
        df = union_by_name(_money(console).select("*", F.lit(0).alias("__source")), df)
    df = _with_ids(df, bulk, ["campaign_name", "ad_group_name"], ["ad_group_id", "campaign_id"])
    if {"portfolio_name", "portfolio_id"} <= set(bulk.columns) and "portfolio_name" in df.columns:
        df = map_lookup(df, "portfolio_name", bulk, "portfolio_name", "portfolio_id")
    df = _keywords(df, marketplace)
    unmatched = df.where(F.col("ad_group_id").isNull()).drop("__source")
    df = dedupe(df.where(F.col("ad_group_id").isNotNull()), KEYS["sponsored_products.targeting"], ["__source"],
                keep="first")
    return df.drop("__source"), unmatched


def placement_history(history: Sequence[DataFrame], bulk: DataFrame, console: DataFrame | None = None,
                      windows: Sequence[tuple[str, str]] = (), marketplace: str = "US") -> DataFrame:
    """Placement exports + console report → sponsored_products.campaign_placement.

    Export rows without a placement are dropped (F07), the windows (exclusive) cut
    the export only; labels mapped (X08), CTR recomputed (M01), money with
    parentheses cleaned (X02), campaign ids by cleaned name (J13), rows without one
    dropped, one row per (date, campaign_id, placement), export rows first (W03)."""
    export = union_by_name(*history)
    export = export.where(F.col("Placement").isNotNull())
    export = rename(drop_where(export, None, PLACEMENT_DROP), PLACEMENT_RENAME)
    df = _money(_in_windows(export, windows, inclusive=False)).withColumn("__source", F.lit(0))
    if console is not None:
        df = union_by_name(df, _money(console).withColumn("__source", F.lit(1)))
    df = df.withColumns({"campaign_status": F.upper("campaign_status"),
                         "placement_classification": mf.placement_label("placement_classification"),
                         "click_through_rate": mf.ratio("clicks", "impressions"),
                         "campaign_budget_currency_code": mf.currency_code(F.lit(marketplace)),
                         "marketplace": F.lit(marketplace)})
    df = _with_ids(df, bulk, ["campaign_name"], ["campaign_id"])
    keys = KEYS["sponsored_products.campaign_placement"]
    return dedupe(df.where(F.col("campaign_id").isNotNull()), keys, ["__source"], keep="first").drop("__source")


def scale_insights_grid(rows: DataFrame, doc: str, pos: str, is_campaign: Column, carry: Sequence[str]) -> DataFrame:
    """W07 + X03 + M04 on an exported ads grid: campaign rows' totals repeated on
    their keyword rows, numbers cleaned (percent columns as ratios), and a
    row's impressions allocated from the campaign's by its share of the spend."""
    out = carry_down(rows, [doc], [pos], is_campaign, carry, prefix="")
    numbers = [c for c in out.columns if c not in (*GRID_TEXT, doc, pos)]
    out = out.withColumns({c: mf.clean_number(F.col(f"`{c}`"), percent=c in GRID_PERCENT) for c in numbers})
    return out.withColumn("Impressions", mf.allocate("Cost", F.col("`Total Spend`"), F.col("`Total Impressions`")))


# ---------------------------------------------------------------- C26 FX rates
def fx_rates_batch(payloads: DataFrame) -> DataFrame:
    """``{date: {pair: rate}}`` payloads → rate rows (S12), one row per
    (recorded_at, base, target) keeping the last loaded value (K07/W01): that of the
    largest ``loaded_at`` where the payloads carry one; equal loads keep the
    highest rate, so reruns agree."""
    from marketlake.sources.files import explode_rates
    rates = explode_rates(payloads)
    order = ["loaded_at desc nulls last"] if "loaded_at" in rates.columns else []
    return dedupe(rates, KEYS["exchangerate_host.rates"], [*order, "rate desc"], keep="first").drop(
        "loaded_at").sortWithinPartitions("recorded_at")


# ---------------------------------------------------------------- C29 planning / business reports
def planning_inventory_batch(raw: DataFrame, tenant_id: int, schema: T.StructType) -> DataFrame:
    """Typed TSV planning report: trimmed strings, '--'/'' → NULL, conformed,
    one row per (marketplace, snapshot_date, sku, condition)."""
    df = normalise_names(raw)
    df = df.withColumns({f.name: F.trim(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType)})
    df = tag(null_tokens(df, ["--", ""]), tenant_id=F.lit(tenant_id).cast("int"))
    keys = KEYS["inventory.fba_planning_inventory"]
    placed = T.StructType([*schema.fields, *[f for f in df.schema.fields if f.name in ("source_file", "line_no")]])
    return _first_line(conform(df, placed).dropna(subset=keys), keys)


def business_report_batch(records: DataFrame, tenant_id: int, marketplace: str, day) -> DataFrame:
    """``salesAndTrafficByAsin`` records (already exploded and flattened by
    ``read_wrapped_json``) → stored names, tagged with tenant/marketplace/date."""
    df = normalise_names(records.drop("source_file"))
    return tag(df, tenant_id=F.lit(tenant_id).cast("int"), marketplace=marketplace, date=F.lit(day).cast("date"))


# ---------------------------------------------------------------- C28 SP-API form
def active_asins(summaries: DataFrame, tenant_id: int, marketplace: str, start, end) -> DataFrame:
    """C28 work list: distinct ASINs listed as DISCOVERABLE and BUYABLE between
    ``start − 6 days`` and ``end`` (F12, F04, F14, A08)."""
    s = F.date_sub(F.lit(start).cast("date"), 6)
    e = F.lit(end).cast("date")
    return (summaries.where((F.col("marketplace") == marketplace) & (F.col("tenant_id") == tenant_id)
                            & (F.col("date") >= s) & (F.col("date") <= e)
                            & mf.contains_all("status", ["DISCOVERABLE", "BUYABLE"])
                            & F.col("asin").isNotNull() & (F.col("asin") != ""))
            .select("asin").distinct())


def sqp_api_batch(records: DataFrame, tenant_id: int, marketplace: str) -> DataFrame:
    """C28 SP-API form: ``dataByAsin`` records (``read_wrapped_json``) flattened,
    the first ``_`` segment of each nested name dropped (P08), tagged."""
    df = strip_prefix(flatten(records.drop("source_file") if "source_file" in records.columns else records),
                      first_segment=True)
    df = normalise_names(df)
    return tag(df, tenant_id=F.lit(tenant_id).cast("int"), marketplace=marketplace)
