"""Reporting marts (C01–C16) over the stored tables, as DataFrame functions.

``t`` maps stored table names (``"sponsored_products.campaign"`` …) to DataFrames.
Every mart takes ``tenant_id``; ``None`` serves all tenants in one job (export
with ``export_mart`` partitioned by tenant).  Dimension look-ups are scoped by
tenant (the source's were not, E22).  Sorting is presentation only and off by
default: a global sort of a 100 TB mart is a range shuffle nobody needs when
the export is partitioned per tenant.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions._util import ts_lit

from marketlake.functions import contains_all, local_date, money, price_fallback, product_code, ratio, within_age
from marketlake.functions.nested import json_nonempty
from marketlake.operators.dedupe import latest_per_key, latest_snapshot, latest_values
from marketlake.operators.joins import broadcast_if_small, left_join_known, with_children
from marketlake.operators.setops import pad_to, union_distinct

Tables = Mapping[str, DataFrame]

# --- fixed values that must equal the reference's -----------------------------
SP_CONSOLE_BEFORE = "2023-04-02"     # console history strictly before this day
SB_SD_CONSOLE_UNTIL = "2023-06-10"   # console history up to and including this day
ORDERS_FROM = "2024-01-01"
BUSINESS_PERCENT_COLUMNS = [
    "traffic_by_asin_mobile_app_session_percentage_b2b", "traffic_by_asin_mobile_app_session_percentage",
    "traffic_by_asin_browser_session_percentage", "traffic_by_asin_browser_session_percentage_b2b",
    "traffic_by_asin_session_percentage", "traffic_by_asin_session_percentage_b2b",
    "traffic_by_asin_mobile_app_page_views_percentage", "traffic_by_asin_mobile_app_page_views_percentage_b2b",
    "traffic_by_asin_browser_page_views_percentage", "traffic_by_asin_browser_page_views_percentage_b2b",
    "traffic_by_asin_page_views_percentage", "traffic_by_asin_page_views_percentage_b2b",
    "traffic_by_asin_buy_box_percentage", "traffic_by_asin_buy_box_percentage_b2b",
    "traffic_by_asin_unit_session_percentage", "traffic_by_asin_unit_session_percentage_b2b",
]
BUSINESS_COLUMNS = [
    "date", "parent_asin", "marketplace", "traffic_by_asin_mobile_app_sessions", "traffic_by_asin_mobile_app_sessions_b2b",
    "traffic_by_asin_browser_sessions", "traffic_by_asin_browser_sessions_b2b", "traffic_by_asin_sessions",
    "traffic_by_asin_sessions_b2b", *BUSINESS_PERCENT_COLUMNS[:6], "traffic_by_asin_mobile_app_page_views",
    "traffic_by_asin_mobile_app_page_views_b2b", "traffic_by_asin_browser_page_views",
    "traffic_by_asin_browser_page_views_b2b", "traffic_by_asin_page_views", "traffic_by_asin_page_views_b2b",
    *BUSINESS_PERCENT_COLUMNS[6:14], "sales_by_asin_units_ordered", "sales_by_asin_units_ordered_b2b",
    *BUSINESS_PERCENT_COLUMNS[14:], "sales_by_asin_ordered_product_sales_amount",
    "sales_by_asin_ordered_product_sales_b2b_amount", "sales_by_asin_total_order_items",
    "sales_by_asin_total_order_items_b2b",
]
FBA_COLUMNS = ["asin", "fn_sku", "seller_sku", "marketplace", "date", "last_updated_time", "total_quantity",
               "fulfillable_quantity", "inbound_working_quantity", "inbound_shipped_quantity",
               "inbound_receiving_quantity", "reserved_quantity_total_reserved_quantity",
               "unfulfillable_quantity_total_unfulfillable_quantity",
               "reserved_quantity_pending_transshipment_quantity", "reserved_quantity_fc_processing_quantity"]
SP_COLS = ["date", "marketplace", "portfolio_name", "product_code", "currency", "total_cost",
           "total_units_sold_clicks_7d", "total_clicks", "total_impressions", "sales_7d"]
SB_COLS = ["date", "marketplace", "portfolio_name", "product_code", "currency", "total_cost",
           "attributed_units_ordered_new_to_brand_14d", "total_clicks", "total_impressions", "attributed_sales_14d"]
SD_COLS = ["date", "marketplace", "portfolio_name", "product_code", "currency", "total_cost",
           "attributed_units_ordered_7d", "total_clicks", "total_impressions"]
SHIPMENT_COLS = ["tenant_id", "origin country", "destination country", "shipment name", "shipment id", "created",
                 "last updated", "fulfillment center", "skus", "quantity shipped", "quantity received",
                 "shipment status", "ship from", "reference id", "inbound plan id"]
FEE_COLS = ["date", "sku", "fnsku", "asin", "amazon_store", "product_name", "product_group", "brand", "fulfilled_by",
            "your_price", "sales_price", "longest_side", "median_side", "shortest_side", "length_and_girth",
            "unit_of_dimension", "item_package_weight", "unit_of_weight", "product_size_tier", "currency",
            "estimated_fee_total", "estimated_referral_fee_per_unit", "estimated_variable_closing_fee",
            "estimated_order_handling_fee_per_order", "estimated_pick_pack_fee_per_unit",
            "estimated_weight_handling_fee_per_unit", "expected_fulfillment_fee_per_unit", "referral_fee_%"]
CEREBRO_COLUMNS = {"Search Volume": "cerebro_search_volume", "Position (Rank)": "position_rank",
                   "Relative Rank": "relative_rank", "Competitor Rank (avg)": "competitor_rank_avg",
                   "Ranking Competitors (count)": "ranking_competitors_count",
                   "Competitor Performance Score": "competitor_performance_score", "H10 PPC Sugg. Bid": "h10_sugg_bid",
                   "H10 PPC Sugg. Min Bid": "h10_min_bid", "H10 PPC Sugg. Max Bid": "h10_max_bid"}
# -----------------------------------------------------------------------------


def _tenant(df: DataFrame, tenant_id) -> DataFrame:
    return df if tenant_id is None else df.where(F.col("tenant_id") == F.lit(tenant_id))


def _money_sum(col: str) -> Column:
    """Sum of an amount as decimal(18,4): exact, whatever the order of the tasks."""
    return F.sum(money(F.col(f"`{col}`"), 4)).cast("double")


def _sorted(df: DataFrame, ordered: bool, *cols: Column) -> DataFrame:
    return df.orderBy(*cols) if ordered else df


# ---------------------------------------------------------------- inventory
def fba_planning_inventory(t: Tables, tenant_id=None, ordered=False) -> DataFrame:
    """C01 ``FBA-Inv+``: F01 tenant equality filter, O01 sort (PostgreSQL NULL order)."""
    df = _tenant(t["inventory.fba_planning_inventory"], tenant_id)
    return _sorted(df, ordered, F.col("snapshot_date").desc_nulls_first(), "marketplace", "sku")


def fba_inventory(t: Tables, tenant_id=None, max_age_days: int = 30, ordered=False) -> DataFrame:
    """C02 ``FBA-Inv``: rows whose snapshot is less than 30 days newer than the
    inventory's last update (F05)."""
    df = _tenant(t["inventory.fba"], tenant_id)
    df = df.where(within_age("date", "last_updated_time", max_age_days))
    return _sorted(df.select(*FBA_COLUMNS), ordered, F.col("date").desc_nulls_first(), "marketplace", "asin")


def business_report_parent(t: Tables, tenant_id=None, ordered=False) -> DataFrame:
    """C03 ``Bus-RP``: the report's columns, traffic percentages as ratios."""
    df = _tenant(t["business_reports.detail_page_sales_and_traffic_parent"], tenant_id)
    df = df.select("tenant_id", *[(F.col(c) / F.lit(100.0)).alias(c) if c in BUSINESS_PERCENT_COLUMNS else F.col(c)
                                  for c in BUSINESS_COLUMNS])
    return _sorted(df, ordered, "date", "marketplace", "parent_asin")


def awd_inventory(t: Tables, tenant_id=None, ordered=False) -> DataFrame:
    """C13 ``AWD-Inv``."""
    return _sorted(_tenant(t["awd.inventory"], tenant_id), ordered, F.col("date").desc_nulls_first(), "sku")


def awd_inbound_detail(t: Tables, tenant_id=None, ordered=False) -> DataFrame:
    """One row per shipment × SKU of the latest AWD snapshot (the source reads
    a view whose text it does not include; this is our reading of it)."""
    s = latest_snapshot(_tenant(t["awd.inbound_shipments"], tenant_id), "date", by=["tenant_id"])
    x = s.select("tenant_id", "date", "order_id", "shipment_id", "shipment_status",
                 F.explode("shipment_sku_quantities").alias("q"))
    out = x.select("tenant_id", "date", "order_id", "shipment_id", "shipment_status", F.col("q.sku").alias("sku"),
                   F.col("q.expectedQuantity.quantity").alias("expected_quantity"))
    return _sorted(out, ordered, F.col("date").desc_nulls_first(), "shipment_id", "sku")


# ---------------------------------------------------------------- advertising spend


def _portfolios(t: Tables) -> DataFrame:
    return t["amazon_advertising_portfolios"].select("tenant_id", "portfolio_id", F.col("name").alias("portfolio_name"))


def sp_spend(t: Tables, marketplace: str, tenant_id=None, with_console: bool | None = None,
             ordered=False) -> DataFrame:
    """C04/C05 ``SP-<marketplace>``: campaign facts ⟕ latest targeting row per
    campaign (its portfolio) ⟕ portfolios, summed per day/portfolio/currency with
    HAVING impressions > 0 (US); US adds the console history before 2023-04-02."""
    with_console = (marketplace == "US") if with_console is None else with_console
    camp = _tenant(t["sponsored_products.campaign"], tenant_id).where(F.col("marketplace") == marketplace)
    targ = _tenant(t["sponsored_products.targeting"], tenant_id).select("tenant_id", "campaign_id", "portfolio_id",
                                                                         "date")
    latest = latest_values(targ, ["tenant_id", "campaign_id"], ["date desc"], ["portfolio_id"], ties=["portfolio_id"])
    j = (camp.join(latest, ["tenant_id", "campaign_id"], "left")
             .join(broadcast_if_small(_portfolios(t)), ["tenant_id", "portfolio_id"], "left"))
    api = (j.groupBy("tenant_id", "marketplace", "portfolio_name", "date",
                     F.col("campaign_budget_currency_code").alias("currency"))
            .agg(_money_sum("cost").alias("total_cost"), F.sum("units_sold_clicks_7d").alias("total_units_sold_clicks_7d"),
                 F.sum("clicks").alias("total_clicks"), F.sum("impressions").alias("total_impressions"),
                 _money_sum("sales_7d").alias("sales_7d")))
    if marketplace == "US":
        api = api.where(F.col("total_impressions") > 0)
    api = api.withColumn("product_code", product_code("portfolio_name"))
    cols = ["tenant_id", *SP_COLS]
    out = api.select(*cols)
    if with_console:
        con = _tenant(t["sponsored_products.campaign_console"], tenant_id).where(
            (F.col("marketplace") == marketplace) & (F.col("date") < F.lit(SP_CONSOLE_BEFORE).cast("date")))
        con = (con.groupBy("tenant_id", "marketplace", "portfolio_name", "date", "currency")
               .agg(_money_sum("spend").alias("total_cost"), F.sum("7_day_total_orders").alias("total_units_sold_clicks_7d"),
                    F.sum("clicks").alias("total_clicks"), F.sum("impressions").alias("total_impressions"),
                    _money_sum("7_day_total_sales").alias("sales_7d"))
               .withColumn("product_code", product_code("portfolio_name")))
        out = union_distinct(out, con.select(*cols))
    return _sorted(out, ordered, "date", F.col("marketplace").desc(), "portfolio_name")


def _campaign_spend(t: Tables, schema: str, tenant_id, statuses, all_code, metrics: dict[str, Column]):
    camp = _tenant(t[f"{schema}.campaign_v2"], tenant_id)
    if statuses:
        camp = camp.where(F.col("campaign_status").isin(list(statuses)))
    dim = t[f"{schema}.campaigns"].select("tenant_id", "campaign_id", "portfolio_id")
    j = (camp.join(dim, ["tenant_id", "campaign_id"], "left")
             .join(broadcast_if_small(_portfolios(t)), ["tenant_id", "portfolio_id"], "left"))
    out = j.groupBy("tenant_id", "date", "portfolio_name", "marketplace", "currency").agg(
        *[c.alias(n) for n, c in metrics.items()])
    return out.withColumn("product_code", product_code("portfolio_name", all_code=all_code))


def sb_spend(t: Tables, marketplace: str, tenant_id=None, with_console: bool | None = None,
             ordered=False) -> DataFrame:
    """C06/C07 ``SB-<marketplace>``: enabled/paused campaigns ⟕ campaigns ⟕
    portfolios; US adds console history up to 2023-06-10; 'ALL' keeps its code."""
    with_console = (marketplace == "US") if with_console is None else with_console
    api = _campaign_spend(t, "sponsored_brands", tenant_id, ["enabled", "paused"], "ALL", {
        "total_cost": _money_sum("cost"),
        "attributed_units_ordered_new_to_brand_14d": F.sum("attributed_units_ordered_new_to_brand_14d"),
        "total_clicks": F.sum("clicks"), "total_impressions": F.sum("impressions"),
        "attributed_sales_14d": _money_sum("attributed_sales_14d")}).where(F.col("marketplace") == marketplace)
    cols = ["tenant_id", *SB_COLS]
    out = api.select(*cols)
    if with_console:
        con = _tenant(t["sponsored_brands.campaign_console"], tenant_id).where(
            (F.col("marketplace") == marketplace) & (F.col("date") <= F.lit(SB_SD_CONSOLE_UNTIL).cast("date")))
        con = (con.groupBy("tenant_id", "date", "portfolio_name", "marketplace", "currency")
               .agg(_money_sum("spend").alias("total_cost"),
                    F.sum("14_day_total_units").alias("attributed_units_ordered_new_to_brand_14d"),
                    F.sum("clicks").alias("total_clicks"), F.sum("impressions").alias("total_impressions"),
                    _money_sum("14_day_total_sales").alias("attributed_sales_14d"))
               .withColumn("product_code", product_code("portfolio_name", all_code="ALL")))
        out = union_distinct(out, con.select(*cols))
    return _sorted(out, ordered, "date", "marketplace", "portfolio_name")


def sd_spend(t: Tables, tenant_id=None, ordered=False) -> DataFrame:
    """C08 ``SD``: all marketplaces, API ∪ console history up to 2023-06-10."""
    api = _campaign_spend(t, "sponsored_display", tenant_id, None, None, {
        "total_cost": _money_sum("cost"), "attributed_units_ordered_7d": F.sum("attributed_units_ordered_7d"),
        "total_clicks": F.sum("clicks"), "total_impressions": F.sum("impressions")})
    cols = ["tenant_id", *SD_COLS]
    con = _tenant(t["sponsored_display.campaign_console"], tenant_id).where(
        F.col("date") <= F.lit(SB_SD_CONSOLE_UNTIL).cast("date"))
    con = (con.groupBy("tenant_id", "date", "portfolio_name", "marketplace", "currency")
           .agg(_money_sum("spend").alias("total_cost"), F.sum("14_day_total_units").alias("attributed_units_ordered_7d"),
                F.sum("clicks").alias("total_clicks"), F.sum("impressions").alias("total_impressions"))
           .withColumn("product_code", product_code("portfolio_name")))
    out = union_distinct(api.select(*cols), con.select(*cols))
    return _sorted(out, ordered, "date", "portfolio_name", "marketplace")


# ---------------------------------------------------------------- orders
def orders_mart(t: Tables, marketplace: str, tenant_id=None, since: str = ORDERS_FROM, ordered=False) -> DataFrame:
    """C09 ``Orders-<marketplace>``: orders ⟕ items ⟕ latest Business competitive
    price per (tenant, asin, marketplace); a missing item price falls back to the
    listing price × quantity unless the order is a replacement; GMT and fixed
    PDT (−07:00) dates."""
    o = _tenant(t["orders.amazon_orders"], tenant_id).where(
        (F.col("marketplace") == marketplace) & (F.col("purchase_date") >= ts_lit(since)))
    items = t["orders.amazon_order_items"].drop("marketplace")
    cp = t["product_pricing.competitive_pricing"]
    cp = cp.where((F.col("customer_type") == "Business") &
                  (F.size("product_competitive_pricing_competitive_prices") > 0))
    latest = latest_per_key(cp.select("tenant_id", "asin", "marketplace", "date",
                                      "product_competitive_pricing_competitive_prices"),
                            ["tenant_id", "asin", "marketplace"], ["date desc"], ties=[])
    listing = F.get(F.col("product_competitive_pricing_competitive_prices"), 0)["Price"]["ListingPrice"]
    latest = latest.select("tenant_id", "asin", "marketplace",
                           listing["CurrencyCode"].alias("__cur"), listing["Amount"].cast("double").alias("__amt"))
    items = items.withColumnsRenamed({"tenant_id": "__t", "amazon_order_id": "__o"})
    # orders ⟕ items in the skew-splittable form; the price dimension has one row per key
    j = (with_children(o, items, ["tenant_id", "amazon_order_id"], ["__t", "__o"]).drop("__t", "__o")
          .join(latest, ["tenant_id", "asin", "marketplace"], "left"))
    not_repl = F.col("is_replacement_order") == F.lit(False)
    cur_missing = F.col("item_price_currency_code").isNull() | (F.col("item_price_currency_code") == "nan")
    out = j.select(
        F.to_date(F.col("purchase_date").cast("timestamp_ntz")).alias("GMT-date"),
        local_date("purchase_date", "-07:00").alias("PDT-date"),
        "tenant_id", "amazon_order_id", "purchase_date", "order_status", "sales_channel", "seller_sku", "asin",
        "quantity_ordered",
        F.when(cur_missing & not_repl, F.col("__cur")).otherwise(F.col("item_price_currency_code")).alias("currency"),
        price_fallback("item_price_amount", "__amt", "quantity_ordered", not_repl).alias("item_price_amount"),
        "item_tax_amount", "shipping_address_country_code", "is_replacement_order",
        F.when(~F.col("order_status").isin("Pending", "Canceled") & F.col("item_price_amount").isNull() & not_repl,
               F.lit("Y")).otherwise(F.col("replaced_order_id")).alias("Vine / replaced_order_id"))
    return _sorted(out, ordered, "purchase_date")


def orders_summary(t: Tables, tenant_id=None, ordered=False) -> DataFrame:
    """C10 ``Orders Summary``: units per order day × marketplace × product."""
    o = _tenant(t["orders.amazon_orders"], tenant_id)
    items = t["orders.amazon_order_items"].select(F.col("tenant_id").alias("__t"),
                                                  F.col("amazon_order_id").alias("__o"),
                                                  "asin", "seller_sku", "quantity_ordered")
    # orders ⟕ items as items ⋈ orders ∪ orders ▷ items: a hot order stays splittable
    j = with_children(o, items, ["tenant_id", "amazon_order_id"], ["__t", "__o"])
    out = (j.groupBy("tenant_id", F.to_date(F.col("purchase_date").cast("timestamp_ntz")).alias("purchase_date"),
                     "marketplace", "asin", "seller_sku")
            .agg(F.sum("quantity_ordered").alias("quantity_ordered")))
    return _sorted(out, ordered, F.col("purchase_date").desc(), F.col("marketplace").desc(),
                   F.col("quantity_ordered").desc())


# ---------------------------------------------------------------- shipments


def shipments(t: Tables, tenant_id=None, ordered=False) -> DataFrame:
    """C11 ``Shipments`` (ordered O02 ``created DESC NULLS LAST``): FBA shipments ⟕ items pre-aggregated per shipment
    ⟕ plan shipments ⟕ plans exploded to shipment ids (J05), UNION the latest AWD
    snapshot with its SKU list exploded and summed (J08, F06), NULL-padded (U02)."""
    s = _tenant(t["fulfillment_inbound.shipments"], tenant_id)
    items = t["fulfillment_inbound.shipment_items"].groupBy("tenant_id", "shipment_id").agg(
        F.sum("quantity_shipped").alias("quantity shipped"), F.sum("quantity_received").alias("quantity received"),
        F.count("seller_sku").alias("skus"))
    ps = t["fulfillment_inbound.inbound_plans_shipments"].select(
        "tenant_id", F.col("shipment_confirmation_id").alias("shipment_id"),
        F.col("destination_address_country_code").alias("destination country"),
        F.col("amazon_reference_id").alias("reference id"), F.col("shipment_id").alias("__plan_shipment"))
    plans = t["fulfillment_inbound.inbound_plans_info"].select(
        "tenant_id", "inbound_plan_id", "date_created_at", "last_updated_at", F.explode("shipments").alias("s"))
    plans = plans.select("tenant_id", F.col("s.shipmentId").alias("__plan_shipment"),
                         F.col("inbound_plan_id").alias("inbound plan id"), F.col("date_created_at").alias("created"),
                         F.col("last_updated_at").alias("last updated"))
    fba = s.join(items, ["tenant_id", "shipment_id"], "left").join(ps, ["tenant_id", "shipment_id"], "left")
    # shipments without a plan have no key here
    fba = left_join_known(fba, plans, ["tenant_id", "__plan_shipment"], ["shipment_id"])
    fba = fba.select("tenant_id", F.col("ship_from_address_country_code").alias("origin country"),
                     "destination country", F.col("shipment_name").alias("shipment name"),
                     F.col("shipment_id").alias("shipment id"), "created", "last updated",
                     F.col("destination_fulfillment_center_id").alias("fulfillment center"), "skus",
                     "quantity shipped", "quantity received", F.col("shipment_status").alias("shipment status"),
                     F.col("ship_from_address_name").alias("ship from"), "reference id", "inbound plan id")
    awd_all = _tenant(t["awd.inbound_shipments"], tenant_id)
    awd = latest_snapshot(awd_all, "date", by=["tenant_id"])
    per_order = awd.select("tenant_id", "order_id", F.explode("shipment_sku_quantities").alias("e")).groupBy(
        "tenant_id", "order_id").agg(F.count(F.col("e.sku")).alias("skus"),
                                     F.sum(F.col("e.expectedQuantity.quantity")).alias("quantity shipped"))
    awd = awd.join(per_order, ["tenant_id", "order_id"], "left").select(
        "tenant_id", F.col("origin_address_country_code").alias("origin country"),
        F.col("destination_address_country_code").alias("destination country"),
        F.col("shipment_id").alias("shipment id"), F.col("shipment_create_date_utc").alias("created"),
        F.col("shipment_last_update_date_utc").alias("last updated"),
        F.col("destination_address_name").alias("fulfillment center"), "skus", "quantity shipped",
        F.try_element_at("received_quantity", F.lit(1))["quantity"].alias("quantity received"),
        F.col("shipment_status").alias("shipment status"), F.col("origin_address_name").alias("ship from"),
        F.col("warehouse_reference_id").alias("reference id"))
    out = union_distinct(fba.select(*SHIPMENT_COLS), pad_to(awd, fba.select(*SHIPMENT_COLS).schema))
    return _sorted(out, ordered, F.col("created").desc_nulls_last(), "shipment id",
                   F.col("destination country").desc_nulls_last())


# ---------------------------------------------------------------- fees


def fee_preview(t: Tables, tenant_id=None, ordered=False) -> DataFrame:
    """C14 ``FBA Fee Preview``: fee rows with the referral-fee ratio (M05) UNION
    zero-stock (F16 ``available = 0``) planning rows padded with NULLs.  Both fee columns are emitted
    (the source's missing comma dropped one, E9)."""
    fee = _tenant(t["business_reports.fba_fee_preview"], tenant_id).withColumn(
        "referral_fee_%", ratio("estimated_referral_fee_per_unit", "your_price"))
    fee = fee.select("tenant_id", *FEE_COLS)
    zero = _tenant(t["inventory.fba_planning_inventory"], tenant_id).where(F.col("available") == 0).select(
        "tenant_id", F.col("snapshot_date").alias("date"), "sku", "fnsku", "asin",
        F.col("marketplace").alias("amazon_store"), "product_name", "product_group", "your_price", "sales_price")
    out = union_distinct(fee, pad_to(zero, fee.schema))
    return _sorted(out, ordered, F.col("date").desc_nulls_first(), F.col("amazon_store").desc_nulls_first(), "sku")


# ---------------------------------------------------------------- keywords / search queries
def keyword_opportunity(t: Tables, country: str, min_score: float = 3.0, legacy_int_share: bool = False,
                        ordered=False) -> DataFrame:
    """Latest-week search-query funnel per (category, query) ⟗ latest keyword
    tool rows per (category, keyword), with impression share, CTR and CVR."""
    sqp = t["search_query_performance"]
    sqp = latest_snapshot(sqp, "Reporting Date").where(F.col("country") == country)
    prod = t["product_amazon"].select("asin", "category")
    a = (sqp.join(broadcast_if_small(prod), "asin", "left")
         .groupBy("category", F.col("Search Query").alias("keyword_phrase"))
         .agg(F.max("Search Query Volume").alias("search_query_volume"),
              F.max("Search Funnel - Purchases: Total Count").alias("total_purchases"),
              F.sum("Search Funnel - Impressions: ASIN Count").alias("impressions"),
              F.sum("Search Funnel - Clicks: ASIN Count").alias("clicks"),
              F.sum("Search Funnel - Purchases: ASIN Count").alias("purchases")))
    cer = t["cerebro_amazon"].withColumn("__d", F.to_date("created"))
    cer = latest_snapshot(cer, "__d").where((F.col("country") == country) &
                                            (F.col("Competitor Performance Score") > min_score))
    b = cer.select(F.col("category").alias("category2"), F.col("Keyword Phrase").alias("__phrase"),
                   *[F.col(f"`{c}`").alias(n) for c, n in CEREBRO_COLUMNS.items()])
    # the funnel's category stays as it is (the bulk sheet is merged on it), the tool's is category2
    j = a.join(b, (F.col("category") == F.col("category2")) & (F.col("keyword_phrase") == F.col("__phrase")), "full")
    j = j.withColumn("keyword_phrase", F.coalesce("keyword_phrase", "__phrase")).drop("__phrase")
    share = (F.try_divide(F.col("impressions").cast("bigint"), F.col("search_query_volume").cast("bigint")).cast("bigint")
             if legacy_int_share else ratio("impressions", "search_query_volume"))
    j = j.withColumns({"impression_share": share, "click_through_rate": ratio("clicks", "impressions"),
                       "conversion_rate": ratio("purchases", "clicks", 0.0)})
    out = j.select("category", "category2", "keyword_phrase", "search_query_volume", "cerebro_search_volume",
                   "total_purchases", "impressions", "impression_share", "clicks", "click_through_rate", "purchases",
                   "conversion_rate", *list(CEREBRO_COLUMNS.values())[1:])
    return _sorted(out, ordered, F.col("category").asc_nulls_last(),
                   F.col("competitor_performance_score").desc_nulls_first(),
                   F.col("search_query_volume").desc_nulls_first())


def search_query_totals(t: Tables, country: str | None = None, ordered=False) -> DataFrame:
    """Volume and purchases per week and search query, ordered by the average
    score, which is not part of the result (A06)."""
    df = t["search_query_performance_brand_view"]
    if country:
        df = df.where(F.col("country") == country)
    out = df.groupBy("reporting_date", "search_query").agg(
        F.sum("search_query_volume").alias("search_query_volume"),
        F.sum("purchases_total_count").alias("purchases_total_count"),
        F.sum("purchases_brand_count").alias("purchases_brand_count"), F.avg("search_query_score").alias("__score"))
    return _sorted(out, ordered, F.col("__score").asc_nulls_last(), "reporting_date", "search_query").drop("__score")


def search_query_trend(t: Tables, weeks, queries=None, country: str | None = None) -> DataFrame:
    """Weekly volume per search query as a crosstab (A10): one column per week of
    ``weeks`` (the caller names them, so no job runs to find them), over the chosen
    queries or all."""
    df = t["search_query_performance_brand_view"]
    if queries:
        df = df.where(F.col("search_query").isin(list(queries)))
    if country:
        df = df.where(F.col("country") == country)
    days = [str(w) for w in weeks]
    return (df.withColumn("__week", F.col("reporting_date").cast("string")).where(F.col("__week").isin(days))
            .groupBy("search_query").pivot("__week", days).agg(F.max("search_query_volume")))


def active_listings(t: Tables) -> DataFrame:
    """F12 as used by several loaders: listings both DISCOVERABLE and BUYABLE."""
    return t["listings_items.summaries"].where(contains_all("status", ["DISCOVERABLE", "BUYABLE"]))


def non_empty_prices(t: Tables) -> DataFrame:
    """F13 on a JSON-text price column."""
    return t["product_pricing.competitive_pricing"].where(json_nonempty("prices_json"))


# --- fixed values that must equal the reference's: bulk-sheet columns kept ------
BULK_COLUMNS = ["Portfolio Name (Informational only)", "Keyword Text", "Match Type", "Bid", "CPC", "Impressions",
                "Clicks", "Orders", "Spend", "Sales", "Conversion Rate", "Acos"]


def keyword_opportunity_with_bulk(opportunity: DataFrame, bulk: DataFrame) -> DataFrame:
    """C15 second step: keyword rows of a bulk-operations sheet (F15
    ``Entity = 'Keyword'``) outer-merged on (category, keyword) =
    (portfolio name, keyword text), NULL keys matching like pandas (J07)."""
    from marketlake.operators.joins import outer_merge
    kw = bulk.where(F.col("Entity") == "Keyword").select(*[F.col(f"`{c}`") for c in BULK_COLUMNS if c in bulk.columns])
    return outer_merge(opportunity, kw, ["category", "keyword_phrase"],
                       ["Portfolio Name (Informational only)", "Keyword Text"])
