"""The ingest flows themselves (C18, C20–C32) over raw-report shapes of the driver tables.

Raw rows are whole driver tables renamed and nested as the landed reports are; the query calls
the function of ``ingest.py`` (or the mart that reads its output) that users call.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.plans import ingest, marts
from marketlake.plans.q_stored import _bulk
from marketlake.plans.registry import register
from marketlake.plans.tables import Tables
from marketlake.session import scratch_path
from marketlake.sinks.tables import load

AT = dt.datetime(2024, 1, 3)


def _text(c):
    return F.col(c).cast("string")


@register("targeting_history", """
with e as (select distinct cast(l_shipdate as date) as date, l_suppkey % 60 as k, l_linenumber % 3 as n, l_returnflag from lineitem),
x as (select date, k, n, 'close-match' as targeting from e where n = 0 and l_returnflag <> 'N'
          and date > date '1996-12-12' and date < date '1996-12-26'
      union all select date, k, n, 'asin="B0X' || k || '"' from e where n = 1 and l_returnflag <> 'N'
          and date > date '1996-12-12' and date < date '1996-12-26'
      union all select date, k, n, 'asin="B0C"' from e where n = 2)
select distinct date, k + 2000 as ad_group_id, targeting,
       case when targeting = 'close-match' then 'TARGETING_EXPRESSION_PREDEFINED' else 'TARGETING_EXPRESSION' end as match_type,
       case when targeting = 'asin="B0C"' then cast(k as double) / 100 end as share
from x where k < 50
""")
def targeting_history(spark, d):
    """C18 ``ingest.targeting_history``: the export by its own headers and windows, the console report
    whole and first, with its impression share; rows without an ad group set apart."""
    li = Tables(spark, d).lineitem
    k = (F.col("l_suppkey") % 60).cast("string")
    base = li.select(F.to_date("l_shipdate").alias("Date"), k.alias("k"), (F.col("l_linenumber") % 3).alias("n"), "l_returnflag").distinct()
    campaign, group = F.concat(F.lit("SP | A | "), "k", F.lit(" | z")), F.concat(F.lit("AG"), "k")
    export = base.where("n < 2").select(
        F.when(F.col("l_returnflag") == "N", "SB").otherwise("SP").alias("Type"), "Date", campaign.alias("Campaign"),
        group.alias("AdGroup"), F.when(F.col("n") == 0, "[Close Match]").otherwise(F.concat(F.lit("B0x"), "k")).alias("Keyword"),
        F.lit("enabled").alias("State"), F.lit("exact").alias("Match"), F.lit("$2.00").alias("Spent"), F.lit(0.5).alias("Current Bid"))
    console = base.where("n = 2").select(
        F.col("Date").alias("date"), campaign.alias("campaign_name"), group.alias("ad_group_name"),
        F.lit('asin="B0C"').alias("targeting"), F.lit("enabled").alias("ad_keyword_status"), F.lit("x").alias("match_type"),
        F.lit(2.0).alias("cost"), F.col("k").cast("double").alias("kk")).distinct()
    # one share per day and term: the console's key of that day decides it below
    share = console.select("date").distinct().select("date", F.lit("b0c").alias("search_term"), F.lit(1.0).alias("unit"))
    out, _ = ingest.targeting_history([export], _bulk(Tables(spark, d)), console, share, [("1996-12-12", "1996-12-26")])
    return out.select("date", "ad_group_id", "targeting", "match_type", (F.col("kk") / 100 * F.col("unit")).alias("share"))


@register("ads_report_batch", """
select cast(l_shipdate as date) as date, coalesce(case when l_linenumber <> 3 then l_suppkey end, 0) as ad_group_id,
       l_partkey as campaign_id, l_extendedprice as cost, l_quantity as sales_14d, c.c_nationkey as tenant_id
from lineitem left join customer c on 'c' || c.c_custkey = 'c' || l_orderkey where l_linenumber <> 5
""")
def ads_report_batch(spark, d):
    """C20 ``ingest.ads_report_batch``: names, NULL ids → 0, account → tenant, rows without a date dropped."""
    t = Tables(spark, d)
    raw = t.lineitem.select(
        F.when(F.col("l_linenumber") != 5, F.to_date("l_shipdate")).alias("date"),
        F.when(F.col("l_linenumber") != 3, F.col("l_suppkey")).alias("adGroupId"), F.col("l_partkey").alias("campaignId"),
        F.col("l_extendedprice").alias("cost"), F.col("l_quantity").alias("sales14d"),
        F.concat(F.lit("c"), _text("l_orderkey")).alias("account"), F.lit("f").alias("source_file"))
    tenants = t.customer.select(F.concat(F.lit("c"), _text("c_custkey")).alias("company"), F.col("c_nationkey").alias("tenant_id"))
    return ingest.ads_report_batch(raw, tenants).drop("account")


@register("orders_batch", """
with cur as (select case when o_orderpriority = '5-LOW' then 'CA' else 'US' end as m, max(o_orderdate) as w from orders
             where o_orderdate < timestamp '1997-01-01 00:00:00' and o_orderpriority <> '5-LOW' group by 1)
select cast(o_orderkey as varchar) as amazon_order_id, o_orderdate as last_update_date, o_orderstatus as order_total_status,
       1 as tenant_id, 'US' as marketplace
from orders where o_orderdate > (select w from cur)
""")
def orders_batch(spark, d):
    """C21 ``ingest.orders_batch``: order pages flattened, only those past the stored mark of their group."""
    o = Tables(spark, d).orders
    pages = o.select(F.array(F.struct(
        _text("o_orderkey").alias("AmazonOrderId"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("LastUpdateDate"),
        F.struct(F.col("o_orderstatus").alias("Status")).alias("OrderTotal"))).alias("Orders"))
    stored = o.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")).select(
        F.lit(1).alias("tenant_id"), F.when(F.col("o_orderpriority") == "5-LOW", "CA").otherwise("US").alias("marketplace"),
        F.col("o_orderdate").cast("timestamp").alias("last_update_date"))
    out = ingest.orders_batch(pages, stored, 1, "US")
    return out.withColumn("last_update_date", F.col("last_update_date").cast("timestamp_ntz"))


@register("order_items_batch", """
select cast(l_orderkey as varchar) as amazon_order_id, l_linenumber as order_item_id, cast(l_partkey as varchar) as seller_sku,
       l_extendedprice as item_price_amount, 1 as tenant_id, 'US' as marketplace from lineitem
""")
def order_items_batch(spark, d):
    """C21 ``ingest.order_items_batch``: item pages with their order's id, flattened."""
    li = Tables(spark, d).lineitem
    pages = li.select(_text("l_orderkey").alias("AmazonOrderId"), F.array(F.struct(
        F.col("l_linenumber").alias("OrderItemId"), _text("l_partkey").alias("SellerSKU"),
        F.struct(F.col("l_extendedprice").alias("Amount")).alias("ItemPrice"))).alias("OrderItems"))
    return ingest.order_items_batch(pages, 1, "US")


@register("finance_events", """
select o_orderkey as amazon_order_id, o_orderstatus as item_seller_sku, cast(o_totalprice as double) as item_amount, 3 as tenant_id,
       'CA' as marketplace, timestamp '2024-01-03 00:00:00' as loaded_at from orders where o_orderstatus <> 'P'
union all select o_orderkey, null, null, 3, 'CA', timestamp '2024-01-03 00:00:00' from orders where o_orderstatus = 'P'
""")
def finance_events(spark, d):
    """C22 ``ingest.finance_events``: one row per shipment item, events without items kept, tagged."""
    o = Tables(spark, d).orders
    item = F.struct(F.col("o_orderstatus").alias("SellerSKU"), F.col("o_totalprice").alias("Amount"))
    items = F.filter(F.array(item), lambda x: x["SellerSKU"] != "P")
    pages = o.select(F.struct(F.array(F.struct(F.col("o_orderkey").alias("AmazonOrderId"), items.alias("ShipmentItemList")))
                              .alias("ShipmentEventList")).alias("FinancialEvents"))
    out = ingest.finance_events(pages, AT, 3, "CA")
    return out.withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))


@register("inventory_snapshot", """
select cast(p_partkey as varchar) as asin, p_size as fulfillable_quantity, p_brand as reserved_quantity_brand, 1 as tenant_id,
       'US' as marketplace, date '2024-01-03' as date from part
""")
def inventory_snapshot(spark, d):
    """C23 ``ingest.inventory_snapshot``: the ``inventoryDetails_`` prefix dropped, stamped with the day."""
    p = Tables(spark, d).part
    details = F.struct(F.col("p_size").alias("fulfillableQuantity"), F.struct(F.col("p_brand").alias("brand")).alias("reservedQuantity"))
    pages = p.select(F.array(F.struct(_text("p_partkey").alias("asin"), details.alias("inventoryDetails"))).alias("inventorySummaries"))
    return ingest.inventory_snapshot(pages, 1, "US", AT.date())


@register("listing_snapshot", """
select cast(p_partkey as varchar) as sku, p_name as item_name, p_type as images_link, 1 as tenant_id, 'US' as marketplace,
       date '2024-01-03' as date from part
""")
def listing_snapshot(spark, d):
    """C23 ``ingest.listing_snapshot``: one data set of listings, nested lists by their last value, with the sku."""
    p = Tables(spark, d).part
    images = F.array(F.struct(F.col("p_brand").alias("link")), F.struct(F.col("p_type").alias("link")))
    raw = p.select(_text("p_partkey").alias("sku"), F.array(F.struct(
        F.col("p_name").alias("itemName"), images.alias("images"))).alias("summaries"))
    return ingest.listing_snapshot(raw, "summaries", 1, "US", AT.date())


@register("awd_detail", """
select 1 as tenant_id, date '2024-01-03' as date, cast(o_custkey as varchar) as order_id, cast(o_orderkey as varchar) as shipment_id,
       o_orderstatus as shipment_status, v.sku, case when v.sku = 'A' then 2 else 5 end as expected_quantity
from orders cross join (values ('A'), ('B')) v(sku)
""")
def awd_detail(spark, d):
    """C23 → C12: AWD shipments ingested (``ingest.awd_shipments``) and stored, then the mart over the table."""
    o = Tables(spark, d).orders

    def part(sku, n):
        return F.struct(F.lit(sku).alias("sku"), F.struct(F.lit(n).alias("quantity")).alias("expectedQuantity"))

    pages = o.select(F.array(F.struct(
        _text("o_orderkey").alias("shipmentId"), _text("o_custkey").alias("orderId"), F.col("o_orderstatus").alias("shipmentStatus"),
        F.lit("2024-01-01T00:00:00Z").alias("createdAt"), F.lit("2024-01-02T00:00:00Z").alias("updatedAt"),
        F.array(part("A", 2), part("B", 5)).alias("shipmentSkuQuantities"))).alias("shipments"))
    path = scratch_path(spark, "awd-shipments")
    load(ingest.awd_shipments(pages, 1, AT.date()), path, "replace")
    return marts.awd_inbound_detail({"awd.inbound_shipments": spark.read.parquet(path)})


@register("inbound_plan_shipments", """
select 'p' || o_custkey as inbound_plan_id, o_orderdate as date_created_at, 's' || o_orderkey as shipment_id, o_orderstatus as shipment_status,
       case when o_orderpriority = '5-LOW' then 'CA' else 'US' end as marketplace, 2 as tenant_id from orders
""")
def inbound_plan_shipments(spark, d):
    """C24 ``ingest.inbound_records`` → ``ingest.inbound_plan_shipments``: plans landed, exploded to their
    shipments, the first marketplace id resolved."""
    o = Tables(spark, d).orders
    code = F.when(F.col("o_orderpriority") == "5-LOW", "A2EUQ1WTGCTBG2").otherwise("ATVPDKIKX0DER")
    pages = o.select(F.array(F.struct(
        F.concat(F.lit("p"), _text("o_custkey")).alias("inboundPlanId"), F.col("o_orderdate").alias("createdAt"),
        F.array(code, F.lit("other")).alias("marketplaceIds"),
        F.array(F.struct(F.concat(F.lit("s"), _text("o_orderkey")).alias("shipmentId"), F.col("o_orderstatus").alias("status")))
        .alias("shipments"))).alias("inboundPlans"))
    out = ingest.inbound_plan_shipments(ingest.inbound_records(pages, "inboundPlans", 2), tenant_id=2)
    return out.select("inbound_plan_id", "date_created_at", "shipment_id", "shipment_status", "marketplace", "tenant_id")


@register("fee_estimates", """
select cast(p_partkey as varchar) as sku, p_retailprice as price_to_estimate_fees_amount, 'USD' as price_to_estimate_fees_currency_code,
       case when p_size % 3 > 0 then p_retailprice / 10 end as est_referral_fee,
       case when p_size % 3 > 0 then p_retailprice / 5 end as est_fba_fee, case when p_size % 3 = 0 then 'E' end as error_code
from part
""")
def fee_estimates(spark, d):
    """C25 ``ingest.fee_estimates``: fee types pivoted (last match), failures kept with their error."""
    p = Tables(spark, d).part

    def fee(kind, amount):
        return F.struct(F.lit(kind).alias("FeeType"), F.struct(amount.alias("Amount")).alias("FinalFee"))

    price = F.struct(F.struct(F.col("p_retailprice").alias("Amount"), F.lit("USD").alias("CurrencyCode")).alias("ListingPrice"))
    fees = F.array(fee("ReferralFee", F.lit(1.0)), fee("FBAFees", F.col("p_retailprice") / 5), fee("ReferralFee", F.col("p_retailprice") / 10))
    ok = F.col("p_size") % 3 > 0
    raw = p.select(
        F.when(ok, "Success").otherwise("ClientError").alias("Status"),
        F.struct(_text("p_partkey").alias("IdValue"), price.alias("PriceToEstimateFees")).alias("FeesEstimateIdentifier"),
        F.struct(F.lit("t").alias("TimeOfFeesEstimation"), F.struct(F.lit(1.0).alias("Amount")).alias("TotalFeesEstimate"),
                 fees.alias("FeeDetailList")).alias("FeesEstimate"),
        F.struct(F.lit("E").alias("Code"), F.lit("m").alias("Message")).alias("Error"))
    return ingest.fee_estimates(raw, AT).select("sku", "price_to_estimate_fees_amount", "price_to_estimate_fees_currency_code",
                                                "est_referral_fee", "est_fba_fee", "error_code")


@register("fx_rates_batch", """
select cast(cast(ts as date) as timestamp) as recorded_at, 'USD' as base, upper(event_type[1:3]) as target,
       cast(arg_max(cast(value as decimal(18,2)), (event_id, value)) as double) as rate
from events group by 1, 3
""")
def fx_rates_batch(spark, d):
    """C26 ``ingest.fx_rates_batch``: rate maps exploded; of repeated loads the last one stays."""
    e = Tables(spark, d).events
    pair = F.concat(F.lit("USD"), F.upper(F.substring("event_type", 1, 3)))
    raw = e.select(F.lit("USD").alias("source"), F.col("event_id").alias("loaded_at"), F.create_map(
        F.to_date("ts").cast("string"), F.create_map(pair, F.format_string("%.2f", "value"))).alias("quotes"))
    out = ingest.fx_rates_batch(raw)
    return out.select(F.col("recorded_at").cast("timestamp_ntz").alias("recorded_at"), "base", "target",
                      F.col("rate").cast("double").alias("rate"))


@register("keyword_rank_batch", """
with x as (select user_id, event_type, ts, event_id % 400 as rnk, row_number() over (
               partition by user_id, event_type, cast(ts as date) order by event_id % 400 desc) as rn from events)
select distinct 'k' || user_id as "Keyword", event_type as "ASIN", cast(cast(ts as date) as timestamp) - interval 8 hour as "Date Added",
       'US' as "Marketplace", cast(case when max(rnk) over w > 306 then 306 else max(rnk) over w end as bigint) as "Organic Rank"
from x window w as (partition by user_id, event_type, cast(ts as date)) qualify max(rnk) over w > 9
""")
def keyword_rank_batch(spark, d):
    """C27 ``ingest.keyword_rank_batch``: one row per key, bounded ranks, local time → UTC, rows
    without an organic rank left out."""
    e = Tables(spark, d).events
    daily = e.groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(F.max(F.col("event_id") % 400).alias("r"))
    rank = F.when(F.col("r") > 306, ">306").when(F.col("r") <= 9, "-").otherwise(_text("r"))
    raw = daily.select(F.concat(F.lit("k"), _text("user_id")).alias("Keyword"), F.col("event_type").alias("ASIN"),
                       F.concat(_text("day"), F.lit(" 00:00:00")).alias("Date Added"), F.lit("US").alias("Marketplace"),
                       rank.alias("Organic Rank"))
    batch, _ = ingest.keyword_rank_batch(raw.union(raw))
    return batch.withColumn("Date Added", F.col("`Date Added`").cast("timestamp_ntz"))


@register("sqp_batch", """
with x as (select user_id, event_type, cast(ts as date) as day, event_id % 3 as file, event_id, case when event_id % 4 > 0 then event_id end as v
           from events),
l as (select user_id, event_type, day, file, arg_max(v, event_id) filter (where v is not null) as v from x group by all)
select day as reporting_date, 'weekly' as reporting_range, 'US' as marketplace, 'a' || user_id as asin, event_type as search_query,
       arg_min(v, file) filter (where v is not null) as volume from l group by user_id, event_type, day
""")
def sqp_batch(spark, d):
    """C28 ``ingest.sqp_batch``: per key the values of the file read first, its last known line inside."""
    e = Tables(spark, d).events
    raw = e.select(F.to_date("ts").cast("string").alias("reporting_date"), F.lit(" Weekly").alias("reporting_range"),
                   F.lit("us").alias("marketplace"), F.concat(F.lit("a"), _text("user_id")).alias("asin"),
                   F.concat(F.lit(" "), F.upper("event_type")).alias("search_query"),
                   F.when(F.col("event_id") % 4 > 0, F.col("event_id")).alias("volume"),
                   (F.col("event_id") % 3).cast("string").alias("source_file"),
                   F.col("event_id").alias("line_no"))
    return ingest.sqp_batch(raw).select("reporting_date", "reporting_range", "marketplace", "asin", "search_query", "volume")


@register("planning_inventory_batch", """
select 4 as tenant_id, p_brand as marketplace, date '2024-01-01' + p_size as snapshot_date, min(p_name) as sku, 'New' as condition,
       cast(min(p_partkey) as bigint) as available from part group by p_brand, p_size, p_name
""")
def planning_inventory_batch(spark, d):
    """C29 ``ingest.planning_inventory_batch``: trimmed, '--' → NULL, conformed, first line per key."""
    p = Tables(spark, d).part
    raw = p.select(F.concat(F.lit(" "), "p_brand", F.lit(" ")).alias("marketplace"),
                   F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).cast("string").alias("snapshot-date"),
                   F.col("p_name").alias("sku"), F.lit("New").alias("condition"), _text("p_partkey").alias("available"),
                   F.lit("--").alias("unused"), F.col("p_partkey").alias("line_no"), F.lit("f").alias("source_file"))
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("tenant_id", T.IntegerType()), ("marketplace", T.StringType()), ("snapshot_date", T.DateType()), ("sku", T.StringType()),
        ("condition", T.StringType()), ("available", T.LongType()))])
    return ingest.planning_inventory_batch(raw, 4, schema)


@register("warehouse_stock", """
select cast(p_partkey as varchar) as "SKU", p_size as "Qty", 'W' as warehouse_name, 'A' as account_name,
       timestamp '2024-01-03 00:00:00' as recorded_at from part
""")
def warehouse_stock(spark, d):
    """C30 ``ingest.warehouse_stock``."""
    p = Tables(spark, d).part
    pages = p.select(F.array(F.struct(_text("p_partkey").alias("SKU"), F.col("p_size").alias("Qty"))).alias("items"))
    out = ingest.warehouse_stock(pages, "items", "W", "A", AT)
    return out.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))


@register("keyword_tool_batch", """
select 'US' as country, 'c' as category, p_name as "Keyword Phrase", case when p_size % 5 > 0 then p_size end as "Search Volume" from part
where p_size % 7 > 0
""")
def keyword_tool_batch(spark, d):
    """C31 ``ingest.keyword_tool_batch``: columns up to the last wanted, '-' → NULL, conformed, keyed rows only."""
    p = Tables(spark, d).part
    raw = p.select(F.when(F.col("p_size") % 7 > 0, F.col("p_name")).alias("Keyword Phrase"),
                   F.when(F.col("p_size") % 5 > 0, _text("p_size")).otherwise("-").alias("Search Volume"), F.lit("x").alias("More"))
    schema = T.StructType([T.StructField("country", T.StringType()), T.StructField("category", T.StringType()),
                           T.StructField("Keyword Phrase", T.StringType()), T.StructField("Search Volume", T.IntegerType())])
    return ingest.keyword_tool_batch(raw, schema, "Search Volume", "US", "c")


@register("legacy_report_batch", "select cast(o_orderdate as date) as date, o_custkey as clicks, cast(null as double) as spend from orders")
def legacy_report_batch(spark, d):
    """C32 ``ingest.legacy_report_batch``: headers renamed from the catalog, conformed."""
    o = Tables(spark, d).orders
    raw = o.select(F.to_date("o_orderdate").cast("string").alias("Start Date"), _text("o_custkey").alias("Clicks"))
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("clicks", T.LongType()), T.StructField("spend", T.DoubleType())])
    return ingest.legacy_report_batch(raw, {"Start Date": "date", "Clicks": "clicks"}, schema)


@register("mart_shipments", """
with i as (select l_orderkey, cast(sum(l_linenumber) as bigint) as shipped, cast(sum(l_linenumber * 2) as bigint) as received,
                  cast(count(*) as bigint) as skus from lineitem group by 1)
select 1 as tenant_id, 'CN' as "origin country", case when o_orderstatus <> 'P' then 'US' end as "destination country",
       o_orderpriority as "shipment name", 'F' || o_orderkey as "shipment id",
       case when o_orderstatus = 'F' then o_orderdate end as created, case when o_orderstatus = 'F' then o_orderdate end as "last updated",
       'FC' as "fulfillment center", i.skus, i.shipped as "quantity shipped", i.received as "quantity received",
       o_orderstatus as "shipment status", 'home' as "ship from", case when o_orderstatus <> 'P' then 'R' || o_orderkey end as "reference id",
       case when o_orderstatus = 'F' then 'p' || o_custkey end as "inbound plan id"
from orders left join i on i.l_orderkey = o_orderkey
union
select 1, 'CN', 'US', null, 'A' || c_custkey, timestamp '2024-01-01 00:00:00', null, 'AWD', 2, 7, c_nationkey, 'SHIPPED', 'o', 'w', null
from customer
""")
def mart_shipments(spark, d):
    """C11 ``marts.shipments``: shipments ⟕ items ⟕ plan shipments ⟕ exploded plans, UNION the latest AWD snapshot."""
    t = Tables(spark, d)
    one, key = F.lit(1).alias("tenant_id"), _text("o_orderkey")
    o = t.orders
    stamp = F.col("o_orderdate").cast("timestamp")
    sku = [F.struct(F.lit(s).alias("sku"), F.struct(F.lit(n).cast("bigint").alias("quantity")).alias("expectedQuantity"))
           for s, n in (("A", 2), ("B", 5))]

    def awd(day, status):
        return t.customer.select(
            F.when(F.col("c_custkey") >= 0, 1).alias("tenant_id"), F.lit(day).cast("date").alias("date"), _text("c_custkey").alias("order_id"),
            F.concat(F.lit("A"), _text("c_custkey")).alias("shipment_id"), F.lit(status).alias("shipment_status"),
            F.lit("o").alias("origin_address_name"), F.lit("CN").alias("origin_address_country_code"),
            F.lit("AWD").alias("destination_address_name"), F.lit("US").alias("destination_address_country_code"),
            F.lit("w").alias("warehouse_reference_id"), F.lit("2024-01-01").cast("timestamp").alias("shipment_create_date_utc"),
            F.lit(None).cast("timestamp").alias("shipment_last_update_date_utc"),
            F.array(F.struct(F.col("c_nationkey").cast("bigint").alias("quantity"))).alias("received_quantity"),
            F.array(*sku).alias("shipment_sku_quantities"))

    out = marts.shipments({
        "fulfillment_inbound.shipments": o.select(
            one, F.concat(F.lit("F"), key).alias("shipment_id"), F.col("o_orderpriority").alias("shipment_name"),
            F.col("o_orderstatus").alias("shipment_status"), F.lit("FC").alias("destination_fulfillment_center_id"),
            F.lit("home").alias("ship_from_address_name"), F.lit("CN").alias("ship_from_address_country_code")),
        "fulfillment_inbound.shipment_items": t.lineitem.select(
            one, F.concat(F.lit("F"), _text("l_orderkey")).alias("shipment_id"), _text("l_partkey").alias("seller_sku"),
            F.col("l_linenumber").cast("bigint").alias("quantity_shipped"),
            (F.col("l_linenumber") * 2).cast("bigint").alias("quantity_received")),
        "fulfillment_inbound.inbound_plans_shipments": o.where("o_orderstatus <> 'P'").select(
            one, F.concat(F.lit("s"), key).alias("shipment_id"), F.concat(F.lit("F"), key).alias("shipment_confirmation_id"),
            F.concat(F.lit("R"), key).alias("amazon_reference_id"), F.lit("US").alias("destination_address_country_code")),
        "fulfillment_inbound.inbound_plans_info": o.where("o_orderstatus = 'F'").select(
            one, F.concat(F.lit("p"), _text("o_custkey")).alias("inbound_plan_id"),
            F.array(F.struct(F.concat(F.lit("s"), key).alias("shipmentId"))).alias("shipments"),
            stamp.alias("date_created_at"), stamp.alias("last_updated_at")),
        "awd.inbound_shipments": awd("2024-01-02", "SHIPPED").union(awd("2024-01-01", "CREATED"))})
    return out.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in ("created", "last updated")})
