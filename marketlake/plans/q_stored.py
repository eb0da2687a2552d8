"""The marts and history repairs themselves, over stored-table shapes of the driver tables.

Each adapter renames driver columns to those of the stored tables (whole tables, all
rows); the query then calls the function of ``marts.py`` / ``ingest.py`` that users call.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators.aggregates import sum_metrics
from marketlake.operators.joins import left_join_exploded as _left_join_exploded
from marketlake.operators.joins import left_join_latest as _left_join_latest
from marketlake.plans import ingest, marts
from marketlake.plans.registry import register
from marketlake.plans.tables import Tables
from marketlake.session import scratch_path
from marketlake.sources.catalog import route
from marketlake.sources.dimensions import register_view, tenant_lookup as _tenant_lookup
from marketlake.sources.files import REPORT_NAME, name_parts
from marketlake.sources.tables import read_table, sql


def _day(c):
    return F.to_date(c)


def _campaign_facts(t):
    li = t.lineitem
    return li.select((F.col("l_linenumber") % 2).cast("int").alias("tenant_id"), F.col("l_partkey").alias("campaign_id"),
                     F.when(F.col("l_returnflag") == "R", "US").otherwise("CA").alias("marketplace"),
                     _day("l_shipdate").alias("date"), F.col("l_extendedprice").alias("cost"),
                     F.col("l_quantity").cast("bigint").alias("units"), F.col("l_linenumber").cast("bigint").alias("clicks"),
                     (F.col("l_quantity").cast("bigint") - 1).alias("impressions"), F.col("l_tax").alias("sales"),
                     F.when(F.col("l_linestatus") == "F", "enabled").otherwise("archived").alias("campaign_status"),
                     F.lit("USD").alias("currency"), F.col("l_suppkey").alias("portfolio_id"))


def _portfolios(t):
    return t.supplier.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("tenant_id"),
                             F.col("s_suppkey").alias("portfolio_id"),
                             F.when(F.col("s_suppkey") == 3, "ALL").otherwise(F.replace("s_name", F.lit("#"), F.lit("-")))
                             .alias("name"))


def _console(t):
    return t.orders.select((F.col("o_orderkey") % 2).cast("int").alias("tenant_id"),
                           F.when(F.col("o_orderstatus") == "F", "US").otherwise("CA").alias("marketplace"),
                           _day("o_orderdate").alias("date"), F.col("o_orderpriority").alias("portfolio_name"),
                           F.lit("USD").alias("currency"), F.col("o_totalprice").alias("spend"),
                           F.lit(1).cast("bigint").alias("units"), F.col("o_custkey").alias("clicks"),
                           F.lit(2).cast("bigint").alias("impressions"), F.col("o_totalprice").alias("sales"))


_FACTS = """
f as (select cast(l_linenumber % 2 as integer) as tenant_id, l_partkey as campaign_id,
             case when l_returnflag = 'R' then 'US' else 'CA' end as marketplace, cast(l_shipdate as date) as date,
             l_extendedprice as cost, cast(l_quantity as bigint) as units, l_linenumber as clicks,
             cast(l_quantity as bigint) - 1 as impressions, l_tax as sales,
             case when l_linestatus = 'F' then 'enabled' else 'archived' end as status, l_suppkey from lineitem),
p as (select tenant_id, s_suppkey as portfolio_id, case when s_suppkey = 3 then 'ALL' else replace(s_name, '#', '-') end as name
      from supplier cross join (values (0), (1)) v(tenant_id)),
d as (select tenant_id, campaign_id, l_suppkey as portfolio_id from (
        select *, row_number() over (partition by tenant_id, campaign_id order by date desc nulls first, l_suppkey) as rn
        from f) x where rn = 1),
c as (select cast(o_orderkey % 2 as integer) as tenant_id, case when o_orderstatus = 'F' then 'US' else 'CA' end as marketplace,
             cast(o_orderdate as date) as date, o_orderpriority as portfolio_name, o_totalprice as spend, o_custkey as clicks
      from orders)
"""
_MONEY = "cast(sum(cast({} as decimal(18,4))) as double)"


def _code(name: str, all_code: bool = False) -> str:
    rest = f"case when {name} like '%-%' then split_part({name}, '-', 1) end"
    return f"case when {name} = 'ALL' then 'ALL' else {rest} end" if all_code else rest


@register("mart_sp_us", f"""
with {_FACTS}
select f.tenant_id, f.date, f.marketplace, p.name as portfolio_name, {_code('p.name')} as product_code, 'USD' as currency,
       {_MONEY.format('f.cost')} as total_cost, cast(sum(f.units) as bigint) as total_units_sold_clicks_7d,
       cast(sum(f.clicks) as bigint) as total_clicks, cast(sum(f.impressions) as bigint) as total_impressions,
       {_MONEY.format('f.sales')} as sales_7d
from f left join d on f.tenant_id = d.tenant_id and f.campaign_id = d.campaign_id
       left join p on d.tenant_id = p.tenant_id and d.portfolio_id = p.portfolio_id
where f.marketplace = 'US' group by f.tenant_id, f.date, f.marketplace, p.name having sum(f.impressions) > 0
union
select tenant_id, date, marketplace, portfolio_name, {_code('portfolio_name')}, 'USD', {_MONEY.format('spend')},
       cast(count(*) as bigint), cast(sum(clicks) as bigint), cast(2 * count(*) as bigint), {_MONEY.format('spend')}
from c where marketplace = 'US' and date < date '2023-04-02' group by tenant_id, date, marketplace, portfolio_name
""")
def mart_sp_us(spark, d):
    """C04 ``marts.sp_spend`` over campaign facts, targeting, portfolios and console history."""
    t = Tables(spark, d)
    facts = _campaign_facts(t)
    return marts.sp_spend({
        "sponsored_products.campaign": facts.drop("portfolio_id").withColumnsRenamed(
            {"units": "units_sold_clicks_7d", "sales": "sales_7d", "currency": "campaign_budget_currency_code"}),
        "sponsored_products.targeting": facts, "amazon_advertising_portfolios": _portfolios(t),
        "sponsored_products.campaign_console": _console(t).withColumnsRenamed(
            {"units": "7_day_total_orders", "sales": "7_day_total_sales"})}, "US")


def _v2(schema, t):
    facts = _campaign_facts(t)
    dims = marts.latest_values(facts.select("tenant_id", "campaign_id", "portfolio_id", "date"),
                               ["tenant_id", "campaign_id"], ["date desc"], ["portfolio_id"], ties=["portfolio_id"])
    return {f"{schema}.campaign_v2": facts.drop("portfolio_id").withColumns(
                {"attributed_units_ordered_new_to_brand_14d": F.col("units"), "attributed_units_ordered_7d": F.col("units"),
                 "attributed_sales_14d": F.col("sales")}),
            f"{schema}.campaigns": dims, "amazon_advertising_portfolios": _portfolios(t),
            f"{schema}.campaign_console": _console(t).withColumnsRenamed(
                {"units": "14_day_total_units", "sales": "14_day_total_sales"})}


def _v2_sql(units: str, all_code: bool, where_api: str, where_console: str, sales: bool) -> str:
    s_api = f", {_MONEY.format('f.sales')} as attributed_sales_14d" if sales else ""
    s_con = f", {_MONEY.format('spend')}" if sales else ""
    return f"""
with {_FACTS}
select f.tenant_id, f.date, f.marketplace, p.name as portfolio_name, {_code('p.name', all_code)} as product_code,
       'USD' as currency, {_MONEY.format('f.cost')} as total_cost, cast(sum(f.units) as bigint) as {units},
       cast(sum(f.clicks) as bigint) as total_clicks, cast(sum(f.impressions) as bigint) as total_impressions{s_api}
from f left join d on f.tenant_id = d.tenant_id and f.campaign_id = d.campaign_id
       left join p on d.tenant_id = p.tenant_id and d.portfolio_id = p.portfolio_id
where {where_api} group by f.tenant_id, f.date, f.marketplace, p.name
union
select tenant_id, date, marketplace, portfolio_name, {_code('portfolio_name', all_code)}, 'USD', {_MONEY.format('spend')},
       cast(count(*) as bigint), cast(sum(clicks) as bigint), cast(2 * count(*) as bigint){s_con}
from c where {where_console} and date <= date '2023-06-10' group by tenant_id, date, marketplace, portfolio_name
"""


@register("mart_sb_us", _v2_sql("attributed_units_ordered_new_to_brand_14d", True,
                                "f.marketplace = 'US' and f.status in ('enabled', 'paused')", "marketplace = 'US'", True))
def mart_sb_us(spark, d):
    """C06 ``marts.sb_spend``."""
    return marts.sb_spend(_v2("sponsored_brands", Tables(spark, d)), "US")


@register("mart_sd", _v2_sql("attributed_units_ordered_7d", False, "true", "true", False))
def mart_sd(spark, d):
    """C08 ``marts.sd_spend``."""
    return marts.sd_spend(_v2("sponsored_display", Tables(spark, d)))


# ---------------------------------------------------------------- orders
def _orders(t):
    o = t.orders.select(
        F.lit(1).alias("tenant_id"), F.col("o_orderkey").cast("string").alias("amazon_order_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "CA").otherwise("US").alias("marketplace"),
        F.col("o_orderdate").cast("timestamp").alias("purchase_date"),
        F.when(F.col("o_orderstatus") == "P", "Pending").otherwise("Shipped").alias("order_status"),
        F.lit("store").alias("sales_channel"), F.lit("US").alias("shipping_address_country_code"),
        (F.col("o_orderkey") % 7 == 0).alias("is_replacement_order"),
        F.when(F.col("o_orderkey") % 7 == 0, F.col("o_custkey").cast("string")).alias("replaced_order_id"))
    missing = F.col("l_discount") == 0.1
    items = t.lineitem.select(
        F.lit(1).alias("tenant_id"), F.col("l_orderkey").cast("string").alias("amazon_order_id"),
        F.col("l_partkey").cast("string").alias("asin"), F.col("l_suppkey").cast("string").alias("seller_sku"),
        F.col("l_quantity").cast("bigint").alias("quantity_ordered"),
        F.when(missing, F.when(F.col("l_linenumber") == 1, "nan")).otherwise("USD").alias("item_price_currency_code"),
        F.when(~missing, F.col("l_extendedprice")).alias("item_price_amount"), F.col("l_tax").alias("item_tax_amount"))
    offers = t.part.select("p_partkey", "p_retailprice", "p_size", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    price = F.struct(F.struct(F.struct(F.lit("MXN").alias("CurrencyCode"),
                                       (F.col("p_retailprice") + F.col("k")).alias("Amount")).alias("ListingPrice"))
                     .alias("Price"))
    offers = offers.select(
        F.lit(1).alias("tenant_id"), F.col("p_partkey").cast("string").alias("asin"), F.lit("US").alias("marketplace"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("k")).alias("date"),
        F.when(F.col("p_size") % 5 == 0, "Consumer").otherwise("Business").alias("customer_type"),
        # the newest snapshot has no price: the one before it counts
        F.when(F.col("k") < 2, F.array(price)).otherwise(F.filter(F.array(price), lambda _: F.lit(False)))
        .alias("product_competitive_pricing_competitive_prices"))
    return o, items, offers


@register("mart_orders_us", """
with o as (select *, case when o_orderpriority = '5-LOW' then 'CA' else 'US' end as marketplace, o_orderkey % 7 = 0 as repl,
                  case when o_orderstatus = 'P' then 'Pending' else 'Shipped' end as order_status from orders),
x as (select o.*, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_tax,
             case when l.l_discount = 0.1 then null else l.l_extendedprice end as amt,
             case when l.l_discount = 0.1 then case when l.l_linenumber = 1 then 'nan' end
                  when l.l_orderkey is not null then 'USD' end as cur,
             case when p.p_size % 5 <> 0 then p.p_retailprice + 1 end as listing
      from o left join lineitem l on o.o_orderkey = l.l_orderkey left join part p on l.l_partkey = p.p_partkey
      where o.marketplace = 'US' and o.o_orderdate >= timestamp '1995-01-01 00:00:00')
select cast(o_orderdate as date) as "GMT-date", cast(o_orderdate - interval 7 hour as date) as "PDT-date", 1 as tenant_id,
       cast(o_orderkey as varchar) as amazon_order_id, o_orderdate as purchase_date, order_status, 'store' as sales_channel,
       cast(l_suppkey as varchar) as seller_sku, cast(l_partkey as varchar) as asin,
       cast(l_quantity as bigint) as quantity_ordered,
       case when (cur is null or cur = 'nan') and not repl then case when listing is not null then 'MXN' end else cur end as currency,
       case when amt is null and not repl then listing * cast(l_quantity as bigint) else amt end as item_price_amount,
       l_tax as item_tax_amount, 'US' as shipping_address_country_code, repl as is_replacement_order,
       case when order_status not in ('Pending', 'Canceled') and amt is null and not repl then 'Y'
            else case when repl then cast(o_custkey as varchar) end end as "Vine / replaced_order_id"
from x
""")
def mart_orders_us(spark, d):
    """C09 ``marts.orders_mart``: price fallback from the latest non-empty Business offer."""
    o, items, offers = _orders(Tables(spark, d))
    out = marts.orders_mart({"orders.amazon_orders": o, "orders.amazon_order_items": items,
                             "product_pricing.competitive_pricing": offers}, "US", since="1995-01-01")
    return out.withColumn("purchase_date", F.col("purchase_date").cast("timestamp_ntz"))


@register("mart_orders_summary", """
select 1 as tenant_id, cast(o.o_orderdate as date) as purchase_date,
       case when o.o_orderpriority = '5-LOW' then 'CA' else 'US' end as marketplace, cast(l.l_partkey as varchar) as asin,
       cast(l.l_suppkey as varchar) as seller_sku, cast(sum(cast(l.l_quantity as bigint)) as bigint) as quantity_ordered
from orders o left join lineitem l on o.o_orderkey = l.l_orderkey group by 2, 3, 4, 5
""")
def mart_orders_summary(spark, d):
    """C10 ``marts.orders_summary``."""
    o, items, _ = _orders(Tables(spark, d))
    return marts.orders_summary({"orders.amazon_orders": o, "orders.amazon_order_items": items})


# ---------------------------------------------------------------- inventory, fees, reports
_FBA_NUMBERS = marts.FBA_COLUMNS[6:]


@register("mart_fba_inventory", f"""
select cast(p_partkey as varchar) as asin, 'F' || p_partkey as fn_sku, p_name as seller_sku, 'US' as marketplace,
       date '2024-03-01' as date, cast(date '2024-03-01' - cast(p_size as integer) as timestamp) as last_updated_time,
       {", ".join(f"cast(p_size + {i} as bigint) as {c}" for i, c in enumerate(_FBA_NUMBERS))}
from part where p_size < 30 and p_size % 11 <> 0
""")
def mart_fba_inventory(spark, d):
    """C02 ``marts.fba_inventory``: rows updated within 30 days; rows never updated are out."""
    p = Tables(spark, d).part
    day = F.lit("2024-03-01").cast("date")
    df = p.select(F.lit(1).alias("tenant_id"), F.col("p_partkey").cast("string").alias("asin"),
                  F.concat(F.lit("F"), F.col("p_partkey").cast("string")).alias("fn_sku"), F.col("p_name").alias("seller_sku"),
                  F.lit("US").alias("marketplace"), day.alias("date"),
                  F.when(F.col("p_size") % 11 != 0, F.date_sub(day, F.col("p_size")).cast("timestamp")).alias("last_updated_time"),
                  *[(F.col("p_size") + i).cast("bigint").alias(c) for i, c in enumerate(_FBA_NUMBERS)])
    return marts.fba_inventory({"inventory.fba": df}).withColumn(
        "last_updated_time", F.col("last_updated_time").cast("timestamp_ntz"))


_BUS = [c for c in marts.BUSINESS_COLUMNS if c not in ("date", "parent_asin", "marketplace")]


@register("mart_business_parent", "select cast(c_nationkey as integer) as tenant_id, date '2024-01-01' as date, c_name as parent_asin, "
          "c_mktsegment as marketplace, " + ", ".join(
              f"(c_acctbal + {i}){' / 100' if c in marts.BUSINESS_PERCENT_COLUMNS else ''} as {c}" for i, c in enumerate(_BUS))
          + " from customer")
def mart_business_parent(spark, d):
    """C03 ``marts.business_report_parent``: the listed columns, percentages as ratios."""
    c = Tables(spark, d).customer
    df = c.select(F.col("c_nationkey").cast("int").alias("tenant_id"), F.lit("2024-01-01").cast("date").alias("date"),
                  F.col("c_name").alias("parent_asin"), F.col("c_mktsegment").alias("marketplace"),
                  *[(F.col("c_acctbal") + i).alias(n) for i, n in enumerate(_BUS)], F.lit(1).alias("not_in_the_report"))
    return marts.business_report_parent({"business_reports.detail_page_sales_and_traffic_parent": df})


_FEE_TEXT = {"date", "sku", "fnsku", "asin", "amazon_store", "product_name", "product_group", "brand", "fulfilled_by",
             "unit_of_dimension", "unit_of_weight", "product_size_tier", "currency"}
_FEE_REST = [c for c in marts.FEE_COLS if c not in ("date", "referral_fee_%")]


def _fee_sql(c: str) -> str:
    if c == "product_group":
        return "p_brand as product_group"
    return f"'{c}' || p_partkey as {c}" if c in _FEE_TEXT else f"p_retailprice + {_FEE_REST.index(c)} as {c}"


def _pad_sql(c: str) -> str:
    given = {"sku": "'s' || s_suppkey", "fnsku": "'f' || s_suppkey", "asin": "'a' || s_suppkey", "amazon_store": "'US'",
             "product_name": "s_name", "product_group": "'g'", "your_price": "s_acctbal", "sales_price": "s_acctbal"}
    return given.get(c, f"cast(null as {'varchar' if c in _FEE_TEXT else 'double'})")


@register("mart_fee_preview", f"""
select 1 as tenant_id, date '2024-01-01' as date, {", ".join(map(_fee_sql, _FEE_REST))},
       (p_retailprice + {_FEE_REST.index('estimated_referral_fee_per_unit')}) / (p_retailprice + {_FEE_REST.index('your_price')})
           as "referral_fee_%"
from part
union
select 1, date '2024-01-02', {", ".join(map(_pad_sql, _FEE_REST))}, cast(null as double)
from supplier where s_suppkey % 3 = 0
""")
def mart_fee_preview(spark, d):
    """C14 ``marts.fee_preview``: fee rows with the referral ratio UNION zero-stock planning rows."""
    t = Tables(spark, d)
    key = F.col("p_partkey").cast("string")
    fee = t.part.select(F.lit(1).alias("tenant_id"), F.lit("2024-01-01").cast("date").alias("date"), *[
        F.col("p_brand").alias(c) if c == "product_group" else F.concat(F.lit(c), key).alias(c) if c in _FEE_TEXT
        else (F.col("p_retailprice") + i).alias(c) for i, c in enumerate(_FEE_REST)])
    s = F.col("s_suppkey").cast("string")
    plan = t.supplier.select(
        F.lit(1).alias("tenant_id"), F.lit("2024-01-02").cast("date").alias("snapshot_date"),
        F.concat(F.lit("s"), s).alias("sku"), F.concat(F.lit("f"), s).alias("fnsku"), F.concat(F.lit("a"), s).alias("asin"),
        F.lit("US").alias("marketplace"), F.col("s_name").alias("product_name"), F.lit("g").alias("product_group"),
        F.col("s_acctbal").alias("your_price"), F.col("s_acctbal").alias("sales_price"),
        (F.col("s_suppkey") % 3).alias("available"))
    return marts.fee_preview({"business_reports.fba_fee_preview": fee, "inventory.fba_planning_inventory": plan})


# ---------------------------------------------------------------- keywords
@register("mart_keyword_opportunity", """
with a as (select case when user_id % 10 = 0 then null else 'c' || user_id % 3 end as category, 'q' || user_id as kw,
                  max(cast(floor(value) as bigint)) as vol, max(cast(event_id % 50 as bigint)) as tot, cast(sum(event_id % 9) as bigint) as imp,
                  cast(sum(event_id % 4) as bigint) as clk, cast(sum(event_id % 2) as bigint) as pur
           from events where event_type <> 'error' group by 1, 2),
b as (select 'c' || c_custkey % 3 as category2, 'q' || c_custkey as phrase, c_acctbal as v from customer where c_acctbal > 3)
select a.category, b.category2, coalesce(a.kw, b.phrase) as keyword_phrase, a.vol as search_query_volume,
       v as cerebro_search_volume, a.tot as total_purchases, a.imp as impressions,
       cast(a.imp as double) / nullif(cast(a.vol as double), 0) as impression_share, a.clk as clicks,
       cast(a.clk as double) / nullif(cast(a.imp as double), 0) as click_through_rate, a.pur as purchases,
       coalesce(cast(a.pur as double) / nullif(cast(a.clk as double), 0), 0) as conversion_rate, v as position_rank,
       v as relative_rank, v as competitor_rank_avg, v as ranking_competitors_count, v as competitor_performance_score,
       v as h10_sugg_bid, v as h10_min_bid, v as h10_max_bid
from a full join b on a.category = b.category2 and a.kw = b.phrase
""")
def mart_keyword_opportunity(spark, d):
    """C15 ``marts.keyword_opportunity``: funnel ⟗ keyword tool on category and phrase."""
    t = Tables(spark, d)
    e = t.events.where(F.col("event_type") != "error")
    n = F.col("event_id")
    sqp = e.select(F.lit("US").alias("country"), F.col("user_id").alias("asin"), F.lit("2024-01-06").cast("date").alias("Reporting Date"),
                   F.concat(F.lit("q"), F.col("user_id").cast("string")).alias("Search Query"),
                   F.floor("value").alias("Search Query Volume"),
                   (n % 50).alias("Search Funnel - Purchases: Total Count"), (n % 9).alias("Search Funnel - Impressions: ASIN Count"),
                   (n % 4).alias("Search Funnel - Clicks: ASIN Count"), (n % 2).alias("Search Funnel - Purchases: ASIN Count"))
    products = e.select(F.col("user_id").alias("asin")).distinct().select("asin", F.when(
        F.col("asin") % 10 != 0, F.concat(F.lit("c"), (F.col("asin") % 3).cast("string"))).alias("category"))
    cerebro = t.customer.select(
        F.lit("US").alias("country"), F.concat(F.lit("c"), (F.col("c_custkey") % 3).cast("string")).alias("category"),
        F.concat(F.lit("q"), F.col("c_custkey").cast("string")).alias("Keyword Phrase"),
        F.lit("2024-01-07 03:00:00").cast("timestamp").alias("created"),
        *[F.col("c_acctbal").alias(c) for c in marts.CEREBRO_COLUMNS])
    return marts.keyword_opportunity({"search_query_performance": sqp, "product_amazon": products, "cerebro_amazon": cerebro}, "US")


@register("mart_search_query_totals", """
select cast(ts as date) as reporting_date, event_type as search_query, cast(sum(user_id) as bigint) as search_query_volume,
       cast(sum(event_id % 5) as bigint) as purchases_total_count, cast(sum(event_id % 2) as bigint) as purchases_brand_count
from events group by 1, 2
""")
def mart_search_query_totals(spark, d):
    """C16 ``marts.search_query_totals`` (ordered by a hidden average, A06)."""
    e = Tables(spark, d).events.select(
        F.to_date("ts").alias("reporting_date"), F.col("event_type").alias("search_query"),
        F.col("user_id").alias("search_query_volume"), (F.col("event_id") % 5).alias("purchases_total_count"),
        (F.col("event_id") % 2).alias("purchases_brand_count"), F.col("value").alias("search_query_score"))
    return marts.search_query_totals({"search_query_performance_brand_view": e}, ordered=True)


# ---------------------------------------------------------------- history repairs
def _bulk(t):
    """Two spellings per campaign: the sheet must not double rows."""
    key = (F.col("s_suppkey") % 50).cast("string")
    sheet = t.supplier.select("s_suppkey", F.explode(F.array(F.lit("x [old]"), F.lit("y {ARCHIVE}"))).alias("tail"))
    return sheet.select(
        F.concat(F.lit("P"), key).alias("portfolio_name"), (F.col("s_suppkey") % 50).alias("portfolio_id"),
        F.concat(F.lit("SP | A | "), key, F.lit(" | "), "tail").alias("campaign_name"), F.concat(F.lit("AG"), key).alias("ad_group_name"),
        (F.col("s_suppkey") % 50 + 1000).alias("campaign_id"), (F.col("s_suppkey") % 50 + 2000).alias("ad_group_id"))


def _text_money(c):
    return F.concat(F.lit("$"), F.format_string("%.2f", c))


@register("search_term_history", """
with x as (select cast(l_shipdate as date) as date, l_orderkey as search_term, l_suppkey % 60 as k, l_extendedprice as cost,
                  l_quantity, l_linenumber, l_discount from lineitem
           where l_returnflag <> 'N' and cast(l_shipdate as date) between date '1996-01-01' and date '1997-06-30')
select date, cast(search_term as varchar) as search_term, 'AG' || k as ad_group_name,
       case when l_linenumber % 2 = 0 then 'close-match' else 'asin="B0X' || k || '"' end as targeting,
       case when l_linenumber % 2 = 0 then 'TARGETING_EXPRESSION_PREDEFINED' else 'TARGETING_EXPRESSION' end as match_type,
       'ENABLED' as ad_keyword_status, case when k < 50 then k + 1000 end as campaign_id,
       case when k < 50 then k + 2000 end as ad_group_id, case when k < 50 then k end as portfolio_id,
       round(cost, 2) as cost, case when l_discount > 0.05 then 0 else 1.5 end as cost_per_click,
       cast(l_linenumber as double) / nullif(l_quantity, 0) as click_through_rate, 'USD' as campaign_budget_currency_code
from x
""")
def search_term_history(spark, d):
    """C17 ``ingest.search_term_history``: window, ids by cleaned names, money, canonical targets."""
    t = Tables(spark, d)
    k = F.col("l_suppkey") % 60
    export = t.lineitem.select(
        F.when(F.col("l_returnflag") == "N", "Brands").otherwise("Products").alias("Sponsored"),
        F.to_date("l_shipdate").alias("Date"), F.col("l_orderkey").cast("string").alias("Search Terms"),
        F.concat(F.lit("SP | A | "), k.cast("string"), F.lit(" | z")).alias("Campaign"),
        F.concat(F.lit("AG"), k.cast("string")).alias("AdGroup"),
        F.when(F.col("l_linenumber") % 2 == 0, "[Close Match]").otherwise(F.concat(F.lit("B0x"), k.cast("string"))).alias("Keyword"),
        F.lit("enabled").alias("State"), F.lit("exact").alias("Match"), F.col("l_linenumber").alias("Clicks"),
        F.col("l_quantity").alias("Impressions"), _text_money(F.col("l_extendedprice")).alias("Cost"),
        F.when(F.col("l_discount") <= 0.05, "$1.50").alias("CPC"), F.lit("$9").alias("Total Cost"))
    out = ingest.search_term_history([export], _bulk(t), windows=[("1996-01-01", "1997-06-30")])
    return out.select("date", "search_term", "ad_group_name", "targeting", "match_type", "ad_keyword_status", "campaign_id",
                      "ad_group_id", "portfolio_id", "cost", "cost_per_click", "click_through_rate",
                      "campaign_budget_currency_code")


@register("placement_history", """
with e as (select cast(o_orderdate as date) as date, o_custkey % 60 as k,
                  case o_orderpriority when '1-URGENT' then 'Top of Search on-Amazon' when '2-HIGH' then 'Detail Page on-Amazon'
                       when '3-MEDIUM' then 'Other on-Amazon' when '4-NOT SPECIFIED' then null else 'odd' end as placement
           from orders),
x as (select * from e where placement is not null and date > date '1996-12-12' and date < date '1998-04-02'
      union all select date, k, 'Other on-Amazon' from e where placement is null)
select date, k + 1000 as campaign_id, placement as placement_classification, 'ENABLED' as campaign_status
from x where k < 50 group by all
""")
def placement_history(spark, d):
    """C19 ``ingest.placement_history``: NULL placements dropped from the export and its windows,
    the console report whole, one row per (date, campaign, placement)."""
    t = Tables(spark, d)
    k = (F.col("o_custkey") % 60).cast("string")
    label = F.create_map(*[F.lit(x) for x in ("1-URGENT", "Top of Search", "2-HIGH", "Product Pages", "3-MEDIUM", "Rest of Search",
                                              "5-LOW", "odd")])
    base = t.orders.select(F.to_date("o_orderdate").alias("Date"), F.lit("enabled").alias("State"),
                           F.concat(F.lit("SP | A | "), k, F.lit(" | z")).alias("Campaign"),
                           F.try_element_at(label, F.col("o_orderpriority")).alias("Placement"),
                           F.lit(10).alias("Impressions"), F.lit(1).alias("Clicks"), F.lit("($2.00)").alias("Spent"))
    console = base.where("Placement is null").select(
        F.col("Date").alias("date"), F.col("State").alias("campaign_status"), F.col("Campaign").alias("campaign_name"),
        F.lit("Search on-Amazon").alias("placement_classification"), F.col("Impressions").alias("impressions"),
        F.col("Clicks").alias("clicks"), F.lit(2.0).alias("cost"))
    out = ingest.placement_history([base], _bulk(t), console, [("1996-12-12", "1998-04-02")])
    return out.select("date", "campaign_id", "placement_classification", "campaign_status")


# ---------------------------------------------------------------- operators behind the marts
@register("left_join_latest", """
with latest as (select * from (select o_custkey, o_orderkey, o_totalprice, row_number() over (
                    partition by o_custkey order by o_orderdate desc nulls first, o_orderkey desc) as rn from orders) x where rn = 1)
select c.c_custkey, c.c_name, l.o_orderkey, l.o_totalprice from customer c left join latest l on c.c_custkey = l.o_custkey
""")
def left_join_latest(spark, d):
    """Customers with their latest order (one row per customer)."""
    t = Tables(spark, d)
    out = _left_join_latest(t.customer, t.orders, ["o_custkey"], ["o_orderdate desc", "o_orderkey desc"], ties=[],
                            fact_keys=["c_custkey"])
    return out.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@register("left_join_exploded", """
with plans as (select o_custkey as plan, o_orderkey as shipment from orders where o_orderstatus <> 'P')
select l.l_orderkey, l.l_linenumber, p.plan from lineitem l left join plans p on l.l_orderkey = p.shipment
""")
def left_join_exploded(spark, d):
    """Items left joined to the shipments exploded out of each plan's list."""
    t = Tables(spark, d)
    plans = t.orders.where(F.col("o_orderstatus") != "P").select(
        F.col("o_custkey").alias("plan"), F.array(F.struct(F.col("o_orderkey").alias("shipmentId"))).alias("shipments"))
    out = _left_join_exploded(t.lineitem.select("l_orderkey", "l_linenumber"), plans, "shipments", "shipmentId",
                              "shipment", "l_orderkey")
    return out.select("l_orderkey", "l_linenumber", "plan")


@register("sums_having", """
select l_suppkey, l_returnflag, cast(sum(l_linenumber) as bigint) as lines, max(l_shipdate) as last_ship from lineitem
group by 1, 2 having count(*) > 20
""")
def sums_having(spark, d):
    """A01 + A02: grouped sums of several metrics with a HAVING."""
    return sum_metrics(Tables(spark, d).lineitem, ["l_suppkey", "l_returnflag"], {
        "lines": F.sum("l_linenumber"), "last_ship": F.max("l_shipdate"), "__n": F.count(F.lit(1))},
        F.col("__n") > 20).drop("__n")


@register("route_reports", """
select o_orderkey, case o_orderpriority when '1-URGENT' then 'sponsored_products.search_term'
       when '2-HIGH' then 'sponsored_brands.campaign' when '3-MEDIUM' then 'sponsored_display.targeting_matched_asin' end as table_name
from orders
""")
def route_reports(spark, d):
    """S11 + S10: the target table of each landed report by its file name; unknown reports have none."""
    names = F.create_map(*[F.lit(x) for x in (
        "1-URGENT", "SPONSORED_PRODUCTS (a-US) spSearchTerm ['searchTerm'] 2024-01-01.json.gz",
        "2-HIGH", "SPONSORED_BRANDS (a-US) sbCampaigns ['campaign'] 2024-01-01.json.gz",
        "3-MEDIUM", "SPONSORED_DISPLAY (a-US) sdTargeting ['targeting', 'matchedTarget'] 2024-01-01.json.gz")])
    o = Tables(spark, d).orders
    named = o.select("o_orderkey", F.coalesce(F.try_element_at(names, F.col("o_orderpriority")), F.lit("other.csv")).alias("f"))
    parts = name_parts(F.col("f"), REPORT_NAME, ["ad_product", "_country", "report_type", "group_by"])
    return route(named.withColumns(parts), spark).select("o_orderkey", "table_name")


@register("tenant_lookup", """
select o.o_orderkey, c.c_nationkey as tenant_id from orders o left join customer c on o.o_custkey = c.c_custkey
""")
def tenant_lookup(spark, d):
    """Company name → tenant id."""
    t = Tables(spark, d)
    tenants = t.customer.select(F.col("c_custkey").cast("string").alias("company"), F.col("c_nationkey").alias("tenant_id"))
    facts = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("company"))
    return _tenant_lookup(facts, tenants).select("o_orderkey", "tenant_id")


@register("tenant_sql", """
select c_custkey, c_acctbal from customer where c_nationkey = 3 and c_mktsegment = 'BUILDING'
""")
def tenant_sql(spark, d):
    """S08 + S17 + P17 + F01: a stored table scanned with its filter, named as a view, queried with
    bound parameters."""
    path = scratch_path(spark, "customer-table")
    Tables(spark, d).customer.write.parquet(path)
    view = f"customers_{abs(hash(path))}"
    register_view(read_table(spark, path, ["c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"], "c_mktsegment = 'BUILDING'"), view)
    return sql(spark, f"select c_custkey, c_acctbal from {view} where c_nationkey = :tenant", tenant=3)


@register("mart_planning_inventory", """
select 2 as tenant_id, date '2024-01-01' + p_size as snapshot_date, p_type as marketplace, cast(p_partkey as varchar) as sku, p_size as available
from part where p_size % 4 = 2
""")
def mart_planning_inventory(spark, d):
    """C01 ``marts.fba_planning_inventory`` for one tenant."""
    p = Tables(spark, d).part
    df = p.select((F.col("p_size") % 4).alias("tenant_id"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).alias("snapshot_date"),
                  F.col("p_type").alias("marketplace"), F.col("p_partkey").cast("string").alias("sku"), F.col("p_size").alias("available"))
    return marts.fba_planning_inventory({"inventory.fba_planning_inventory": df}, tenant_id=2, ordered=True)


@register("mart_awd_inventory", """
select 1 as tenant_id, cast(o_orderdate as date) as date, cast(o_orderkey as varchar) as sku, o_totalprice as on_hand from orders
""")
def mart_awd_inventory(spark, d):
    """C13 ``marts.awd_inventory``."""
    o = Tables(spark, d).orders.select(F.lit(1).alias("tenant_id"), F.to_date("o_orderdate").alias("date"),
                                       F.col("o_orderkey").cast("string").alias("sku"), F.col("o_totalprice").alias("on_hand"))
    return marts.awd_inventory({"awd.inventory": o}, tenant_id=1)
