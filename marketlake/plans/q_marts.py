"""Mart-shaped queries (C04, C09–C11, C14, C15, C16 patterns) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.functions import allocate, money, product_code, ratio
from marketlake.functions.dates import local_date, within_age
from marketlake.operators.aggregates import null_audit as _null_audit
from marketlake.operators.aggregates import pivot, value_counts as _value_counts
from marketlake.operators.dedupe import latest_per_key, latest_values
from marketlake.operators.joins import full_join_coalesced, left_join_aggregated, with_children
from marketlake.operators.setops import pad_to, union_all, union_distinct
from marketlake.plans.registry import register
from marketlake.plans.tables import Tables, ts

# ---------------------------------------------------------------- C04 / entry
ADS_DAILY_SPEND_SQL = """
with latest as (select l_partkey, l_suppkey from (
    select l_partkey, l_suppkey, row_number() over (partition by l_partkey
           order by l_shipdate desc nulls first, l_orderkey desc, l_linenumber desc, l_suppkey desc) as rn
    from lineitem) t where rn = 1)
select cast(f.l_shipdate as date) as spend_date, f.l_returnflag as marketplace, s.s_name as portfolio_name,
       case when s.s_name like '%#%' then split_part(s.s_name, '#', 1) end as product_code,
       cast(sum(cast(f.l_extendedprice as decimal(18,2))) as double) as total_cost,
       cast(sum(cast(f.l_quantity as bigint)) as bigint) as total_clicks
from lineitem f left join latest d on f.l_partkey = d.l_partkey left join supplier s on d.l_suppkey = s.s_suppkey
where f.l_returnflag = 'R' and f.l_shipdate >= timestamp '1998-01-01 00:00:00'
group by cast(f.l_shipdate as date), f.l_returnflag, s.s_name having sum(cast(f.l_quantity as bigint)) > 0
union
select cast(o.o_orderdate as date), 'R', o.o_orderpriority,
       case when o.o_orderpriority like '%-%' then split_part(o.o_orderpriority, '-', 1) end,
       cast(sum(cast(o.o_totalprice as decimal(18,2))) as double), cast(count(o.o_orderkey) as bigint)
from orders o where o.o_orderdate < timestamp '1998-01-01 00:00:00'
group by cast(o.o_orderdate as date), o.o_orderpriority
"""

SPEND_COLS = ["spend_date", "marketplace", "portfolio_name", "product_code", "total_cost", "total_clicks"]


def ads_daily_spend_frame(lineitem, supplier, orders, cutoff: str = "1998-01-01 00:00:00"):
    """W02 + J02 + X01 + A01 + A02 + U01: daily spend per portfolio from the API
    facts (latest supplier per part as the portfolio dimension) UNION the console
    history before the cut-over date."""
    latest = latest_values(lineitem, ["l_partkey"], ["l_shipdate desc nulls first", "l_orderkey desc",
                                                     "l_linenumber desc", "l_suppkey desc"], ["l_suppkey"], ties=[])
    dim = latest.select("l_partkey", F.col("l_suppkey").alias("d_suppkey"))
    facts = lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_shipdate") >= ts(cutoff)))
    j = (facts.join(dim, "l_partkey", "left")
              .join(supplier.select("s_suppkey", "s_name"), F.col("d_suppkey") == F.col("s_suppkey"), "left"))
    api = (j.groupBy(F.to_date("l_shipdate").alias("spend_date"), F.col("l_returnflag").alias("marketplace"),
                     F.col("s_name").alias("portfolio_name"))
            .agg(F.sum(money("l_extendedprice")).cast("double").alias("total_cost"),
                 F.sum(F.col("l_quantity").cast("bigint")).cast("bigint").alias("total_clicks"))
            .where(F.col("total_clicks") > 0)
            .withColumn("product_code", product_code("portfolio_name", "#")))
    console = (orders.where(F.col("o_orderdate") < ts(cutoff))
               .groupBy(F.to_date("o_orderdate").alias("spend_date"), F.lit("R").alias("marketplace"),
                        F.col("o_orderpriority").alias("portfolio_name"))
               .agg(F.sum(money("o_totalprice")).cast("double").alias("total_cost"),
                    F.count("o_orderkey").cast("bigint").alias("total_clicks"))
               .withColumn("product_code", product_code("portfolio_name", "-")))
    # SQL UNION.  Each branch is already unique on its grouping keys, and the branches
    # are split by spend_date at the cut-over (API >= cutoff, console < cutoff), so no
    # row can occur in both: UNION ALL gives the same rows without the distinct's
    # extra shuffle.
    return union_all(api.select(*SPEND_COLS), console.select(*SPEND_COLS))


@register("ads_daily_spend", ADS_DAILY_SPEND_SQL)
def ads_daily_spend(spark, d):
    t = Tables(spark, d)
    return ads_daily_spend_frame(t.lineitem, t.supplier, t.orders)


# ---------------------------------------------------------------- C10
@register("orders_summary", """
select cast(o.o_orderdate as date) as order_date, o.o_orderstatus as order_status, l.l_partkey as asin,
       cast(sum(cast(l.l_quantity as decimal(18,2))) as double) as units,
       cast(count(l.l_orderkey) as bigint) as items
from orders o left join lineitem l on o.o_orderkey = l.l_orderkey
group by cast(o.o_orderdate as date), o.o_orderstatus, l.l_partkey
""")
def orders_summary(spark, d):
    """J01 + A05: orders ⟕ items, grouped by the order's date (a cast expression).

    The left join is written as ``items ⋈ orders ∪ orders ▷ items`` (``with_children``)
    so AQE can split a hot order on the items side.  Measured at sf0.1: +0.4 s over
    the plain left join; pre-aggregating items per (order, product) instead cost
    +1.3 s, because those pairs are nearly unique here."""
    t = Tables(spark, d)
    j = with_children(t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus"),
                      t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"), ["o_orderkey"], ["l_orderkey"])
    return (j.groupBy(F.to_date("o_orderdate").alias("order_date"), F.col("o_orderstatus").alias("order_status"),
                      F.col("l_partkey").alias("asin"))
             .agg(F.sum(money("l_quantity")).cast("double").alias("units"),
                  F.count("l_orderkey").cast("bigint").alias("items")))


# ---------------------------------------------------------------- C09
@register("order_lines_priced", """
with latest as (
  select l_partkey, l_returnflag, l_extendedprice / l_quantity as unit_price from (
    select *, row_number() over (partition by l_partkey, l_returnflag
           order by l_shipdate desc nulls first, l_orderkey desc, l_linenumber desc,
                    l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus) as rn
    from lineitem) t where rn = 1),
lines as (
  select o.o_orderkey, o.o_orderdate, o.o_orderstatus, l.l_linenumber, l.l_partkey, l.l_returnflag, l.l_quantity,
         case when l.l_discount = 0.10 then null else l.l_extendedprice end as item_price_amount
  from orders o left join lineitem l on o.o_orderkey = l.l_orderkey)
select x.o_orderkey as order_id, x.l_linenumber as line_no, x.l_partkey as asin,
       cast(x.o_orderdate - interval 7 hour as date) as purchase_date_pdt,
       case when x.item_price_amount is null and x.o_orderstatus <> 'P' then p.unit_price * x.l_quantity
            else x.item_price_amount end as item_price,
       (x.item_price_amount is null and x.o_orderstatus <> 'P') as price_from_fallback
from lines x left join latest p on x.l_partkey = p.l_partkey and x.l_returnflag = p.l_returnflag
""")
def order_lines_priced(spark, d):
    """J01 + J03 + M06 + D01: order lines with a price fallback from the latest
    listing price of the same (product, marketplace); date at fixed −07:00."""
    t = Tables(spark, d)
    li = t.lineitem
    listing = latest_per_key(li, ["l_partkey", "l_returnflag"],
                             ["l_shipdate desc nulls first", "l_orderkey desc", "l_linenumber desc"],
                             ties=["l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                   "l_linestatus"])
    listing = listing.select(F.col("l_partkey").alias("p_key"), F.col("l_returnflag").alias("p_flag"),
                             (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"))
    lines = (with_children(t.orders, li, ["o_orderkey"], ["l_orderkey"])
             .withColumn("item_price_amount",
                         F.when(F.col("l_discount") == 0.10, F.lit(None)).otherwise(F.col("l_extendedprice"))))
    j = lines.join(listing, (F.col("l_partkey") == F.col("p_key")) & (F.col("l_returnflag") == F.col("p_flag")),
                   "left")
    fallback = F.col("item_price_amount").isNull() & (F.col("o_orderstatus") != "P")
    return j.select(F.col("o_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                    F.col("l_partkey").alias("asin"), local_date("o_orderdate", "-07:00").alias("purchase_date_pdt"),
                    F.when(fallback, F.col("unit_price") * F.col("l_quantity"))
                     .otherwise(F.col("item_price_amount")).alias("item_price"),
                    fallback.alias("price_from_fallback"))


# ---------------------------------------------------------------- C11
@register("shipments_report", """
select o.o_orderkey as shipment_id, o.o_orderstatus as shipment_status, o.o_orderpriority as ship_from,
       cast(o.o_orderdate as date) as ship_date, a.sku_count, a.quantity_shipped
from orders o left join (
    select l_orderkey, cast(count(l_partkey) as bigint) as sku_count,
           cast(sum(cast(l_quantity as decimal(18,2))) as double) as quantity_shipped
    from lineitem group by l_orderkey) a on o.o_orderkey = a.l_orderkey
union
select s_suppkey, cast(null as varchar), s_name, cast(null as date), cast(null as bigint), cast(null as double)
from supplier
""")
def shipments_report(spark, d):
    """J04 + U01 + U02: shipments with items aggregated per shipment *before* the
    join, UNION warehouse rows padded with typed NULLs."""
    t = Tables(spark, d)
    items = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    ship = left_join_aggregated(t.orders, items, ["o_orderkey"],
                                [F.count("l_partkey").cast("bigint").alias("sku_count"),
                                 F.sum(money("l_quantity")).cast("double").alias("quantity_shipped")])
    ship = ship.select(F.col("o_orderkey").alias("shipment_id"), F.col("o_orderstatus").alias("shipment_status"),
                       F.col("o_orderpriority").alias("ship_from"), F.to_date("o_orderdate").alias("ship_date"),
                       "sku_count", "quantity_shipped")
    wh = t.supplier.select(F.col("s_suppkey").alias("shipment_id"), F.col("s_name").alias("ship_from"))
    return union_distinct(ship, pad_to(wh, ship.schema))


# ---------------------------------------------------------------- C14
@register("fee_preview", """
select p_partkey as sku, p_brand as brand, p_retailprice as your_price,
       p_retailprice * 0.15 as estimated_referral_fee_per_unit,
       (p_retailprice * 0.15) / nullif(p_retailprice, 0) as referral_fee_ratio,
       cast(null as bigint) as available
from part where exists (select 1 from lineitem where l_partkey = p_partkey)
union
select p_partkey, p_brand, cast(null as double), cast(null as double), cast(null as double), cast(0 as bigint)
from part where not exists (select 1 from lineitem where l_partkey = p_partkey)
""")
def fee_preview(spark, d):
    """M05 + U01 + U02: fee ratio for listed products UNION zero-stock products padded."""
    t = Tables(spark, d)
    sold = t.lineitem.select(F.col("l_partkey").alias("p_partkey")).distinct()
    listed = t.part.join(sold, "p_partkey", "left_semi")
    fee = F.col("p_retailprice") * F.lit(0.15)
    a = listed.select(F.col("p_partkey").alias("sku"), F.col("p_brand").alias("brand"),
                      F.col("p_retailprice").alias("your_price"), fee.alias("estimated_referral_fee_per_unit"),
                      ratio(fee, "p_retailprice").alias("referral_fee_ratio"),
                      F.lit(None).cast("bigint").alias("available"))
    zero = t.part.join(sold, "p_partkey", "left_anti").select(
        F.col("p_partkey").alias("sku"), F.col("p_brand").alias("brand"), F.lit(0).cast("bigint").alias("available"))
    return union_distinct(a, pad_to(zero, a.schema))


# ---------------------------------------------------------------- C03
@register("business_report_ratios", """
select l_orderkey, l_linenumber, l_quantity / 100.0 as quantity_ratio, l_discount / 100.0 as discount_ratio,
       l_tax / 100.0 as tax_ratio
from lineitem
""")
def business_report_ratios(spark, d):
    """Percentage columns divided by 100."""
    from marketlake.operators.shape import percent_to_ratio
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity_ratio"),
                                          F.col("l_discount").alias("discount_ratio"), F.col("l_tax").alias("tax_ratio"))
    return percent_to_ratio(li, ["quantity_ratio", "discount_ratio", "tax_ratio"])


# ---------------------------------------------------------------- C02
@register("fresh_inventory", """
select event_id, user_id, event_type, ts from events
where ts is not null and ts > timestamp '2024-01-21 00:00:00'
""")
def fresh_inventory(spark, d):
    """``(date − last_updated) < 10 days``; future timestamps (negative age) pass."""
    e = Tables(spark, d).events
    return e.where(within_age(F.lit("2024-01-31").cast("date"), "ts", 10)).select("event_id", "user_id",
                                                                                    "event_type", "ts")


# ---------------------------------------------------------------- C15
@register("keyword_opportunity", """
with v as (select user_id, cast(count(*) as bigint) as impressions, max(ts) as last_view
           from events where event_type = 'view' group by user_id),
     c as (select user_id, cast(count(*) as bigint) as clicks,
                  cast(sum(cast(value as decimal(18,2))) as double) as click_value
           from events where event_type = 'click' group by user_id),
     p as (select user_id, cast(count(*) as bigint) as purchases
           from events where event_type = 'purchase' group by user_id)
select coalesce(vc.user_id, p.user_id) as user_id, vc.impressions, vc.last_view, vc.clicks, vc.click_value,
       p.purchases,
       cast(vc.clicks as double) / nullif(cast(vc.impressions as double), 0) as ctr,
       coalesce(cast(p.purchases as double) / nullif(cast(vc.clicks as double), 0), 0) as cvr
from (select coalesce(v.user_id, c.user_id) as user_id, v.impressions, v.last_view, c.clicks, c.click_value
      from v full join c on v.user_id = c.user_id) vc
full join p on vc.user_id = p.user_id
""")
def keyword_opportunity(spark, d):
    """A03 + J06 + M01 + M02: per-key aggregates of two sources, full outer joined
    on a coalesced key, with CTR and CVR (zero-safe)."""
    e = Tables(spark, d).events
    v = e.where(F.col("event_type") == "view").groupBy("user_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("impressions"), F.max("ts").alias("last_view"))
    c = e.where(F.col("event_type") == "click").groupBy("user_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("clicks"), F.sum(money("value")).cast("double").alias("click_value"))
    p = e.where(F.col("event_type") == "purchase").groupBy("user_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("purchases"))
    j = full_join_coalesced(full_join_coalesced(v, c, ["user_id"], True), p, ["user_id"], unique_keys=True)
    return j.select("user_id", "impressions", "last_view", "clicks", "click_value", "purchases",
                    ratio("clicks", "impressions").alias("ctr"), ratio("purchases", "clicks", 0.0).alias("cvr"))


# ---------------------------------------------------------------- C16
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("weekly_pivot", """
select user_id, weekofyear(ts) as week,
       max(value) filter (where event_type = 'click') as click,
       max(value) filter (where event_type = 'error') as error,
       max(value) filter (where event_type = 'purchase') as purchase,
       max(value) filter (where event_type = 'signup') as signup,
       max(value) filter (where event_type = 'view') as "view"
from events group by user_id, weekofyear(ts)
""")
def weekly_pivot(spark, d):
    """A10: crosstab rows = (user, ISO week), one column per event type, max per cell."""
    e = Tables(spark, d).events.withColumn("week", F.weekofyear("ts"))
    return pivot(e, ["user_id", "week"], "event_type", "value", EVENT_TYPES, "max")


@register("order_by_hidden_agg", """
select user_id from events group by user_id order by sum(value) desc, user_id
""")
def order_by_hidden_agg(spark, d):
    """ORDER BY an aggregate that is not selected."""
    e = Tables(spark, d).events
    return (e.groupBy("user_id").agg(F.sum("value").alias("__s"))
             .orderBy(F.col("__s").desc(), "user_id").select("user_id"))


@register("value_counts", """
select event_type, cast(count(*) as bigint) as "count" from events group by event_type
""")
def value_counts(spark, d):
    """A11."""
    return _value_counts(Tables(spark, d).events, ["event_type"])


@register("null_audit", """
select cast(count(*) as bigint) as "rows",
       cast(sum(case when nullif(event_type, 'error') is null then 1 else 0 end) as bigint) as null_event_type,
       cast(sum(case when value is null then 1 else 0 end) as bigint) as null_value,
       cast(sum(case when props is null then 1 else 0 end) as bigint) as null_props
from events
""")
def null_audit(spark, d):
    """NULL count per column (error events read as missing types)."""
    e = Tables(spark, d).events.select(F.nullif("event_type", F.lit("error")).alias("event_type"), "value", "props")
    return _null_audit(e)


# ---------------------------------------------------------------- M04
@register("allocate_impressions", """
select l.l_orderkey, l.l_linenumber, l.l_partkey,
       round_even(l.l_extendedprice / nullif(o.o_totalprice, 0) * 1000, 0) as impressions
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
""")
def allocate_impressions(spark, d):
    """``round_half_even(cost / total_spend * total_impressions)``."""
    t = Tables(spark, d)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return j.select("l_orderkey", "l_linenumber", "l_partkey",
                    allocate("l_extendedprice", "o_totalprice", F.lit(1000)).alias("impressions"))


# ---------------------------------------------------------------- U01
@register("union_two_sources", """
select user_id, event_type, cast(ts as date) as event_date from events where ts < timestamp '2024-01-20 00:00:00'
union
select user_id, event_type, cast(ts as date) from events where ts >= timestamp '2024-01-10 00:00:00'
""")
def union_two_sources(spark, d):
    """API branch ∪ history branch with overlapping rows (distinct)."""
    e = Tables(spark, d).events
    cols = [F.col("user_id"), F.col("event_type"), F.to_date("ts").alias("event_date")]
    return union_distinct(e.where(F.col("ts") < ts("2024-01-20 00:00:00")).select(*cols),
                          e.where(F.col("ts") >= ts("2024-01-10 00:00:00")).select(*cols))
