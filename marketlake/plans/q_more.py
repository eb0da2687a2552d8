"""More operator queries on the driver tables: predicates (F02–F16), DISTINCT
(A08), text repairs (X11–X15, P14), JSON sums (A15), load guards (G02, G07, G09,
G10), duplicate counts (A12), day bounds (D09), type inference (K08), K04."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketlake import functions as mf
from marketlake.operators import aggregates as ag
from marketlake.operators import dedupe as dd
from marketlake.operators.incremental import newer_than_max as _newer
from marketlake.operators.planning import clamp_retention, weekly_windows as _weekly
from marketlake.plans.registry import register
from marketlake.plans.tables import Tables, ts
from marketlake.sinks.keyed import insert_distinct_on as _ido
from marketlake.sinks.tables import infer_schema


@register("filter_predicates", """
select o_orderkey, o_orderstatus, o_orderpriority, o_orderdate from orders
where o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW')
  and o_orderstatus not in ('P')
  and ((o_orderdate > timestamp '1995-06-01 00:00:00' and o_orderdate < timestamp '1996-01-01 00:00:00')
       or (o_orderdate > timestamp '1999-01-01 00:00:00' and o_orderdate < timestamp '1999-06-01 00:00:00'))
  and o_orderpriority like '%-%' and o_orderpriority not like '%?%'
  and o_totalprice <> 0 and o_orderdate is not null
  and starts_with(o_orderpriority, '1') = false
  and regexp_matches(o_orderpriority, '^2-|^5-')
""")
def filter_predicates(spark, d):
    """F02 IN, F03 NOT IN, F04 OR of open date windows, F09 LIKE / NOT LIKE ('?'
    literal), F14 non-zero guard, F07 IS NOT NULL, F10 prefix, F11 regex."""
    o = Tables(spark, d).orders
    win = lambda a, b: (F.col("o_orderdate") > ts(a)) & (F.col("o_orderdate") < ts(b))
    p = F.col("o_orderpriority")
    cond = (p.isin("1-URGENT", "2-HIGH", "5-LOW") & ~F.col("o_orderstatus").isin("P")
            & (win("1995-06-01 00:00:00", "1996-01-01 00:00:00") | win("1999-01-01 00:00:00", "1999-06-01 00:00:00"))
            & p.like("%-%") & ~p.contains("?") & (F.col("o_totalprice") != 0) & F.col("o_orderdate").isNotNull()
            & ~p.startswith("1") & p.rlike("^2-|^5-"))
    return o.where(cond).select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")


@register("distinct_values", "select distinct o_orderstatus, o_orderpriority from orders")
def distinct_values(spark, d):
    """DISTINCT projection (partial distinct map-side)."""
    return Tables(spark, d).orders.select("o_orderstatus", "o_orderpriority").distinct()


@register("text_repairs", """
select p_partkey,
       lower(trim('  ' || p_type || ' ')) as type_key,
       replace(replace(p_name || '    ' || p_brand || '\\', '    ', ' '), '\\', '(?)') as repaired_query,
       regexp_replace(p_brand, '[^a-zA-Z0-9_]', '', 'g') as brand_word,
       nullif(regexp_extract('x ["' || p_brand || '"] y', '\\["(.*?)"\\]', 1), '') as bracketed,
       right(p_name, 3) as name_tail,
       case when p_size <= 10 then 'USD' when p_size <= 20 then 'GBP' when p_size <= 30 then 'EUR'
            when p_size <= 40 then 'JPY' else null end as currency
from part
""")
def text_repairs(spark, d):
    """X11 trim/lower key, X12 search-query repair, X13 non-word strip, X14 bracketed
    id, X15 last characters, P14 marketplace → currency."""
    p = Tables(spark, d).part
    mk = (F.when(F.col("p_size") <= 10, "US").when(F.col("p_size") <= 20, "UK").when(F.col("p_size") <= 30, "DE")
           .when(F.col("p_size") <= 40, "JP").otherwise("XX"))
    return p.select(
        "p_partkey",
        mf.norm_key(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("type_key"),
        mf.repair_search_query(F.concat(F.col("p_name"), F.lit("    "), F.col("p_brand"), F.lit("\\"))).alias(
            "repaired_query"),
        mf.strip_non_word("p_brand").alias("brand_word"),
        mf.bracketed_id(F.concat(F.lit('x ["'), F.col("p_brand"), F.lit('"] y'))).alias("bracketed"),
        mf.last_chars("p_name", 3).alias("name_tail"),
        mf.currency_code(mk).alias("currency"))


@register("json_int_sum", """
select user_id, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as k_total,
       cast(count(json_extract_string(props, '$.k')) as bigint) as k_count
from events group by user_id
""")
def json_int_sum(spark, d):
    """A15 + A04: sum of integers taken out of JSON payloads; COUNT of non-NULL."""
    e = Tables(spark, d).events.withColumn("k", mf.json_path("props", "$.k").cast("bigint"))
    return e.groupBy("user_id").agg(F.sum("k").cast("bigint").alias("k_total"),
                                    F.count("k").cast("bigint").alias("k_count"))


@register("newer_than_max", """
select * from events
where ts > (select max(ts) from events where ts < timestamp '2024-01-20 00:00:00')
""")
def newer_than_max(spark, d):
    """Rows newer than the stored table's global maximum (scalar subquery)."""
    e = Tables(spark, d).events
    return _newer(e, e.where(F.col("ts") < ts("2024-01-20 00:00:00")), "ts")


@register("duplicate_count", """
select cast(sum(n) as bigint) as "rows", cast(count(*) as bigint) as keys,
       cast(sum(n) - count(*) as bigint) as duplicates
from (select l_orderkey, l_linenumber, count(*) as n from lineitem group by l_orderkey, l_linenumber) t
""")
def duplicate_count(spark, d):
    """Rows, distinct keys and surplus rows of a key."""
    out = ag.duplicate_count(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in out.columns])


@register("latest_load_only", """
select user_id, event_type, value, ts as loaded_at from (
  select *, row_number() over (partition by user_id, event_type order by ts desc nulls last, event_id) as rn
  from events) t where rn = 1
""")
def latest_load_only(spark, d):
    """Of overlapping appends, each key's row from the newest load."""
    e = Tables(spark, d).events.withColumnRenamed("ts", "loaded_at")
    out = dd.latest_load_only(e.select("user_id", "event_type", "value", "loaded_at", "event_id"),
                              ["user_id", "event_type"], "loaded_at")
    return out.select("user_id", "event_type", "value", "loaded_at")


@register("min_max_dates", """
select o_custkey, cast(min(o_orderdate) as date) as first_date, cast(max(o_orderdate) as date) as last_date
from orders group by o_custkey
""")
def min_max_dates(spark, d):
    """First and last date of a date list per key."""
    o = Tables(spark, d).orders
    return o.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("first_date"),
                                      F.to_date(F.max("o_orderdate")).alias("last_date"))


@register("day_bounds", """
select event_id, cast(cast(ts as date) as timestamp) as day_start,
       cast(cast(ts as date) as timestamp) + interval 1 day as next_day_start
from events
""")
def day_bounds(spark, d):
    """Half-open day range of each timestamp."""
    e = Tables(spark, d).events
    start, end = mf.day_bounds("ts")
    return e.select("event_id", start.alias("day_start"), end.alias("next_day_start"))


AS_OF = dt.date(2001, 9, 1)


@register("retention_clamp", """
with s as (select o_custkey,
                  case o_orderstatus when 'F' then 'SPONSORED_PRODUCTS' when 'O' then 'SPONSORED_BRANDS'
                                     else 'SPONSORED_DISPLAY' end as ad_product,
                  cast(min(o_orderdate) as date) as start_date
           from orders group by 1, 2)
select o_custkey, ad_product, start_date,
       greatest(start_date, date '2001-09-01' - cast(case ad_product when 'SPONSORED_PRODUCTS' then 95
                 when 'SPONSORED_BRANDS' then 60 else 65 end as integer)) as clamped_start
from s
""")
def retention_clamp(spark, d):
    """Window starts clamped to each product's data retention."""
    o = Tables(spark, d).orders
    prod = (F.when(F.col("o_orderstatus") == "F", "SPONSORED_PRODUCTS")
             .when(F.col("o_orderstatus") == "O", "SPONSORED_BRANDS").otherwise("SPONSORED_DISPLAY"))
    s = o.groupBy("o_custkey", prod.alias("ad_product")).agg(F.to_date(F.min("o_orderdate")).alias("start_date"))
    return s.withColumn("clamped_start", clamp_retention("start_date", "ad_product", AS_OF))


@register("weekly_windows", """
with b as (select o_orderpriority, cast(min(o_orderdate) as date) as s, cast(max(o_orderdate) as date) as e
           from orders group by 1),
f as (select *, s + cast((6 - isodow(s) + 7) % 7 as integer) as first_end from b)
select o_orderpriority, cast(g.week_end as date) - 6 as week_start, cast(g.week_end as date) as week_end
from f cross join lateral (select unnest(generate_series(f.first_end, greatest(f.first_end, f.e), interval 7 day))
                           as week_end) g
where cast(g.week_end as date) <= f.e
""")
def weekly_windows(spark, d):
    """Sunday–Saturday reporting weeks covering each group's date span."""
    o = Tables(spark, d).orders
    b = o.groupBy("o_orderpriority").agg(F.to_date(F.min("o_orderdate")).alias("s"),
                                         F.to_date(F.max("o_orderdate")).alias("e"))
    return _weekly(b, "s", "e").select("o_orderpriority", "week_start", "week_end")


_KIND = """case when bool_and(regexp_matches({0}, '^[+-]?[0-9]+$')) then 'bigint'
     when bool_and(try_cast({0} as double) is not null) then 'double'
     when bool_and(lower({0}) in ('true', 'false')) then 'boolean'
     when bool_and(date_trunc('day', try_cast({0} as timestamp)) = try_cast({0} as timestamp)) then 'date'
     else 'string' end"""


@register("infer_types", f"""
with x as (select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey,
                  cast(c_acctbal as varchar) as c_acctbal, c_mktsegment,
                  cast((select min(o_orderdate) from orders where o_custkey = c.c_custkey) as varchar) as first_order,
                  case when c_acctbal > 5000 then 'true' else 'false' end as is_big from customer c)
{" union all ".join(f"select '{c}' as column_name, {_KIND.format(c)} as inferred_type from x" for c in (
    "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "first_order", "is_big"))}
""")
def infer_types(spark, d):
    """Column types inferred from text values (one aggregate job over the data)."""
    t = Tables(spark, d)
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    c = t.customer.join(first, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")
    c = c.withColumn("is_big", F.when(F.col("c_acctbal") > 5000, "true").otherwise("false"))
    text = c.select(*[F.col(x).cast("string").alias(x) for x in c.columns])
    schema = infer_schema(text)
    rows = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return spark.createDataFrame(rows, "column_name string, inferred_type string")


# a column's type by rule: all values of one JSON kind, or codes with leading zeros, or numbers
_NESTED_KIND = """select '{0}' as column_name, case
  when bool_and({0} like '{{%' and json_valid({0})) then 'variant'
  when bool_and({0} like '[%' and json_valid({0})) then case
    when bool_and(len(try_cast({0} as json[])) = 0) then 'variant'
    when bool_and(not list_contains([json_type(x) <> 'VARCHAR' for x in try_cast({0} as json[])], true)) then 'array<string>'
    when bool_and(not list_contains([json_type(x) not in ('UBIGINT', 'BIGINT') for x in try_cast({0} as json[])], true)) then 'array<bigint>'
    else 'variant' end
  when bool_or(regexp_matches({0}, '^[+-]?0[0-9]')) then 'string'
  when bool_and(try_cast({0} as bigint) is not null) then 'bigint'
  when bool_and(try_cast({0} as timestamp) is not null) then case when bool_or({0} like '%Z') then 'timestamp' else 'date' end
  else 'string' end as inferred_type from x"""
_NESTED = ("attributes", "sizes", "words", "no_items", "mixed", "code", "number", "half_json", "zoned")


@register("infer_nested_types", f"""
with x as (select '{{"size": ' || p_size || ', "brand": "' || p_brand || '"}}' as attributes,
  case when p_size % 3 = 0 then '[]' else '[' || p_size || ', ' || p_partkey || ']' end as sizes,
  case when p_size % 5 = 0 then '[]' else '["' || p_brand || '"]' end as words, '[]' as no_items,
  '[' || p_size || ', "' || p_brand || '"]' as mixed, lpad(cast(p_partkey as varchar), 9, '0') as code,
  cast(p_partkey as varchar) as number, case when p_size = 1 then '[1' else '[1]' end as half_json,
  '2024-01-' || lpad(cast(1 + p_size % 28 as varchar), 2, '0') || 'T00:00:00Z' as zoned from part)
{" union all ".join(_NESTED_KIND.format(c) for c in _NESTED)}
""")
def infer_nested_types(spark, d):
    """JSON objects, lists of text, of numbers and of both, codes with leading zeros and zoned midnights."""
    p = Tables(spark, d).part
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    q = F.lit('"')
    text = p.select(
        F.concat(F.lit('{"size": '), size, F.lit(', "brand": "'), "p_brand", F.lit('"}')).alias("attributes"),
        F.when(F.col("p_size") % 3 == 0, "[]").otherwise(F.concat(F.lit("["), size, F.lit(", "), key, F.lit("]"))).alias("sizes"),
        F.when(F.col("p_size") % 5 == 0, "[]").otherwise(F.concat(F.lit("["), q, F.col("p_brand"), q, F.lit("]"))).alias("words"),
        F.lit("[]").alias("no_items"), F.concat(F.lit("["), size, F.lit(', "'), "p_brand", F.lit('"]')).alias("mixed"),
        F.lpad(key, 9, "0").alias("code"), key.alias("number"),
        F.when(F.col("p_size") == 1, "[1").otherwise("[1]").alias("half_json"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z")).alias("zoned"))
    rows = [(f.name, f.dataType.simpleString()) for f in infer_schema(text).fields]
    return spark.createDataFrame(rows, "column_name string, inferred_type string")


@register("bulk_merge", """
with o as (select o_orderpriority as category, 'kw' || o_custkey as keyword_phrase, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as volume
           from orders group by 1, 2),
b as (select case c_custkey % 5 when 0 then '1-URGENT' when 1 then '2-HIGH' when 2 then '3-MEDIUM' when 3 then '4-NOT SPECIFIED' end as portfolio,
             'kw' || c_custkey as keyword, c_acctbal from customer where c_custkey % 4 <> 0)
select category, keyword_phrase, volume, portfolio, keyword, c_acctbal as bid
from o full join b on category is not distinct from portfolio and keyword_phrase is not distinct from keyword
""")
def bulk_merge(spark, d):
    """F15 + C15's second step (``marts.keyword_opportunity_with_bulk``): keyword rows of a bulk sheet merged in."""
    from marketlake.plans import marts
    t = Tables(spark, d)
    opportunity = t.orders.groupBy(F.col("o_orderpriority").alias("category"),
                                   F.concat(F.lit("kw"), F.col("o_custkey").cast("string")).alias("keyword_phrase")).agg(
        F.sum(mf.money("o_totalprice")).cast("double").alias("volume"))
    names = F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")])
    bulk = t.customer.select(
        F.when(F.col("c_custkey") % 4 != 0, "Keyword").otherwise("Campaign").alias("Entity"),
        F.try_element_at(names, (F.col("c_custkey") % 5 + 1).cast("int")).alias("Portfolio Name (Informational only)"),
        F.concat(F.lit("kw"), F.col("c_custkey").cast("string")).alias("Keyword Text"), F.col("c_acctbal").alias("Bid"))
    out = marts.keyword_opportunity_with_bulk(opportunity, bulk)
    return out.toDF("category", "keyword_phrase", "volume", "portfolio", "keyword", "bid")


@register("insert_distinct_on", """
with cur as (select * from orders where o_orderdate < timestamp '1998-01-01 00:00:00'),
bat as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from (
          select l.l_orderkey as o_orderkey, o.o_custkey, 'N' as o_orderstatus, l.l_extendedprice as o_totalprice,
                 l.l_shipdate as o_orderdate, o.o_orderpriority,
                 row_number() over (partition by l.l_orderkey order by l.l_shipdate desc nulls first,
                                    l.l_linenumber, l.l_extendedprice) as rn
          from lineitem l join orders o on o.o_orderkey = l.l_orderkey) t where rn = 1)
select * from cur
union all
select * from bat b where not exists (select 1 from cur c where c.o_orderkey = b.o_orderkey)
""")
def insert_distinct_on(spark, d):
    """``INSERT … SELECT DISTINCT ON (key)`` ignoring stored keys."""
    t = Tables(spark, d)
    cur = t.orders.where(F.col("o_orderdate") < ts("1998-01-01 00:00:00"))
    b = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"),
                        F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    b = b.select("o_orderkey", "o_custkey", F.lit("N").alias("o_orderstatus"),
                 F.col("l_extendedprice").alias("o_totalprice"), F.col("l_shipdate").alias("o_orderdate"),
                 "o_orderpriority", "l_linenumber")
    b = dd.dedupe(b, ["o_orderkey"], ["o_orderdate desc", "l_linenumber", "o_totalprice"], keep="first",
                  ties=[]).drop("l_linenumber")
    return _ido(cur, b, ["o_orderkey"], ["o_orderkey"])


@register("full_join_hot_key", """
with l as (select o_orderkey, case when o_orderpriority = '5-LOW' then null when o_orderkey % 3 = 0 then 1 else o_custkey end as custkey,
                  o_totalprice from orders),
r as (select nullif(c_custkey, 7) as custkey, c_name from customer where c_custkey % 5 <> 0 or c_custkey = 5)
select coalesce(l.custkey, r.custkey) as custkey, o_orderkey, o_totalprice, c_name from l full join r on l.custkey = r.custkey
""")
def full_join_hot_key(spark, d):
    """Full outer join in which one key has a third of one side's rows, and both sides have NULL keys."""
    from marketlake.operators.joins import full_join_coalesced
    t = Tables(spark, d)
    key = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey"))
    left = t.orders.select("o_orderkey", key.cast("bigint").alias("custkey"), "o_totalprice")
    right = t.customer.where("c_custkey % 5 <> 0 or c_custkey = 5").select(
        F.nullif("c_custkey", F.lit(7)).cast("bigint").alias("custkey"), "c_name")
    return full_join_coalesced(left, right, ["custkey"])


@register("null_safe_outer_merge", """
with l as (select c_nationkey as nation, nullif(c_mktsegment, 'BUILDING') as segment,
                  cast(count(*) as bigint) as customers
           from customer group by 1, 2),
r as (select s_nationkey as nation2, case when s_acctbal < 0 then null else 'AUTOMOBILE' end as segment2,
             cast(count(*) as bigint) as suppliers
      from supplier group by 1, 2)
select * from l full join r on l.nation is not distinct from r.nation2 and l.segment is not distinct from r.segment2
""")
def null_safe_outer_merge(spark, d):
    """Outer merge on differently named keys where NULL matches NULL (pandas)."""
    from marketlake.operators.joins import outer_merge
    t = Tables(spark, d)
    left = t.customer.groupBy(F.col("c_nationkey").alias("nation"),
                              F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")).agg(
        F.count(F.lit(1)).cast("bigint").alias("customers"))
    right = t.supplier.groupBy(F.col("s_nationkey").alias("nation2"),
                               F.when(F.col("s_acctbal") >= 0, F.lit("AUTOMOBILE")).alias("segment2")).agg(
        F.count(F.lit(1)).cast("bigint").alias("suppliers"))
    return outer_merge(left, right, ["nation", "segment"], ["nation2", "segment2"])


@register("map_lookup", """
select s.s_suppkey, m.c_name as nation_customer
from supplier s left join (select c_nationkey, min(c_name) as c_name from customer group by c_nationkey) m
  on s.s_nationkey = m.c_nationkey
""")
def map_lookup(spark, d):
    """``series.map(mapping)`` against a mapping with many values per key
    (made unique first, so no fan-out)."""
    from marketlake.operators.joins import map_lookup as _ml
    t = Tables(spark, d)
    out = _ml(t.supplier, "s_nationkey", t.customer, "c_nationkey", "c_name", out="nation_customer")
    return out.select("s_suppkey", "nation_customer")


@register("array_predicates", """
with a as (select c_custkey,
                  case when c_acctbal < 0 then null
                       else [c_mktsegment, case when c_acctbal > 5000 then 'RICH' else 'PLAIN' end] end as tags,
                  case when c_acctbal > 5000 then '[{"k": 1}]' else '[]' end as payload
           from customer)
select c_custkey, list_has_all(tags, ['BUILDING', 'RICH']) as building_and_rich,
       coalesce(json_array_length(payload), 0) > 0 as has_payload
from a
""")
def array_predicates(spark, d):
    """F12 array contains all (NULL array → NULL) and F13 JSON array not empty."""
    c = Tables(spark, d).customer
    tags = F.when(F.col("c_acctbal") >= 0, F.array(F.col("c_mktsegment"),
                                                   F.when(F.col("c_acctbal") > 5000, "RICH").otherwise("PLAIN")))
    payload = F.when(F.col("c_acctbal") > 5000, F.lit('[{"k": 1}]')).otherwise(F.lit("[]"))
    x = c.select("c_custkey", tags.alias("tags"), payload.alias("payload"))
    return x.select("c_custkey", mf.contains_all("tags", ["BUILDING", "RICH"]).alias("building_and_rich"),
                    mf.json_nonempty("payload").alias("has_payload"))


@register("prefixed_columns", """
select event_id as event_id, user_id as user_id, event_type as event_type, 'US' as marketplace,
       cast(1 as integer) as tenant_id, coalesce(nullif(event_type, 'error'), 'unknown') as event_kind
from events
""")
def prefixed_columns(spark, d):
    """P08 strip a name prefix, P09 keep columns up to a name, P11 provenance
    literals, P15 NULL defaults."""
    from marketlake.operators.names import select_until, strip_prefix
    from marketlake.operators.shape import fill_defaults, tag
    e = Tables(spark, d).events
    raw = e.select(*[F.col(c).alias(f"inventoryDetails_{c}") for c in ("event_id", "user_id", "event_type", "ts")])
    x = select_until(strip_prefix(raw, "inventoryDetails_"), "event_type")
    x = x.withColumn("event_kind", F.nullif("event_type", F.lit("error")))
    x = fill_defaults(tag(x, marketplace="US", tenant_id=F.lit(1).cast("int")), {"event_kind": "unknown"})
    return x


@register("long_dates", """
select o_orderkey, cast(o_orderdate as date) as order_date from orders
""")
def long_dates(spark, d):
    """D08: 'January 5, 1998' style dates parsed back."""
    o = Tables(spark, d).orders
    return o.select("o_orderkey", mf.long_date(F.date_format("o_orderdate", "MMMM d, yyyy")).alias("order_date"))


@register("share_ratios", """
with c as (select o.o_custkey, cast(count(l.l_orderkey) as bigint) as lines, cast(count(distinct o.o_orderkey) as bigint)
                  as orders
           from orders o join lineitem l on o.o_orderkey = l.l_orderkey group by o.o_custkey)
select o_custkey, lines, orders, lines // nullif(orders, 0) as lines_per_order_int,
       cast(lines as double) / nullif(cast(orders as double), 0) as lines_per_order
from c
""")
def share_ratios(spark, d):
    """M03 legacy integer division next to the true ratio."""
    t = Tables(spark, d)
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.count("l_orderkey").alias("n"))
    j = t.orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "inner")
    c = j.groupBy("o_custkey").agg(F.sum("n").cast("bigint").alias("lines"),
                                   F.count(F.lit(1)).cast("bigint").alias("orders"))
    return c.select("o_custkey", "lines", "orders", mf.int_ratio("lines", "orders").alias("lines_per_order_int"),
                    mf.ratio("lines", "orders").alias("lines_per_order"))


@register("nested_lists", """
select l_orderkey, l_linenumber, l_orderkey + l_partkey + l_suppkey as key_sum,
       '[' || l_orderkey || ',' || l_partkey || ',' || l_suppkey || ']' as keys_json
from lineitem
""")
def nested_lists(spark, d):
    """N10 flatten a list of lists, A15 sum over it, N07 JSON dump."""
    li = Tables(spark, d).lineitem
    nested = F.array(F.array("l_orderkey"), F.array("l_partkey", "l_suppkey"))
    flat = mf.flatten_lists(nested)
    return li.select("l_orderkey", "l_linenumber", mf.sum_ints(flat).alias("key_sum"),
                     F.to_json(flat).alias("keys_json"))
