"""Shaping and cleaning queries: raw-looking text is derived from the driver
tables inside the query, then cleaned back with the library's Column functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import functions as mf
from marketlake.functions.text import PLACEMENT_LABELS, PREDEFINED_TARGETING
from marketlake.operators.joins import cleaned_key_join as _ckj
from marketlake.operators.dedupe import latest_per_key
from marketlake.operators import names as nm
from marketlake.operators.setops import union_by_name as _ubn
from marketlake.operators.shape import conform as _conform, flatten, last_of_list, null_tokens as _null_tokens
from marketlake.operators.shape import reposition as _reposition
from marketlake.plans.registry import register
from marketlake.plans.tables import Tables


@register("flatten_structs", """
select o.o_orderkey as order_id, c.c_name as order_buyer_name, c.c_mktsegment as order_buyer_segment,
       n.n_name as order_buyer_address_country, o.o_totalprice as order_total_amount
from orders o left join customer c on o.o_custkey = c.c_custkey left join nation n on c.c_nationkey = n.n_nationkey
""")
def flatten_structs(spark, d):
    """A nested order payload (struct in struct) flattened to ``a_b_c`` columns."""
    t = Tables(spark, d)
    j = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
         .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    nested = j.select(
        F.struct(F.col("o_orderkey").alias("id"),
                 F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                          F.struct(F.col("n_name").alias("country")).alias("address")).alias("buyer"),
                 F.struct(F.col("o_totalprice").alias("amount")).alias("total")).alias("order"))
    return flatten(nested)


@register("list_last_value", """
select l_orderkey, l_linenumber,
       coalesce(case when l_tax > 0.04 then l_tax end, case when l_discount > 0.05 then l_discount end,
                l_quantity) as adj_amount,
       case when l_linenumber % 2 = 0 then 'tax' else 'discount' end as adj_code
from lineitem
""")
def list_last_value(spark, d):
    """For a list of records, ``list_field`` = the field of the last element
    that has it."""
    li = Tables(spark, d).lineitem
    def rec(code, amount):
        return F.struct(amount.cast("double").alias("amount"), code.alias("code"))

    adj = F.array(rec(F.lit("quantity"), F.col("l_quantity")),
                  rec(F.lit("discount"), F.when(F.col("l_discount") > 0.05, F.col("l_discount"))),
                  rec(F.when(F.col("l_linenumber") % 2 == 0, "tax"), F.when(F.col("l_tax") > 0.04, F.col("l_tax"))))
    x = li.select("l_orderkey", "l_linenumber", adj.alias("adj"))
    # per field: the last amount and the last code may come from different elements
    return last_of_list(x)


@register("normalise_names", """
select o_orderkey as amazon_order_id, o_totalprice as order_total_amount_b2b, o_orderstatus as seller_sku,
       o_orderdate as units_sold_clicks_7d, o_orderpriority as video_5_second_views, o_custkey as e_cpa_dd_to_cart
from orders
""")
def normalise_names(spark, d):
    """Report headers / camelCase → snake_case."""
    o = Tables(spark, d).orders.select(F.col("o_orderkey").alias("AmazonOrderId"),
                                       F.col("o_totalprice").alias("OrderTotal.AmountB2B"),
                                       F.col("o_orderstatus").alias("SellerSKU"),
                                       F.col("o_orderdate").alias("unitsSoldClicks7d"),
                                       F.col("o_orderpriority").alias("video5SecondViews"),
                                       F.col("o_custkey").alias("eCPAddToCart"))
    return nm.normalise_names(o)


@register("reposition", """
select o_orderdate, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders
""")
def reposition(spark, d):
    """Move a column to a position."""
    return _reposition(Tables(spark, d).orders, {"o_orderdate": 0})


_TARGET = T.StructType([
    T.StructField("o_orderkey", T.StringType()), T.StructField("o_totalprice", T.DecimalType(18, 2)),
    T.StructField("o_orderdate", T.DateType()), T.StructField("o_orderpriority", T.StringType()),
    T.StructField("tenant_id", T.IntegerType()), T.StructField("o_custkey", T.LongType())])


@register("conform", """
select cast(o_orderkey as varchar) as o_orderkey, cast(o_totalprice as decimal(18,2)) as o_totalprice,
       cast(o_orderdate as date) as o_orderdate, o_orderpriority, cast(null as integer) as tenant_id,
       o_custkey
from orders
""")
def conform(spark, d):
    """P10: conform a batch to a table schema: casts, missing → NULL, extras dropped."""
    return _conform(Tables(spark, d).orders, _TARGET)


@register("union_by_name", """
select o_orderkey as order_id, o_orderdate as ts, o_totalprice as amount, o_orderstatus as status,
       cast(null as bigint) as line_no
from orders
union all
select l_orderkey, l_shipdate, l_extendedprice, cast(null as varchar), cast(l_linenumber as bigint) from lineitem
""")
def union_by_name(spark, d):
    """Concat by name; columns missing on one side become NULL."""
    t = Tables(spark, d)
    a = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("ts"),
                        F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"))
    b = t.lineitem.select(F.col("l_linenumber").cast("bigint").alias("line_no"), F.col("l_orderkey").alias("order_id"),
                          F.col("l_extendedprice").alias("amount"), F.col("l_shipdate").alias("ts"))
    return _ubn(a, b)


def _raw_customer(t):
    """Customer balances rendered as report text: '--' for negatives, '' for
    small ones, money text otherwise."""
    bal = F.col("c_acctbal")
    text = (F.when(bal < 0, F.lit("--")).when(bal < 100, F.lit("")).otherwise(F.col("c_acctbal").cast("string")))
    return t.customer.select("c_custkey", text.alias("balance"), F.col("c_mktsegment").alias("segment"))


@register("null_tokens", """
select c_custkey, case when c_acctbal < 0 then null when c_acctbal < 100 then null
                       else cast(c_acctbal as double) end as balance, c_mktsegment as segment
from customer
""")
def null_tokens(spark, d):
    """P16: '--', '' (and '-', 'nan') → NULL, then typed."""
    out = _null_tokens(_raw_customer(Tables(spark, d)))
    return out.withColumn("balance", F.col("balance").cast("double"))


@register("clean_money", """
select c_custkey, abs(c_acctbal) as balance_unsigned, c_acctbal as balance_signed from customer
""")
def clean_money(spark, d):
    """X02: '$1,863.84' / '($994.28)' → number (sign dropped, or kept with signed=True)."""
    c = Tables(spark, d).customer
    mag = F.format_number(F.abs("c_acctbal"), 2)
    text = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("($"), mag, F.lit(")"))).otherwise(F.concat(F.lit("$"), mag))
    x = c.select("c_custkey", text.alias("raw"))
    return x.select("c_custkey", mf.clean_money(F.col("raw")).alias("balance_unsigned"),
                    mf.clean_money(F.col("raw"), signed=True).alias("balance_signed"))


@register("clean_numeric", """
select p_partkey, p_retailprice as price, p_size / 100.0 as share from part
""")
def clean_numeric(spark, d):
    """X03/X04: '$1,234.50' → 1234.5, '12%' → 0.12."""
    p = Tables(spark, d).part
    x = p.select("p_partkey", F.concat(F.lit("$"), F.format_number("p_retailprice", 2)).alias("price_text"),
                 F.concat(F.col("p_size").cast("string"), F.lit("%")).alias("share_text"))
    return x.select("p_partkey", mf.clean_number("price_text").alias("price"),
                    mf.clean_number("share_text", percent=True).alias("share"))


@register("bounded_rank", """
select p_partkey, case when p_size > 40 then 40 when p_size < 5 then 5 when p_size = 10 then null
                       else p_size end as organic_rank
from part
""")
def bounded_rank(spark, d):
    """X09: '>40' → 40, '<5' → 5, '-' → NULL."""
    p = Tables(spark, d).part
    s = F.col("p_size")
    text = (F.when(s > 40, F.lit(">40")).when(s < 5, F.lit("<5")).when(s == 10, F.lit("-"))
             .otherwise(s.cast("string")))
    return p.select("p_partkey", mf.bounded_int(text).alias("organic_rank"))


@register("digits_only", """
select c_custkey, nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') as phone,
       nullif(regexp_replace(c_mktsegment, '[^0-9]', '', 'g'), '') as segment_digits
from customer
""")
def digits_only(spark, d):
    """Keep digits; empty → NULL."""
    c = Tables(spark, d).customer
    return c.select("c_custkey", mf.digits_only("c_name").alias("phone"), mf.digits_only("c_mktsegment").alias("segment_digits"))


def _raw_targeting(p):
    s = F.col("p_size")
    predefined = F.element_at(F.array(*[F.lit(x) for x in PREDEFINED_TARGETING]), (s - 19).cast("int"))
    return (F.when(s < 10, F.concat(F.lit("["), F.upper("p_name"), F.lit("]")))
             .when(s < 20, F.concat(F.lit("B0"), F.lower(F.hex(F.col("p_partkey")))))
             .when(s < 24, predefined)
             .otherwise(F.col("p_name")))


_TARGETING_SQL = """
with r as (select p_partkey, p_type, p_size, p_name,
  case when p_size < 10 then '[' || upper(p_name) || ']'
       when p_size < 20 then 'B0' || lower(hex(p_partkey))
       when p_size < 24 then ['close-match', 'loose-match', 'substitutes', 'complements'][p_size - 19]
       else p_name end as raw from part),
c as (select *, case when raw like '[%' then trim(replace(lower(regexp_extract(raw, '^\\[(.*)\\]', 1)), ' ', '-'))
                     when raw like 'B0%' then 'asin="' || upper(raw) || '"'
                     else raw end as targeting from r)
"""


@register("canonical_targeting", _TARGETING_SQL + "select p_partkey, raw, targeting from c")
def canonical_targeting(spark, d):
    """X06: '[Close Match]' → 'close-match'; 'B0…' → 'asin="B0…"'."""
    p = Tables(spark, d).part
    x = p.select("p_partkey", _raw_targeting(p).alias("raw"))
    return x.select("p_partkey", "raw", mf.canonical_targeting("raw").alias("targeting"))


@register("match_type", _TARGETING_SQL + """
select p_partkey, targeting,
       case when targeting like 'asin%' then 'TARGETING_EXPRESSION'
            when targeting in ('close-match', 'loose-match', 'substitutes', 'complements')
                 then 'TARGETING_EXPRESSION_PREDEFINED'
            else upper(p_type) end as match_type
from c
""")
def match_type(spark, d):
    """Match type from the canonical targeting, else the given type upper-cased."""
    p = Tables(spark, d).part
    x = p.select("p_partkey", F.lower("p_type").alias("p_type"), mf.canonical_targeting(_raw_targeting(p)).alias("targeting"))
    return x.select("p_partkey", "targeting", mf.match_type("targeting", "p_type").alias("match_type"))


_LABELS = list(PLACEMENT_LABELS) + ["Amazon Business"]


@register("placement_map", """
with r as (select p_partkey, ['First page Top of Search on Amazon', 'Top of Search', 'Product pages on Amazon',
                              'Product Pages', 'Rest of search on Amazon', 'Rest of Search', 'Search on-Amazon',
                              'Amazon Business'][1 + p_size // 7] as raw from part)
select p_partkey, raw,
       case when raw in ('First page Top of Search on Amazon', 'Top of Search') then 'Top of Search on-Amazon'
            when raw in ('Product pages on Amazon', 'Product Pages') then 'Detail Page on-Amazon'
            when raw in ('Rest of search on Amazon', 'Rest of Search', 'Search on-Amazon') then 'Other on-Amazon'
            else raw end as placement
from r
""")
def placement_map(spark, d):
    """Seven console placement labels → three API labels."""
    p = Tables(spark, d).part
    raw = F.element_at(F.array(*[F.lit(x) for x in _LABELS]), (F.floor(F.col("p_size") / 7) + 1).cast("int"))
    x = p.select("p_partkey", raw.alias("raw"))
    return x.select("p_partkey", "raw", mf.placement_label("raw").alias("placement"))


@register("cleaned_key_join", """
with bulk as (select p_brand || ' |' || p_type || '| ' || cast(p_size as varchar) || '|' as k, min(p_partkey) as campaign_id
              from part group by 1)
select p.p_partkey, p.raw_name, b.campaign_id from (
  select p_partkey, p_brand, p_type, p_size,
         '  ' || p_brand || ' |' || p_type || '| ' || cast(p_size as varchar) || '| ' || p_name
             || ' [' || p_name || '] {ARCHIVE} ' as raw_name from part) p
left join bulk b on b.k = p.p_brand || ' |' || p.p_type || '| ' || cast(p.p_size as varchar) || '|'
""")
def cleaned_key_join(spark, d):
    """X05 + J12 + J13: campaign names cleaned on both sides, the bulk side made
    unique per cleaned key first, then joined."""
    p = Tables(spark, d).part
    seg = F.concat(F.col("p_brand"), F.lit(" |"), F.col("p_type"), F.lit("| "), F.col("p_size").cast("string"),
                   F.lit("|"))
    left = p.select("p_partkey", F.concat(F.lit("  "), seg, F.lit(" "), F.col("p_name"), F.lit(" ["), F.col("p_name"),
                                          F.lit("] {ARCHIVE} ")).alias("raw_name"))
    bulk = p.select(F.concat(seg, F.lit(" "), F.col("p_type")).alias("bulk_name"), F.col("p_partkey").alias("campaign_id"))
    bulk = latest_per_key(bulk.withColumn("__k", mf.campaign_key("bulk_name")), ["__k"], ["campaign_id"], ties=[]) \
        .drop("__k")
    return _ckj(left, bulk, ["raw_name"], mf.campaign_key, ["bulk_name"]).select("p_partkey", "raw_name", "campaign_id")
