"""Row-selection, de-duplication, join and nested-value queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.functions import first_of, json_path as _json_path, last_matches
from marketlake.operators import dedupe as dd
from marketlake.operators.joins import missing_children as _missing, not_in, orphans as _orphans
from marketlake.operators.sequence import carry_down, request_batches as _batches
from marketlake.plans.registry import register
from marketlake.plans.tables import Tables, ts

LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("latest_snapshot", """
select * from events where cast(ts as date) = (select max(cast(ts as date)) from events)
""")
def latest_snapshot(spark, d):
    """rows of the latest snapshot date (scalar subquery)."""
    e = Tables(spark, d).events
    return dd.latest_snapshot(e.withColumn("__d", F.to_date("ts")), "__d").drop("__d")


@register("latest_per_key", """
select event_id, ts, user_id, event_type, value, props from (
  select *, row_number() over (partition by user_id order by ts desc nulls first, event_id desc) as rn
  from events) t where rn = 1
""")
def latest_per_key(spark, d):
    """``DISTINCT ON (user_id) … ORDER BY user_id, ts DESC`` (NULLs first)."""
    return dd.latest_per_key(Tables(spark, d).events, ["user_id"], ["ts desc", "event_id desc"], ties=[])


_DEDUPE_SQL = """
select {cols} from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
         order by {order}) as rn
  from lineitem) t where rn = 1
"""
_FIRST = ("l_shipdate asc nulls last, l_partkey asc nulls first, l_suppkey asc nulls first, "
          "l_quantity asc nulls first, l_extendedprice asc nulls first, l_discount asc nulls first, "
          "l_tax asc nulls first, l_returnflag asc nulls first, l_linestatus asc nulls first")
_LAST = ("l_shipdate desc nulls first, l_partkey desc nulls last, l_suppkey desc nulls last, "
         "l_quantity desc nulls last, l_extendedprice desc nulls last, l_discount desc nulls last, "
         "l_tax desc nulls last, l_returnflag desc nulls last, l_linestatus desc nulls last")


@register("dedupe_first", _DEDUPE_SQL.format(cols=", ".join(LINE_COLS), order=_FIRST))
def dedupe_first(spark, d):
    """W03 keep='first': one row per (order, line) — the earliest shipment, ties
    broken by every other column."""
    return dd.dedupe(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"], keep="first")


@register("dedupe_last", _DEDUPE_SQL.format(cols=", ".join(LINE_COLS), order=_LAST))
def dedupe_last(spark, d):
    """W03 keep='last': ``sort_values(d).drop_duplicates(keys, keep='last')``."""
    return dd.dedupe(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"], keep="last")


@register("duplicate_report", """
select l.*, k.dup_count from lineitem l join (
  select l_orderkey, l_linenumber, cast(count(*) as bigint) as dup_count from lineitem
  group by l_orderkey, l_linenumber having count(*) > 1) k
on l.l_orderkey is not distinct from k.l_orderkey and l.l_linenumber is not distinct from k.l_linenumber
""")
def duplicate_report(spark, d):
    """Every row of a duplicated key (``duplicated(keep=False)``) with its count."""
    return dd.duplicate_rows(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


@register("full_row_distinct", "select distinct * from lineitem")
def full_row_distinct(spark, d):
    """W05."""
    return dd.full_row_distinct(Tables(spark, d).lineitem)


@register("fx_dedupe", """
select event_date, user_id, event_type, value from (
  select cast(ts as date) as event_date, user_id, event_type, value,
         row_number() over (partition by cast(ts as date), user_id, event_type
                            order by ts desc, event_id desc) as rn
  from events) t where rn = 1
""")
def fx_dedupe(spark, d):
    """``row_number() = 1`` per (day, base, target), newest first."""
    e = Tables(spark, d).events.withColumn("event_date", F.to_date("ts"))
    out = dd.latest_per_key(e, ["event_date", "user_id", "event_type"], ["ts desc", "event_id desc"], ties=[])
    return out.select("event_date", "user_id", "event_type", "value")


@register("last_non_null", """
with e as (select user_id, ts, event_id, nullif(event_type, 'error') as event_type, value,
                  case when value > 5 then props end as props from events),
k as (select distinct user_id from e),
a as (select user_id, event_type from (select user_id, event_type, row_number() over
        (partition by user_id order by ts desc, event_id desc) rn from e where event_type is not null) t where rn = 1),
b as (select user_id, value from (select user_id, value, row_number() over
        (partition by user_id order by ts desc, event_id desc) rn from e where value is not null) t where rn = 1),
c as (select user_id, props from (select user_id, props, row_number() over
        (partition by user_id order by ts desc, event_id desc) rn from e where props is not null) t where rn = 1)
select k.user_id, a.event_type, b.value, c.props
from k left join a using (user_id) left join b using (user_id) left join c using (user_id)
""")
def last_non_null(spark, d):
    """``groupby(key).last()``: per column, the last non-NULL value."""
    e = Tables(spark, d).events.select("user_id", "ts", "event_id",
                                       F.nullif("event_type", F.lit("error")).alias("event_type"), "value",
                                       F.when(F.col("value") > 5, F.col("props")).alias("props"))
    out = dd.last_non_null(e, ["user_id"], ["ts", "event_id"])
    return out.select("user_id", "event_type", "value", "props")


@register("missing_children", """
select * from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)
""")
def missing_children(spark, d):
    """Parents without children (left anti join)."""
    t = Tables(spark, d)
    return _missing(t.orders, t.lineitem, ["o_orderkey"], ["l_orderkey"])


@register("missing_children_topk", """
select * from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)
order by o_orderdate desc, o_orderkey desc limit 100
""")
def missing_children_topk(spark, d):
    """O03 + G04: the newest 100 parents without children (the back-fill work list;
    the limit is the feature)."""
    t = Tables(spark, d)
    return (_missing(t.orders, t.lineitem, ["o_orderkey"], ["l_orderkey"])
            .orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).limit(100))


@register("orphans", """
select l.* from lineitem l
where l.l_partkey is not null and not exists (select 1 from part p where p.p_partkey = l.l_partkey and p.p_size > 3)
union all
select l.* from lineitem l
where l.l_orderkey is not null and not exists (
    select 1 from orders o where o.o_orderkey = l.l_orderkey and o.o_orderstatus <> 'P')
""")
def orphans(spark, d):
    """Referential check: items without a listed product (small sizes are delisted), items
    without a placed order (pending ones are not stored yet)."""
    t = Tables(spark, d)
    return (_orphans(t.lineitem, t.part.where(F.col("p_size") > 3), ["l_partkey"], ["p_partkey"])
            .unionAll(_orphans(t.lineitem, t.orders.where(F.col("o_orderstatus") != "P"), ["l_orderkey"], ["o_orderkey"])))


@register("not_in_loaded", """
select p_partkey, p_name from part
where p_partkey not in (select l_partkey from lineitem where l_shipdate >= timestamp '2001-01-01 00:00:00')
""")
def not_in_loaded(spark, d):
    """SQL ``NOT IN`` (null-aware) — products not yet reported."""
    t = Tables(spark, d)
    recent = t.lineitem.where(F.col("l_shipdate") >= ts("2001-01-01 00:00:00"))
    return not_in(t.part, "p_partkey", recent, "l_partkey") \
        .select("p_partkey", "p_name")


@register("lateral_items", """
select p_partkey, w.word from part cross join lateral (select unnest(string_split(p_name, ' ')) as word) w
""")
def lateral_items(spark, d):
    """``CROSS JOIN LATERAL unnest(…)`` = explode."""
    p = Tables(spark, d).part
    return p.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@register("explode_events", """
select vec_id, label, cast(u.pos - 1 as bigint) as pos, cast(u.val as double) as val
from embeddings cross join lateral (select generate_subscripts(embedding, 1) as pos, unnest(embedding) as val) u
union all
select vec_id, label, cast(null as bigint), cast(null as double) from embeddings
where embedding is null or len(embedding) = 0
""")
def explode_events(spark, d):
    """Explode keeping empty lists (``explode_outer``) with element position."""
    e = Tables(spark, d).embeddings
    x = e.select("vec_id", "label", F.posexplode_outer("embedding").alias("pos", "val"))
    return x.select("vec_id", "label", F.col("pos").cast("bigint").alias("pos"), F.col("val").cast("double").alias("val"))


@register("array_key_join", """
with w as (select string_split(p_name, ' ')[1] as first_word, cast(count(*) as bigint) as parts_with_word
           from part group by 1)
select p.p_partkey, p.p_name, w.parts_with_word
from part p left join w on string_split(p.p_name, ' ')[1] = w.first_word
""")
def array_key_join(spark, d):
    """An array element (1-based first) as the join key."""
    p = Tables(spark, d).part.withColumn("__k", first_of(F.split("p_name", " ")))
    w = p.groupBy(F.col("__k").alias("first_word")).agg(F.count(F.lit(1)).cast("bigint").alias("parts_with_word"))
    return p.join(w, F.col("__k") == F.col("first_word"), "left").select("p_partkey", "p_name", "parts_with_word")


@register("json_path", """
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events
""")
def json_path(spark, d):
    """JSON path on a text payload."""
    e = Tables(spark, d).events
    return e.select("event_id", _json_path("props", "$.k").cast("bigint").alias("k"))


@register("request_batches", """
with n as (select p_brand, p_partkey,
                  (row_number() over (partition by p_brand order by p_partkey) - 1) // 20 as batch_no from part)
select p_brand, cast(batch_no as bigint) as batch_no, cast(count(*) as bigint) as n_items,
       min(p_partkey) as first_sku, max(p_partkey) as last_sku,
       string_agg(cast(p_partkey as varchar), ',' order by p_partkey) as skus
from n group by p_brand, batch_no
""")
def request_batches(spark, d):
    """W06 + N09: 20 products per request per brand (skew-safe numbering)."""
    p = Tables(spark, d).part
    b = _batches(p, ["p_brand"], ["p_partkey"], F.struct(F.col("p_partkey").alias("sku")), size=20)
    return b.select("p_brand", "batch_no", F.size("items").cast("bigint").alias("n_items"),
                    F.col("items")[0]["sku"].alias("first_sku"), F.element_at("items", -1)["sku"].alias("last_sku"),
                    F.array_join(F.transform("items", lambda x: x["sku"].cast("string")), ",").alias("skus"))


@register("fee_detail_pivot", """
select l_orderkey, l_linenumber,
       case when l_tax > 0.04 then l_tax * 100 else l_extendedprice * 0.15 end as est_referral_fee,
       case when l_discount > 0 then l_discount * l_extendedprice end as est_fba_fee,
       cast(null as double) as est_per_item_fee,
       case when l_discount > 0.05 then 'DISCOUNT' else 'OK' end as status
from lineitem
""")
def fee_detail_pivot(spark, d):
    """Array of fee structs → one column per fee type, last match wins,
    missing types → NULL (the fee list is built row-locally from each line)."""
    li = Tables(spark, d).lineitem
    fee = lambda t, a: F.struct(F.lit(t).alias("FeeType"), a.cast("double").alias("Amount"))
    fees = F.array(fee("ReferralFee", F.col("l_extendedprice") * F.lit(0.15)),
                   fee("FBAFees", F.when(F.col("l_discount") > 0, F.col("l_discount") * F.col("l_extendedprice"))),
                   fee("ReferralFee", F.when(F.col("l_tax") > 0.04, F.col("l_tax") * F.lit(100))))
    x = li.select("l_orderkey", "l_linenumber", "l_discount", fees.alias("fees"))

    def of(t):
        return lambda f: (f["FeeType"] == t) & f["Amount"].isNotNull(), lambda f: f["Amount"]

    names = {"est_referral_fee": of("ReferralFee"), "est_fba_fee": of("FBAFees"), "est_per_item_fee": of("PerItemFee")}
    x = x.withColumn("last", last_matches("fees", names))
    return x.select("l_orderkey", "l_linenumber", *[F.col(f"last.{n}").alias(n) for n in names],
                    F.when(F.col("l_discount") > 0.05, "DISCOUNT").otherwise("OK").alias("status"))


@register("master_detail_fill", """
select conv_id, turn, role,
       max(case when role = 'user' then turn end) over (partition by conv_id order by turn
           rows between unbounded preceding and current row) as master_turn
from conversations
""")
def master_detail_fill(spark, d):
    """Carry the latest user turn onto the following assistant/system turns."""
    c = Tables(spark, d).conversations.select("conv_id", "turn", "role")
    out = carry_down(c, ["conv_id"], ["turn"], F.col("role") == "user", ["turn"])
    return out.select("conv_id", "turn", "role", "master_turn")

