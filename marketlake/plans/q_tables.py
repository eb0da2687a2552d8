"""Keyed-table and incremental-load queries (K01, K03, K06, K14, G01, streaming G01).

``current`` and ``batch`` are both derived from the whole ``orders`` table by a
date cut: the stored table holds orders before 1998, the batch restates every
order from 1997 on (a one-year overlap is updated, later orders are inserted).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketlake.functions import money
from marketlake.operators.constraints import VIOLATED, ForeignKey
from marketlake.operators.incremental import after_watermark, load_unloaded
from marketlake.plans.registry import register
from marketlake.plans.tables import Tables, ts
from marketlake.sinks.keyed import KeyedTable, fix_values, insert_ignore as _insert_ignore, merge_frames
from marketlake.sinks.tables import add_column_to_tables, append_once as _append_once, export_daily as _export_daily, export_mart as _export_mart
from marketlake.session import scratch_path
from marketlake.streaming.file_upsert import stream_upsert as _stream_upsert

_BATCH_SQL = """
with cur as (select * from orders where o_orderdate < timestamp '1998-01-01 00:00:00'),
bat as (select o.o_orderkey, o.o_custkey, 'U' as o_orderstatus, cast(a.t as double) as o_totalprice, o.o_orderdate
               {extra}
        from orders o left join (select l_orderkey, sum(cast(l_extendedprice as decimal(18,2))) as t
                                 from lineitem group by l_orderkey) a on a.l_orderkey = o.o_orderkey
        where o.o_orderdate >= timestamp '1997-01-01 00:00:00')
"""


def _current_and_batch(t, with_priority: bool):
    cur = t.orders.where(F.col("o_orderdate") < ts("1998-01-01 00:00:00"))
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sum(money("l_extendedprice")).cast("double").alias("__t"))
    o = t.orders.where(F.col("o_orderdate") >= ts("1997-01-01 00:00:00"))
    b = o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    cols = [F.col("o_orderkey"), F.col("o_custkey"), F.lit("U").alias("o_orderstatus"),
            F.col("__t").alias("o_totalprice"), F.col("o_orderdate")]
    if with_priority:
        cols.append(F.lit("NEW").alias("o_orderpriority"))
    return cur, b.select(*cols)


@register("upsert_merge", _BATCH_SQL.format(extra="") + """
select coalesce(b.o_orderkey, c.o_orderkey) as o_orderkey,
       case when b.o_orderkey is not null then b.o_custkey else c.o_custkey end as o_custkey,
       case when b.o_orderkey is not null then b.o_orderstatus else c.o_orderstatus end as o_orderstatus,
       case when b.o_orderkey is not null then b.o_totalprice else c.o_totalprice end as o_totalprice,
       case when b.o_orderkey is not null then b.o_orderdate else c.o_orderdate end as o_orderdate,
       case when b.o_orderkey is not null then null else c.o_orderpriority end as o_orderpriority
from cur c full join bat b on c.o_orderkey = b.o_orderkey
""")
def upsert_merge(spark, d):
    """``INSERT … ON CONFLICT (o_orderkey) DO UPDATE SET <every column>``;
    the batch lacks ``o_orderpriority``, which therefore becomes NULL on updated
    rows (the source's behaviour, ``missing='null'``)."""
    cur, batch = _current_and_batch(Tables(spark, d), with_priority=False)
    return merge_frames(cur, batch, ["o_orderkey"], missing="null")


@register("insert_ignore", _BATCH_SQL.format(extra=", 'NEW' as o_orderpriority") + """
select * from cur
union all
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from bat b
where not exists (select 1 from cur c where c.o_orderkey = b.o_orderkey)
""")
def insert_ignore(spark, d):
    """``ON CONFLICT DO NOTHING``."""
    cur, batch = _current_and_batch(Tables(spark, d), with_priority=True)
    return _insert_ignore(cur, batch, ["o_orderkey"])


@register("incremental_after_watermark", """
with wm as (select o_orderpriority, max(o_orderdate) as w from orders
            where o_orderdate < timestamp '1998-01-01 00:00:00' group by o_orderpriority)
select o.* from orders o left join wm on o.o_orderpriority = wm.o_orderpriority
where o.o_orderdate >= timestamp '1997-06-01 00:00:00'
  and o.o_orderdate > coalesce(wm.w, timestamp '2020-01-01 00:00:00')
""")
def incremental_after_watermark(spark, d):
    """New rows past the high-water mark of their own (tenant, marketplace)
    group; empty groups start at 2020-01-01."""
    t = Tables(spark, d)
    current = t.orders.where(F.col("o_orderdate") < ts("1998-01-01 00:00:00"))
    batch = t.orders.where(F.col("o_orderdate") >= ts("1997-06-01 00:00:00"))
    return after_watermark(batch, current, ["o_orderpriority"], "o_orderdate")


AS_OF = dt.datetime(2024, 2, 1, 6, 0, 0)


@register("append_once", """
select *, timestamp '2024-02-01 06:00:00' as loaded_at, date '2024-02-01' as load_date from events
""")
def append_once(spark, d):
    """A daily snapshot appended twice on one day is stored once."""
    path = scratch_path(spark, "append-once")
    e = Tables(spark, d).events
    _append_once(e, path, "loaded_at", AS_OF)
    _append_once(e, path, "loaded_at", AS_OF)  # same day: skipped by the guard
    out = spark.read.parquet(path)
    return out.withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))


@register("keyed_upsert", """
with first as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders
               where o_orderdate < timestamp '1997-01-01 00:00:00'),
     second as (select o_orderkey, o_custkey, 'U' as o_orderstatus, -o_totalprice as o_totalprice, o_orderdate,
                       cast(null as varchar) as o_orderpriority
                from orders where o_orderdate >= timestamp '1996-01-01 00:00:00')
select *, true as untouched from first
where o_orderkey not in (select o_orderkey from second)
union all select *, false from second
""")
def keyed_upsert(spark, d):
    """K01 on a stored table: two upserts, the second over a part of the first's keys and without
    one column (which becomes NULL); the table is read back in its stored types."""
    o = Tables(spark, d).orders
    table = KeyedTable(spark, scratch_path(spark, "keyed-orders"), ["o_orderkey"])
    table.upsert(o.where(F.col("o_orderdate") < ts("1997-01-01 00:00:00")), as_of=dt.datetime(2024, 1, 1))
    second = o.where(F.col("o_orderdate") >= ts("1996-01-01 00:00:00")).select(
        F.col("o_orderkey").alias("OOrderkey"), F.col("o_custkey").alias("oCustkey"), F.lit("U").alias("o_orderstatus"),
        (-F.col("o_totalprice")).alias("oTotalprice"), F.col("o_orderdate"))
    table.upsert(second.withColumnRenamed("OOrderkey", "o_orderkey"), as_of=dt.datetime(2024, 1, 2))
    out = table.read()
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
                      (F.col("updated_at") < F.lit("2024-01-02").cast("timestamp")).alias("untouched"))


@register("keyed_insert_ignore", """
with first as (select o_orderkey, o_custkey, o_orderstatus from orders where o_orderdate < timestamp '1997-01-01 00:00:00'),
     second as (select o_orderkey, o_custkey, 'N' as o_orderstatus from orders where o_orderdate >= timestamp '1996-01-01 00:00:00')
select *, true as stored from first
union all select *, false from second where o_orderkey not in (select o_orderkey from first)
""")
def keyed_insert_ignore(spark, d):
    """K03 on a stored table in key buckets: a batch that overlaps the stored keys by a year adds only new
    keys, and no stored file is rewritten."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    table = KeyedTable(spark, scratch_path(spark, "keyed-insert"), ["o_orderkey"])
    table.upsert(o.where(F.col("o_orderdate") < ts("1997-01-01 00:00:00")).drop("o_orderdate"), as_of=dt.datetime(2024, 1, 1))
    second = o.where(F.col("o_orderdate") >= ts("1996-01-01 00:00:00")).drop("o_orderdate")
    table.insert_ignore(second.withColumn("o_orderstatus", F.lit("N")), as_of=dt.datetime(2024, 1, 2))
    return table.read().select("o_orderkey", "o_custkey", "o_orderstatus",
                               (F.col("created_at") < F.lit("2024-01-02").cast("timestamp")).alias("stored"))


@register("stored_fix", """
select o_orderkey, o_orderdate,
       case when o_orderpriority = '5-LOW' and o_orderstatus = 'F' then '5-LOWEST' else o_orderpriority end as o_orderpriority
from orders
""")
def stored_fix(spark, d):
    """K14 on a stored table: only partitions with a row to change are rewritten."""
    table = KeyedTable(spark, scratch_path(spark, "keyed-fix"), ["o_orderkey"], audit=False)
    table.append(Tables(spark, d).orders.select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"))
    table.fix_values("o_orderpriority", "5-LOW", "5-LOWEST", F.col("o_orderstatus") == "F")
    return table.read().select("o_orderkey", "o_orderdate", "o_orderpriority")


@register("export_mart", """
select n_name as tenant, c_custkey, c_name, case when n_name = 'FRANCE' then -c_acctbal else c_acctbal end as c_acctbal
from customer join nation on c_nationkey = n_nationkey
""")
def export_mart(spark, d):
    """One output per tenant; then one tenant's output is exported again, and the others stay."""
    t = Tables(spark, d)
    mart = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("tenant"), "c_custkey", "c_name", "c_acctbal")
    path = scratch_path(spark, "export-mart")
    _export_mart(mart, path, partition_by=["tenant"])
    _export_mart(mart.where("tenant = 'FRANCE'").withColumn("c_acctbal", -F.col("c_acctbal")), path, partition_by=["tenant"])
    return spark.read.parquet(path).select("tenant", "c_custkey", "c_name", "c_acctbal")


@register("export_daily", """
select cast(date_trunc('month', o_orderdate) as date) as day, o_orderkey, cast(o_totalprice as double) as o_totalprice from orders
""")
def export_daily(spark, d):
    """CSV per day (here the first of a month); a second export restates days that exist, which stay as
    they are, and adds later ones."""
    o = Tables(spark, d).orders.select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("day"), "o_orderkey", "o_totalprice")
    path = scratch_path(spark, "export-daily")
    _export_daily(o.where("day < date'1998-03-01'"), path, "day")
    restated = o.withColumn("o_totalprice", F.when(F.col("day") < F.lit("1998-03-01").cast("date"), -1.0).otherwise(F.col("o_totalprice")))
    _export_daily(restated.where("day >= date'1998-01-01'"), path, "day")
    out = spark.read.option("header", True).schema("o_orderkey BIGINT, o_totalprice DOUBLE, day DATE").csv(path)
    return out.select("day", "o_orderkey", "o_totalprice")


@register("foreign_keys_enforced", """
with x as (select o_orderkey, o_custkey, case when o_orderkey % 11 <> 0 then o_custkey % 30 end as nation from orders),
buyers as (select c_custkey from customer where c_mktsegment <> 'BUILDING'),
places as (select n_nationkey from nation where n_regionkey <> 1)
select o_orderkey, concat_ws(',', case when c_custkey is null then 'orders_customer_fk' end,
         case when nation is not null and n_nationkey is null then 'orders_nation_fk' end) as violated
from x left join buyers on o_custkey = c_custkey left join places on nation = n_nationkey
""")
def foreign_keys_enforced(spark, d):
    """J16 at load: orders whose customer or nation is not stored are rejects with the constraints' names; a NULL
    key violates nothing.  Accepted and rejected rows are read back together."""
    t = Tables(spark, d)
    keys = [ForeignKey("orders_customer_fk", ["o_custkey"], t.customer.where("c_mktsegment <> 'BUILDING'"), ["c_custkey"]),
            ForeignKey("orders_nation_fk", ["nation"], t.nation.where("n_regionkey <> 1"), ["n_nationkey"])]
    rows = t.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey") % 30).alias("nation"))
    table = KeyedTable(spark, scratch_path(spark, "orders-fk"), ["o_orderkey"], audit=False, foreign_keys=keys)
    rejects = table.upsert(rows)
    return table.read().select("o_orderkey", F.lit("").alias("violated")).union(
        rejects.select("o_orderkey", F.array_join(VIOLATED, ",").alias("violated")))


@register("ledger_load", """
select o_orderkey, case when o_orderdate >= timestamp '1997-01-01 00:00:00' then 'late' else o_orderstatus end as o_orderstatus,
       2 as loads from orders
""")
def ledger_load(spark, d):
    """Files that a ledger does not have are loaded once: a first load, one that finds nothing new, and one
    that finds only the files that have come since."""
    land, ledger = scratch_path(spark, "ledger-land"), scratch_path(spark, "ledger")
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    late = F.col("o_orderdate") >= ts("1997-01-01 00:00:00")
    table = KeyedTable(spark, scratch_path(spark, "ledger-orders"), ["o_orderkey"], audit=False)

    def load() -> bool:
        return bool(load_unloaded(spark, land, "*.parquet", ledger, lambda paths: spark.read.parquet(*paths), table.upsert))

    o.where(~late).drop("o_orderdate").write.parquet(f"{land}/first")
    loads = [load(), load()]
    o.where(late).drop("o_orderdate").withColumn("o_orderstatus", F.lit("late")).write.parquet(f"{land}/second")
    loads.append(load())
    return table.read().withColumn("loads", F.lit(sum(loads)))


@register("column_default_all_tables", """
select 'customer' as table_name, c_custkey as key, 1 as tenant_id from customer
union all select 'supplier', s_suppkey, 1 from supplier union all select 'part', p_partkey, p_size from part
""")
def column_default_all_tables(spark, d):
    """``tenant_id`` with a default on every table of a schema; a table that has the column keeps its values,
    and a second run changes nothing."""
    t = Tables(spark, d)
    path = scratch_path(spark, "defaults")
    db = "defaults_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{path}'")
    t.customer.select(F.col("c_custkey").alias("key")).write.saveAsTable(f"{db}.customer")
    t.supplier.select(F.col("s_suppkey").alias("key")).write.saveAsTable(f"{db}.supplier")
    t.part.select(F.col("p_partkey").alias("key"), F.col("p_size").alias("tenant_id")).write.saveAsTable(f"{db}.part")
    for _ in range(2):
        add_column_to_tables(spark, [db], "tenant_id", "int", 1)
    tables = [spark.table(f"{db}.{n}").select(F.lit(n).alias("table_name"), "key", F.col("tenant_id").cast("int").alias("tenant_id"))
              for n in ("customer", "supplier", "part")]
    return tables[0].union(tables[1]).union(tables[2])


@register("in_place_fix", """
select o_orderkey, o_orderstatus,
       case when o_orderpriority = '5-LOW' and o_orderstatus = 'F' then '5-LOWEST' else o_orderpriority end
           as o_orderpriority
from orders
""")
def in_place_fix(spark, d):
    """``UPDATE … SET v = new WHERE v = old AND …`` as a projection."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return fix_values(o, "o_orderpriority", "5-LOW", "5-LOWEST", F.col("o_orderstatus") == "F")


@register("stream_upsert", """
with second as (select * replace ('U' as o_orderstatus) from orders where o_orderdate >= timestamp '1996-01-01 00:00:00')
select * from orders where o_orderdate < timestamp '1997-01-01 00:00:00' and o_orderkey not in (select o_orderkey from second)
union all select * from second
""")
def stream_upsert(spark, d):
    """G01 streaming form: landed files read as a file stream, each micro-batch upserted into a keyed
    table by ``foreachBatch`` (trigger ``availableNow``).  A second run of the stream finds only
    the files that landed since, restating a year of stored orders."""
    land, path = scratch_path(spark, "stream-land"), scratch_path(spark, "stream-orders")
    o = Tables(spark, d).orders
    o.where(F.col("o_orderdate") < ts("1997-01-01 00:00:00")).write.parquet(f"{land}/first")
    _stream_upsert(spark, land, "*.parquet", o.schema, path, ["o_orderkey"])
    second = o.where(F.col("o_orderdate") >= ts("1996-01-01 00:00:00")).withColumn("o_orderstatus", F.lit("U"))
    second.write.parquet(f"{land}/second")
    _stream_upsert(spark, land, "*.parquet", o.schema, path, ["o_orderkey"])
    return KeyedTable(spark, path, ["o_orderkey"], audit=False).read().select(*o.columns)
