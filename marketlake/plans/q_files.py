"""Readers on files that Spark writes from the driver tables (S01, S03-S07, S09): write, read back, compare.

Every file holds at most ``PER_FILE`` records, so the number of files grows with the table
and no group does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.plans.registry import register
from marketlake.plans.tables import Tables
from marketlake.session import scratch_path
from marketlake.sources import files

PER_FILE = 2000


def _land(df: DataFrame, name: str, text, **options: str) -> str:
    """One text file per value of ``file``: its rows' ``record`` values folded by ``text``."""
    path = scratch_path(df.sparkSession, name)
    one = df.groupBy("file").agg(text(F.collect_list("record")).alias("value"))
    one.write.partitionBy("file").options(**options).text(path)
    return path


_ORDERS_SQL = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders"
_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderpriority", T.StringType())])


def _orders(spark, d):
    o = Tables(spark, d).orders.select(*_SCHEMA.names)
    return o.withColumn("file", F.floor(F.col("o_orderkey") / PER_FILE))


@register("read_json_reports", _ORDERS_SQL)
def read_json_reports(spark, d):
    """Gzip files, each a JSON array of records."""
    rows = _orders(spark, d).select("file", F.struct(*_SCHEMA.names).alias("record"))
    path = _land(rows, "json-reports", F.to_json, compression="gzip")
    return files.read_json_reports(spark, path, _SCHEMA, glob="*.gz", tag_from_name=False).drop("source_file")


@register("read_tsv_reports", _ORDERS_SQL)
def read_tsv_reports(spark, d):
    """Typed tab-separated files whose headers come in two orders, one with a column more."""
    usual, other = _SCHEMA.names, [*reversed(_SCHEMA.names), "extra"]
    rows = _orders(spark, d).withColumn("extra", F.lit("x"))

    def line(cols):
        return F.concat_ws("\t", *[F.col(c).cast("string") for c in cols])

    even = F.col("file") % 2 == 0
    rows = rows.select("file", F.when(even, line(usual)).otherwise(line(other)).alias("record"))
    head = F.when(even, "\t".join(usual)).otherwise("\t".join(other))
    path = scratch_path(spark, "tsv-reports")
    (rows.groupBy("file").agg(F.collect_list("record").alias("lines"))
     .select("file", F.concat_ws("\n", head, "lines").alias("value")).write.partitionBy("file").text(path))
    return files.read_tsv(spark, path, _SCHEMA).drop("source_file")


@register("read_two_header_csv", """
select 'B0' || (o_orderkey // 2000) as asin, 'weekly' as reporting_range, cast(o_orderkey as varchar) as "Reporting Date",
       case when o_orderkey % 3 = 0 then 'a=[b, "' || o_orderpriority || '"' else o_orderpriority end as "Search Query"
from orders
""")
def read_two_header_csv(spark, d):
    """Metadata line, header line, data; the data holds quotes, commas and text like metadata."""
    query = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit('a=[b, "'), "o_orderpriority", F.lit('"'))).otherwise(
        F.col("o_orderpriority"))
    quoted = F.concat(F.lit('"'), F.replace(query, F.lit('"'), F.lit('""')), F.lit('"'))
    rows = _orders(spark, d).select("file", F.concat_ws(",", F.col("o_orderkey").cast("string"), quoted).alias("record"))
    path = scratch_path(spark, "two-header")
    meta = F.concat(F.lit('ASIN or Product=["B0'), F.col("file").cast("string"), F.lit('"],Reporting Range=["weekly"]'))
    (rows.groupBy("file").agg(F.collect_list("record").alias("lines"))
     .select("file", F.concat_ws("\n", meta, F.lit("Reporting Date,Search Query"), "lines").alias("value"))
     .write.partitionBy("file").text(path))
    return files.read_two_header_csv(spark, path, ["Reporting Date", "Search Query"], glob="*.txt").drop("source_file")


# text that a parser of lines or of plain separators gets wrong
_ODD_SQL = """case p_partkey % 5 when 0 then '"' || p_brand || '" size' when 1 then p_name || chr(10) || 'second line, "' || p_type || '"'
  when 2 then p_name || ',' || p_type when 3 then null else p_name end"""


def _odd_text():
    return (F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit('"'), "p_brand", F.lit('" size')))
            .when(F.col("p_partkey") % 5 == 1, F.concat("p_name", F.lit('\nsecond line, "'), "p_type", F.lit('"')))
            .when(F.col("p_partkey") % 5 == 2, F.concat_ws(",", "p_name", "p_type"))
            .when(F.col("p_partkey") % 5 == 3, F.lit(None)).otherwise(F.col("p_name")))


def _parts_files(spark, d, name: str, surplus: bool = False) -> str:
    """CSV files of parts under two headers: text in quotes with line breaks, quotes and separators in it,
    quotes that do not enclose a cell, records that end early and (``surplus``) records with a cell too many."""
    p = Tables(spark, d).part.withColumn("file", F.floor(F.col("p_partkey") / PER_FILE))
    odd, key = _odd_text(), F.col("p_partkey").cast("string")
    # a cell of the form "x" y is not quoted as a whole; others with quotes, breaks or commas are
    cell = F.when(F.col("p_partkey") % 5 == 0, odd).otherwise(
        F.concat(F.lit('"'), F.replace(odd, F.lit('"'), F.lit('""')), F.lit('"')))
    even = F.col("file") % 2 == 0
    usual = F.when(cell.isNull(), key).otherwise(F.concat_ws(",", key, cell))
    if surplus:
        usual = F.when(F.col("p_partkey") % 50 == 4, F.concat_ws(",", key, "p_brand", F.lit("surplus"))).otherwise(usual)
    other = F.concat_ws(",", F.lit("x"), F.coalesce(cell, F.lit("")), key)
    path = scratch_path(spark, name)
    (p.select("file", F.when(even, usual).otherwise(other).alias("record")).groupBy("file")
     .agg(F.collect_list("record").alias("lines"))
     .select("file", F.concat_ws("\n", F.when(even, "p_partkey,description").otherwise("more,description,p_partkey"), "lines")
             .alias("value")).write.partitionBy("file").text(path))
    return path


@register("read_csv_cells", f"select p_partkey, {_ODD_SQL} as description from part")
def read_csv_cells(spark, d):
    """Typed CSV by extension; headers in two orders, short records, and every kind of quoted cell."""
    path = _parts_files(spark, d, "csv-cells")
    return files.read_any(spark, path, T.StructType.fromDDL("p_partkey BIGINT, description STRING"), fmt="csv").select("p_partkey", "description")


@register("read_csv_rejects", """
select p_partkey, p_brand as description, '_cells' as rejected from part
where p_partkey % 50 = 4 and (p_partkey // 2000) % 2 = 0
""")
def read_csv_rejects(spark, d):
    """Records with more cells than their header come back as rejects."""
    path = _parts_files(spark, d, "csv-rejects", surplus=True)
    kept = files.read_delimited(spark, path, T.StructType.fromDDL("p_partkey BIGINT, description STRING"), "*.txt", bad="keep")
    return files.rejects(kept).select("p_partkey", "description", F.array_join(files.REJECTED, ",").alias("rejected"))


@register("read_latin1_tsv", f"""
select cast(p_partkey as varchar) as sku, replace({_ODD_SQL}, chr(10), ' ') || ' é£' as title,
       cast(p_size as varchar) as size from part
""")
def read_latin1_tsv(spark, d):
    """Latin-1 text, every cell as it is: quotation marks are text."""
    p = Tables(spark, d).part
    title = F.concat(F.replace(_odd_text(), F.lit("\n"), F.lit(" ")), F.lit(" é£"))
    path = scratch_path(spark, "latin1")
    # the writer's quoting is off: the cells hold neither tabs nor line breaks
    (p.select(F.col("p_partkey").alias("sku"), title.alias("title"), F.col("p_size").alias("size"))
     .write.options(header=True, sep="\t", quote="", encoding="ISO-8859-1").csv(path))
    return files.read_latin1_tsv(spark, path, glob="*.csv").select("sku", "title", "size")


@register("read_wrapped_json", """
select cast(o_orderkey // 2000 as varchar) as "reportId", o_orderkey as "orderKey", o_totalprice as "sales_amount" from orders
""")
def read_wrapped_json(spark, d):
    """One document per file, its records in an array, each with a struct."""
    item = F.struct(F.col("o_orderkey").alias("orderKey"), F.struct(F.col("o_totalprice").alias("amount")).alias("sales"))
    rows = _orders(spark, d).groupBy("file").agg(F.collect_list(item).alias("byOrder"))
    path = scratch_path(spark, "wrapped")
    document = F.to_json(F.struct(F.struct(F.col("file").cast("string").alias("reportId")).alias("spec"), "byOrder"))
    rows.select("file", document.alias("value")).write.partitionBy("file").text(path)
    schema = T.StructType.fromDDL("spec STRUCT<reportId: STRING>, byOrder ARRAY<STRUCT<orderKey: BIGINT, sales: STRUCT<amount: DOUBLE>>>")
    wrapped = files.read_wrapped_json(spark, path, schema, "byOrder", glob="*.txt", keep=["spec"])
    return wrapped.select(F.col("spec_reportId").alias("reportId"), "orderKey", "sales_amount")


@register("read_pages", """
select l_orderkey as "OrderId", l_linenumber as "Item_Line", l_extendedprice as "Item_Price_Amount" from lineitem
""")
def read_pages(spark, d):
    """JSON lines, one page of records per line, exploded and flattened."""
    schema = T.StructType.fromDDL("Items ARRAY<STRUCT<OrderId: BIGINT, Item: STRUCT<Line: INT, Price: STRUCT<Amount: DOUBLE>>>>")
    li = Tables(spark, d).lineitem
    item = F.struct(F.col("l_orderkey").alias("OrderId"), F.struct(
        F.col("l_linenumber").alias("Line"), F.struct(F.col("l_extendedprice").alias("Amount")).alias("Price")).alias("Item"))
    path = scratch_path(spark, "pages")
    (li.groupBy(F.floor(F.col("l_orderkey") / 50).alias("page")).agg(F.collect_list(item).alias("Items"))
     .select("Items").write.json(path))
    return files.read_pages(spark, path, schema, "Items").drop("source_file")
