"""Readers for landed report files.

One reader call is one multi-file scan over a whole folder tree (never a Python
loop that concatenates frames).  Provenance comes from ``_metadata.file_path``
inside the plan, so tenant / marketplace / date tags cost a projection.

Scale notes: whole-file formats (multi-line JSON, gzip) are not splittable, so
one file = one task; land many medium files rather than few huge ones, and
repartition after the read when files are skewed in size.  JSON lines and text
without quotes are split by ``spark.sql.files.maxPartitionBytes``; so is quoted text
that is read with ``multi_line=False``, which says that no cell holds a line break.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.text import strip_non_word
from marketlake.operators.joins import broadcast_if_small
from marketlake.operators.shape import explode_records, flatten

# --- fixed values that must equal the reference's (file-name patterns) -------
ACCOUNT_MARKET_DATE = r"\((.*)-(\w{2})\).+(20\d\d-\d\d-\d\d)"
REPORT_NAME = r"(SPONSORED_\w+)\s\(.*(\w{2})\)\s(\w+)\s(\[.+\])"
SEARCH_QUERY_COUNTRY = r"/(\w*)_Search_Query"
SEARCH_QUERY_VIEW = r"(ASIN|Brand)"
DAILY_CSV_DATE = r"s - (.*)\.csv"
# -----------------------------------------------------------------------------


def source_file() -> Column:
    """The decoded path of the file a row came from.  ``_metadata.file_path``
    is percent-encoded; ``+`` is protected first because ``url_decode`` would turn
    it into a space."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def name_parts(path: Column, pattern: str, names: Sequence[str]) -> dict[str, Column]:
    """Regex groups of a file name as named columns (empty match → NULL)."""
    return {n: F.nullif(F.regexp_extract(path, pattern, i + 1), F.lit("")) for i, n in enumerate(names)}


def _reader(spark: SparkSession, schema: T.StructType | None, glob: str | None, recursive: bool = True,
            modified_after: str | None = None, **options):
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    for k, v in options.items():
        r = r.option(k, v)
    return r


# What a reader does with text it cannot read: "fail" raises; "keep" returns every row, those that
# could not be read with ``_corrupt_record`` (JSON) or the names of the cells in ``_rejected``
# (delimited text), and ``rejects`` / ``accepted`` take them apart.  Nothing is dropped in silence.
CORRUPT, REJECTED = "_corrupt_record", "_rejected"


def _json(spark: SparkSession, path: str, schema: T.StructType, glob: str | None, bad: str, multi_line: bool,
          **options) -> DataFrame:
    if bad == "fail":
        return _reader(spark, schema, glob, multiLine=multi_line, mode="FAILFAST", **options).json(path)
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = _reader(spark, with_corrupt, glob, multiLine=multi_line, columnNameOfCorruptRecord=CORRUPT,
                 **options).json(path)
    # a file whose compressed stream breaks off has no text to show: a row without any value is one too
    lost = F.lit(True)
    for f in schema.fields:
        lost = lost & F.col(f"`{f.name}`").isNull()
    return df.withColumn(CORRUPT, F.when(lost, F.coalesce(F.col(CORRUPT), F.lit("")))
                         .otherwise(F.col(CORRUPT)))


def rejects(df: DataFrame) -> DataFrame:
    """Rows of a reader with ``bad="keep"`` that could not be read, with their ``source_file``."""
    return df.where(_bad(df))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(~_bad(df)).drop(CORRUPT, REJECTED)


def _bad(df: DataFrame) -> Column:
    return F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.size(REJECTED) > 0


def read_json_reports(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.json.gz",
                      tag_from_name: bool = True, bad: str = "fail") -> DataFrame:
    """S01 + S10 + S16: every matching file is a JSON array of records (gzip is
    decompressed by the codec); union of all files, tagged with ``account,
    marketplace, report_date`` from the file name (the *last* date in the name).
    A file that cannot be parsed raises, or comes back as a reject (``bad="keep"``)."""
    df = _json(spark, path, schema, glob, bad, True)
    df = df.withColumn("source_file", source_file())
    if tag_from_name:
        parts = name_parts(F.col("source_file"), ACCOUNT_MARKET_DATE, ["account", "marketplace", "report_date"])
        parts["report_date"] = F.to_date(parts["report_date"])
        parts.update(name_parts(F.col("source_file"), REPORT_NAME, ["ad_product", "_mk2", "report_type", "group_by"]))
        df = df.withColumns(parts).drop("_mk2")
    return df


# ---------------------------------------------------------------- delimited text, by header
HEAD_ROWS = 64          # rows of a split that are read to find its first lines
SMALL_FILE = 1 << 20    # bytes; files up to this are read whole, many to a task, to find theirs
LINE = re.compile(rb"[^\r\n]+")
COMPRESSED = r"\.(gz|gzip|bz2|deflate|lz4|snappy|zst|zstd|xz)$"
TOO_MANY = "_cells"     # named in ``_rejected`` for a row with more cells than its header


def _first_lines(spark: SparkSession, path: str, glob: str | None, encoding: str, count: int,
                 recursive: bool = True) -> list[tuple[str, list[str]]]:
    """(file, its first ``count`` lines with text) of every file that has so many, by name.

    Small files share tasks, so the tasks follow the bytes and not the number of files.  Of larger
    ones (and compressed ones, whose text may be large) every split is a task of its own that stops after
    its first batch of rows, so they are not read through.  Lines end where Spark's text source ends
    them; a header is one line.
    """
    import pyarrow as pa

    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(HEAD_ROWS))
    known = "source_file string, lines array<string>"

    def text_of(value: bytes) -> list[str]:
        line = value.decode(encoding).removeprefix("\ufeff")
        return [line.rstrip("\r")] if line.strip() else []

    def heading(text: bytes) -> list[str]:
        lines: list[str] = []
        for m in LINE.finditer(text):
            lines += text_of(m.group())
            if len(lines) == count:
                return lines
        return []

    def first(batches):
        lines: list[str] = []
        for batch in batches:
            if batch.num_rows and batch.column(1)[0].as_py() != 0:
                return
            for value in batch.column(2):
                lines += text_of(value.as_py())
                if len(lines) == count:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(0, 1), pa.array([lines])],
                                                     ["source_file", "lines"])
                    return

    def whole(batches):
        for batch in batches:
            heads = [heading(x.as_py()) for x in batch.column(2)]
            some = [i for i, lines in enumerate(heads) if lines]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(some, pa.int64())), pa.array([heads[i] for i in some], pa.list_(pa.string()))],
                ["source_file", "lines"])

    size, name = F.col("_metadata.file_size"), F.lower("_metadata.file_name")
    plain = ~name.rlike(COMPRESSED)

    def rows(df: DataFrame, keep: Column, reader) -> list:
        return df.where(keep).select(source_file().alias("f"), F.col("_metadata.file_block_start").alias("at"),
                                     F.col("value").cast("binary").alias("v")).mapInArrow(reader, known).collect()

    found = rows(_reader(own, None, glob, recursive).text(path, wholetext=True), (size <= SMALL_FILE) & plain, whole)
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))  # one split a task
    found += rows(_reader(own, None, glob, recursive).text(path), (size > SMALL_FILE) | ~plain, first)
    return sorted((r["source_file"], list(r["lines"])) for r in found)


def _by_header(heads: Sequence[tuple[str, list[str]]], line: int) -> dict[str, list[str]]:
    """Files by the text of their header line."""
    groups: dict[str, list[str]] = {}
    for file, lines in heads:
        groups.setdefault(lines[line], []).append(file)
    return groups


def escaped(path: str) -> str:
    """A path as a pattern that means itself."""
    return re.sub(r"([\\\[\]{}*?^])", r"\\\1", path)


def _names(head: str, sep: str, quote: str | None) -> list[str]:
    """The names in a header line, as they are in the file, without white space around them."""
    kind = {"quotechar": quote, "doublequote": True} if quote else {"quoting": csv.QUOTE_NONE}
    return [x.strip() for x in next(csv.reader([head], delimiter=sep, **kind))]


def _rows(spark: SparkSession, files: Sequence[str], width: int, sep: str, quote: str | None, encoding: str,
          multi_line: bool) -> DataFrame:
    """The records after the first line of ``files``: cells c0, c1, ... as text (empty: NULL), source_file,
    line_no and whether a record has text beyond ``width`` cells.  Short records end in NULLs."""
    def text(n: int) -> list[T.StructField]:
        return [T.StructField(f"c{i}", T.StringType()) for i in range(n)]

    options = {"sep": sep, "quote": quote or "", "escape": quote or "\\", "encoding": encoding}
    df = (spark.read.schema(T.StructType([*text(width), T.StructField(CORRUPT, T.StringType())]))
          .options(**options, header=True, multiLine=multi_line, columnNameOfCorruptRecord=CORRUPT)
          .csv([escaped(f) for f in files]))
    # Spark keeps a record with too few or too many cells; only of the latter has it lost text
    beyond = F.from_csv(CORRUPT, T.StructType(text(2 * width + 8)).simpleString().removeprefix("struct<").removesuffix(">")
                        .replace(":", " "), options)
    extra = F.coalesce(*[beyond[f"c{i}"] for i in range(width, 2 * width + 8)])
    # (Spark answers no query that reads the corrupt text alone, hence the first cell)
    many = F.col(CORRUPT).isNotNull() & F.coalesce(F.length(F.concat(F.coalesce("c0", F.lit("")), extra)) >= 0, F.lit(False))
    return df.select(*[F.nullif(F.col(f"c{i}"), F.lit("")).alias(f"c{i}") for i in range(width)],
                     source_file().alias("source_file"), many.alias("many"),
                     F.struct(F.col("_metadata.file_block_start").alias("split"),
                              F.monotonically_increasing_id().alias("place")).alias("line_no"))


def _checked(rows: DataFrame, bad: str) -> DataFrame:
    """Rows without one that has too many cells (which raises), unless they are kept."""
    if bad == "keep":
        return rows
    message = F.concat(F.lit("a record has more cells than the header of "), "source_file")
    return rows.where(F.when(F.col("many"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None, glob: str | None = None,
                   sep: str = ",", encoding: str = "UTF-8", bad: str = "fail", recursive: bool = True,
                   line_numbers: bool = False, quote: str | None = '"', multi_line: bool | None = None) -> DataFrame:
    """Text with one header line per file; columns are matched by the names in each file's own header,
    so files may order them differently, have more, or lack some (NULL).

    Files are grouped by header, and Spark's own CSV source reads every group; distinct headers and
    the names of their files reach the driver, as they do for any read.  ``quote=None`` is for formats
    without quoting.  A quoted cell may hold line breaks (``multi_line``, the default with quotes;
    such files are not split).

    Without a schema the columns are those of all headers, as strings.  With one, values are cast;
    empty text is NULL; a value that does not cast raises, or is NULL with its column named in
    ``_rejected`` (``bad="keep"``).  A record with fewer cells than the header ends in NULLs; one with
    text in a cell beyond them raises, or is a reject (``_cells`` in ``_rejected``).  A name that a header repeats means
    its first column.  ``line_numbers`` adds ``line_no``, which orders the records of a file.
    """
    heads = _by_header(_first_lines(spark, path, glob, encoding, 1, recursive), 0)
    groups = [(_names(head, sep, quote), files) for head, files in heads.items()]
    if schema is None:
        first: dict[str, int] = {}
        for names, _ in groups:
            for at, name in enumerate(names):
                if name:
                    first[name] = min(at, first.get(name, at))
        schema = T.StructType([T.StructField(n, T.StringType()) for n in sorted(first, key=lambda n: (first[n], n))])
    out = _no_rows(spark, schema, line_numbers, bad)
    for names, files in groups:
        rows = _checked(_rows(spark, files, len(names), sep, quote, encoding,
                              bool(quote) if multi_line is None else multi_line), bad)
        out = out.unionByName(_typed(rows, names, schema, line_numbers, bad))
    return out


def _no_rows(spark: SparkSession, schema: T.StructType, line_numbers: bool, bad: str) -> DataFrame:
    fields = [*schema.fields, T.StructField("source_file", T.StringType())]
    if line_numbers:
        fields.append(T.StructField("line_no", T.StructType.fromDDL("split long, place long")))
    if bad == "keep":
        fields.append(T.StructField(REJECTED, T.ArrayType(T.StringType())))
    return spark.createDataFrame([], T.StructType(fields))


def _typed(rows: DataFrame, names: Sequence[str], schema: T.StructType, line_numbers: bool, bad: str) -> DataFrame:
    """Cells by name, cast to the schema's types."""
    out, failed = [], [F.when(F.col("many"), F.lit(TOO_MANY))]
    for f in schema.fields:
        if f.name not in names:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.col(f"c{names.index(f.name)}")
        if isinstance(f.dataType, T.StringType):
            out.append(text.alias(f.name))
            continue
        value = F.trim(text).cast(f.dataType) if bad == "fail" else F.trim(text).try_cast(f.dataType)
        out.append(value.alias(f.name))
        failed.append(F.when(text.isNotNull() & value.isNull(), F.lit(f.name)))
    return rows.select(*out, "source_file", *(["line_no"] if line_numbers else []),
                       *([F.array_compact(F.array(*failed)).alias(REJECTED)] if bad == "keep" else []))


def read_dated_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, glob: str = "*.csv",
                   date_col: str = "date", bad: str = "fail") -> DataFrame:
    """Daily CSV exports; the date comes from ``… s - January 5, 2024.csv``
    unless the file already carries a ``date`` column.  Empty files add no rows."""
    df = read_delimited(spark, path, schema, glob, bad=bad)
    from_name = F.try_to_date(F.regexp_extract(F.col("source_file"), DAILY_CSV_DATE, 1), "MMMM d, yyyy")
    if date_col in df.columns:
        return df.withColumn(date_col, F.coalesce(F.to_date(F.col(date_col)), from_name))
    return df.withColumn(date_col, from_name)


def read_two_header_csv(spark: SparkSession, path: str, columns: Sequence[str], glob: str = "*.csv",
                        meta_keys: Mapping[str, str] | None = None) -> DataFrame:
    """CSV whose line 1 is ``key=["value"],…`` metadata and line 2 the header.

    Both lines are known by their position in the file, whatever they or the data
    say; a data record that repeats the header stays.  The metadata is one row per
    file (values stripped of non-word characters, X13), joined back on the file path
    (broadcast only when the estimate proves it small).  ``meta_keys`` maps an output
    column to a case-insensitive key regex; ``columns`` names the cells in order.
    """
    meta_keys = dict(meta_keys or {"asin": "ASIN", "reporting_range": "Reporting Range"})
    heads = _first_lines(spark, path, glob, "UTF-8", 2)
    # metadata values hold quotes inside a cell, so its keys are found in the whole line
    meta = spark.createDataFrame([(file, lines[0]) for file, lines in heads], "source_file string, head string").select(
        "source_file", *[F.nullif(strip_non_word(F.regexp_extract("head", rf"(?i){key}[^=,]*=\[([^\]]*)\]", 1)), F.lit(""))
                         .alias(n) for n, key in meta_keys.items()])
    out = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in ("source_file", *columns)]))
    for head, names_of in _by_header(heads, 1).items():
        names = _names(head, ",", '"')
        cells = [(F.col(f"c{i}") if i < len(names) else F.lit(None).cast("string")).alias(c)
                 for i, c in enumerate(columns)]
        # Spark leaves out the first line; of the records that say what the header says one per file goes
        rows = _checked(_rows(spark, names_of, len(names), ",", '"', "UTF-8", True), "fail")
        header = F.lit(True)
        for i, name in enumerate(names):
            header = header & F.trim(f"c{i}").eqNullSafe(F.lit(name or None))
        again = (rows.where(header).groupBy("source_file").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                 .select("source_file", *[F.lit(name or None).cast("string").alias(f"c{i}") for i, name in enumerate(names)],
                         F.explode(F.sequence(F.lit(2), F.col("n")))))
        out = out.union(rows.where(~header).select("source_file", *cells)).union(again.select("source_file", *cells))
    return out.join(broadcast_if_small(meta), "source_file").select("source_file", *columns, *meta_keys)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | None = None, glob: str = "*.txt",
             encoding: str = "UTF-8", bad: str = "fail", quote: str | None = None) -> DataFrame:
    """Tab-separated reports, columns matched by header.  Without a schema
    every column is a string; with one, values are typed on read.  The reports do not
    quote: a quotation mark is text, unless ``quote`` names it."""
    return read_delimited(spark, path, schema, glob, "\t", encoding, bad, quote=quote)


def read_latin1_tsv(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """Fee-preview style TSV: latin-1, all strings."""
    return read_tsv(spark, path, None, glob, encoding="ISO-8859-1")


def read_wrapped_json(spark: SparkSession, path: str, schema: T.StructType, record_path: str,
                      glob: str = "*.json*", keep: Sequence[str] = ("source_file",)) -> DataFrame:
    """One JSON document per file wrapping a record array
    (``salesAndTrafficByAsin`` …): explode the array, flatten the records.  A
    document that cannot be parsed raises."""
    df = _json(spark, path, schema, glob, "fail", True).withColumn("source_file", source_file())
    return flatten(explode_records(df, record_path, keep=list(keep)))


def read_pages(spark: SparkSession, path: str, schema: T.StructType, record_path: str, glob: str = "*.json*",
               outer: bool = False) -> DataFrame:
    """Landed API pages as JSON lines, one page per line; the record list
    at ``record_path`` is exploded and flattened (``json_normalize(sep='_')``).  A
    page that cannot be parsed raises."""
    df = _json(spark, path, schema, glob, "fail", False).withColumn("source_file", source_file())
    return flatten(explode_records(df, record_path, keep=["source_file"], outer=outer))


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str | None = None,
             **options) -> DataFrame:
    """Choose the reader from the extension (csv / tsv / txt / json / parquet); a ``.gz`` at the
    end only says that the file is compressed, the extension before it counts."""
    name = path.rstrip("/").rsplit("/", 1)[-1].lower().removesuffix(".gz")
    ext = fmt or name.rsplit(".", 1)[-1]
    if ext == "json":
        return _reader(spark, schema, None, recursive=False, multiLine=True, mode="FAILFAST", **options).json(path)
    if ext in ("tsv", "txt"):
        return read_delimited(spark, path, schema, None, "\t", recursive=False, **{"quote": None, **options}).drop("source_file")
    if ext == "csv":
        return read_delimited(spark, path, schema, None, recursive=False, **options).drop("source_file")
    if ext == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported format {ext!r} (xls/xlsx are not read; convert to CSV)")


def explode_rates(df: DataFrame, base_col: str = "source", quotes_col: str = "quotes") -> DataFrame:
    """``{date: {pair: rate}}`` → ``(recorded_at, base, target, rate)``;
    ``target`` = last three characters of the pair, rate parsed from its text
    as ``decimal(38,18)``, so every digit that the payload gives is kept (no binary
    float on the way)."""
    kept = [c for c in ("loaded_at",) if c in df.columns]
    days = df.select(F.coalesce(F.col(base_col), F.lit("USD")).alias("base"), *kept,
                     F.explode(F.col(quotes_col)).alias("day", "pairs"))
    pairs = days.select("base", "day", *kept, F.explode("pairs").alias("pair", "rate"))
    return pairs.select(F.to_timestamp("day").alias("recorded_at"), "base", *kept,
                        F.right("pair", F.lit(3)).alias("target"),
                        F.col("rate").cast("string").cast("decimal(38,18)").alias("rate"))


def list_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """The files under ``path`` whose names match ``glob`` (with sizes and
    modification times), as a DataFrame, from one binary-file listing."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
            .load(path).select(F.col("path"), F.col("length"), F.col("modificationTime")))


def sqp_file_tags(path: Column | None = None) -> dict[str, Column]:
    """Marketplace and view (asin / brand) of a search-query report from its
    file name."""
    p = path if path is not None else source_file()
    return {"marketplace": F.nullif(F.regexp_extract(p, SEARCH_QUERY_COUNTRY, 1), F.lit("")),
            "view": F.lower(F.nullif(F.regexp_extract(p, SEARCH_QUERY_VIEW, 1), F.lit("")))}
