"""Registered queries of the operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import (embedding_dedup, exact_dedup, langid, license_scan, merkle, minhash_dedup, mixing,
                            periodic_runs, sentencepiece_bpe, suffix_dedup, toxicity, url_filters, warc)
from marketlake.llm._util import pick

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(table(spark, sf_dir, "documents")))


@register
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    back = warc.read_bundles(warc.archive(pages))
    kind = pages.schema["page_id"].dataType
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


ORACLES["op2_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


@register
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, where=langid.learnable(F.col("doc_id")))
    held_out = F.coalesce(~langid.learnable(F.col("doc_id")), F.lit(False))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score",
                                              "cross_entropy", "rejected")


@register
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), where=toxicity.learnable(F.col("doc_id")))
    held_out = F.coalesce(~toxicity.learnable(F.col("doc_id")), F.lit(False))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@register
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filters.BASE_RULES + url_filters.default_patterns()
    judged = url_filters.judge(table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "pattern", "verdict")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rule_rows(rules) -> str:
    return ", ".join(f"({_quoted(r.text)}, {_quoted('(?s)' + r.regex)}, {_quoted(r.action)})" for r in rules)


ORACLES["op6_url_filters"] = f"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
s AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path,
             translate(rest, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS whole FROM h),
base(t, r, a) AS (VALUES {_rule_rows(url_filters.BASE_RULES)}),
pat(t, r, a) AS (VALUES {_rule_rows(url_filters.default_patterns())}),
b AS (SELECT s.page_id, s.host, s.path, arg_max(base.t, length(base.t)) AS rule,
             arg_max(base.a, length(base.t)) AS a
      FROM s LEFT JOIN base ON regexp_matches(s.host || s.path, base.r) GROUP BY ALL),
p AS (SELECT s.page_id, min(pat.t) AS pattern, min(pat.a) AS a
      FROM s LEFT JOIN pat ON regexp_matches(s.whole, pat.r) GROUP BY ALL)
SELECT b.page_id, b.host, b.path, b.rule, p.pattern, coalesce(b.a, p.a, 'allow') AS verdict
FROM b JOIN p USING (page_id)
"""


@register
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op7_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS s FROM documents),
     k AS (SELECT doc_id, s, first_value(doc_id) OVER (PARTITION BY s ORDER BY n DESC, doc_id) AS keep_id,
                  count(*) OVER (PARTITION BY s) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, s AS text_sha256 FROM k
"""


@register
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


ORACLES["op8_mixing"] = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, (ARRAY[5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS w,
              3 * source_size AS cap FROM s0),
s2 AS (SELECT *, cap / w AS fill FROM s1),
s3 AS (SELECT *, row_number() OVER (ORDER BY fill, source NULLS LAST) AS rank, (sum(source_size) OVER () - coalesce(sum(cap) OVER q, 0))
                 / (sum(w) OVER () - coalesce(sum(w) OVER q, 0)) AS level
       FROM s2 WINDOW q AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), w * (
         SELECT coalesce(arg_min(level, rank), 0) FROM s3 WHERE level <= fill)) AS target FROM s3),
s5 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM s4),
c AS (SELECT d.*, s5.source_size, s5.target, s5.whole,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN s5 ON d.source IS NOT DISTINCT FROM s5.source),
k AS (SELECT *, CAST(whole AS BIGINT) + CASE WHEN size > 0 AND before + size / 2 < target - whole * source_size
                                             THEN 1 ELSE 0 END AS copies FROM c)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, copies, CAST(size * copies AS BIGINT) AS taken FROM k
"""


@register
def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


PIECE_MODEL = "piece_bpe_32k.model"


def piece_model_path() -> str:
    """The public model that the registered query and the pipeline use."""
    import public_tokenizers
    return public_tokenizers.path(PIECE_MODEL)


@register
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    return sentencepiece_bpe.digests(sentencepiece_bpe.encode_decode(docs, piece_model_path()))


@register
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


# text in hexadecimal, so that a window is a plain substring
ORACLES["op11_suffix_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT rid, doc_id, p, substr(x, CAST(2 * p + 1 AS BIGINT), 100) AS s
      FROM (SELECT rid, doc_id, x, unnest(range(CAST(length(x) // 2 - 49 AS BIGINT))) AS p FROM d WHERE length(x) >= 100)),
m AS (SELECT rid, p FROM (SELECT rid, doc_id, p, min(doc_id) OVER (PARTITION BY s) AS least FROM w)
      WHERE least < coalesce(doc_id, 9223372036854775807)),
g AS (SELECT rid, p, CASE WHEN p <= lag(p) OVER o + 50 THEN 0 ELSE 1 END AS new FROM m WINDOW o AS (PARTITION BY rid ORDER BY p)),
i AS (SELECT rid, p, sum(new) OVER (PARTITION BY rid ORDER BY p) AS k FROM g),
r AS (SELECT rid, k, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY rid, k),
e AS (SELECT rid, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends
      FROM r GROUP BY rid),
k AS (SELECT d.rid, d.doc_id, d.t, d.x, e.n_spans, e.n_removed, e.starts || [length(d.x) // 2] AS starts, [0] || e.ends AS ends
      FROM d LEFT JOIN e ON d.rid = e.rid)
SELECT doc_id, CAST(strlen(t) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       CASE WHEN n_spans IS NULL THEN sha256(t) ELSE sha256(unhex(array_to_string(list_transform(range(1, len(starts) + 1),
         lambda j: substr(x, CAST(2 * ends[j] + 1 AS BIGINT), CAST(2 * (starts[j] - ends[j]) AS BIGINT))), ''))) END AS kept_sha256
FROM k
"""


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text; where 10 divides h, the id's CRC-32, the words from a on repeat p words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    split = pick(docs, doc_id="doc_id", text="text").select("doc_id", "text", F.when(
        h % 10 == 0, F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0))).alias("words"))
    n = F.size("words")
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    turns = F.floor((n - a) / p).cast("int") + 1
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, p), turns)), F.lit(1), n - a)
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return split.select("doc_id", F.when(n > 0, changed).otherwise(F.col("text")).alias("text"))


@register
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
                       (-F.col("best.short")).alias("period"),
                       F.expr("1000 * best.length div -best.short").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


def _tampered(text: Column) -> Column:
    """Where 5 divides the id's CRC-32, the text with A-Z in lower case."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lowered).otherwise(text)


@register
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = merkle.manifest(table(spark, sf_dir, "documents"), claim={"text": _tampered(F.col("f_text"))})
    folded = signed.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
                           merkle.fold(F.col("claimed"), F.col("proof")).alias("folded_root"))
    return folded.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


def _merkle_sql(levels: int = 8, top_levels: int = 6) -> str:
    """The manifest of up to 16 ** levels rows a source and 16 ** top_levels sources, level by level."""
    def tree(name: str, height: int) -> list[str]:
        out = []
        for j in range(height):
            out.append(f"""{name}s{j} AS (SELECT k, i, n, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
  AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{j} WINDOW w AS (PARTITION BY k, i // 16 ORDER BY i))""")
            out.append(f"""{name}{j + 1} AS (SELECT k, i // 16 AS i, CASE WHEN n = 1 THEN 1 ELSE (n + 15) // 16 END AS n,
  CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{j} GROUP BY k, i // 16, n)""")
        return out

    def climb(rows: str, name: str, height: int) -> list[str]:
        return [f"""{rows}{j + 1} AS (SELECT p.* EXCLUDE (i, acc, proof), p.i // 16 AS i,
  CASE WHEN s.n = 1 THEN p.acc ELSE sha256(s.l || p.acc || s.r) END AS acc,
  CASE WHEN s.n = 1 THEN p.proof ELSE p.proof || s.l || s.r END AS proof
  FROM {rows}{j} p JOIN {name}s{j} s ON p.k = s.k AND p.i = s.i)""" for j in range(height)]

    def field(x: str) -> str:
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END"

    head = " || ".join(field(x) for x in ("doc_id", "source", "lang", "n_chars"))
    parts = [
        # the table of CRC-32: eight shifts of every byte
        """c0 AS (SELECT range AS b, list_reduce([range] || [0, 0, 0, 0, 0, 0, 0, 0],
  lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256))""",
        "c1 AS (SELECT list(v ORDER BY b) AS t FROM c0)",
        """c2 AS (SELECT d.*, xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: CAST(ascii(c) AS BIGINT)), lambda x, y: xor(x >> 8, c1.t[(xor(x, y) & 255) + 1])), 4294967295) AS crc
  FROM documents d, c1)""",
        """c3 AS (SELECT *, CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other FROM c2)""",
        f"c4 AS (SELECT doc_id, source, sha256({head} || {field('text')}) AS leaf, sha256({head} || {field('other')}) AS claimed FROM c3)",
        """c5 AS (SELECT *, coalesce('=' || source, '') AS k, count(*) OVER (PARTITION BY source) AS n,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS i FROM c4)""",
        "a0 AS (SELECT k, i, n, leaf AS h FROM c5)", *tree("a", levels),
        f"b0 AS (SELECT '' AS k, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n, h, k AS g FROM a{levels})",
        *tree("b", top_levels),
        "p0 AS (SELECT doc_id, leaf, k, i, claimed AS acc, '' AS proof FROM c5)", *climb("p", "a", levels),
        f"""q0 AS (SELECT p.doc_id, p.leaf, b0.h AS subroot, b0.k, b0.i, p.acc, p.proof
  FROM p{levels} p JOIN b0 ON p.k = b0.g)""", *climb("q", "b", top_levels)]
    return "WITH " + ",\n".join(parts) + f"""
SELECT q.doc_id, q.leaf, q.subroot, b.h AS root, sha256(q.proof) AS proof_sha256, q.acc AS folded_root, q.acc = b.h AS verified
FROM q{top_levels} q, b{top_levels} b
"""


ORACLES["op13_merkle_manifest"] = _merkle_sql()
