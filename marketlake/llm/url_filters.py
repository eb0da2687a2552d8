"""URL filters: pattern rules indexed by their rarest literal token.

A rule is written as ``host/path`` (fits the host and all its subdomains, and
paths that start with the rule's) or as a pattern over the URL with ``*`` for any
characters and ``^`` for a separator.  Every rule becomes one regular expression.
Only some URLs can match a rule: those that contain its literal tokens, the
maximal ``[a-z0-9]+`` runs that the rule delimits on both sides.  The index files
each rule under the token that the fewest URLs of the corpus contain, counted
over all of them.  A URL's own tokens then fetch its candidate rules, and only
those run their expressions.  Rules without a delimited token are tried on every
URL.

Rules are a parameter, at most ``MAX_RULES`` of them (checked); the index goes to
the workers inside the task closure.  The token counts that reach the driver are
limited to tokens of rules.

Null URLs and URLs without ``://`` have an empty host and path and match no rule.
Repeated rows and null ids stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm._util import pick

MAX_RULES = 200_000
_TOKEN = re.compile(r"[a-z0-9]+")
_SPECIAL = re.compile(r"([.\\+?()\[\]{}|$])")


@dataclass(frozen=True)
class Rule:
    """``text`` is what results name; ``base`` rules beat patterns, the longest text first."""
    text: str
    action: str
    base: bool = False

    @property
    def regex(self) -> str:
        """Over host + rest of the URL; base rules over host + path."""
        if self.base:
            return r"^([^/]*\.)?" + _SPECIAL.sub(r"\\\1", self.text)
        body = _SPECIAL.sub(r"\\\1", self.text)
        return body.replace("*", ".*").replace("^", "([^a-z0-9]|^|$)")

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that every matching URL has as whole tokens."""
        t = self.text.lower()
        found = []
        for m in _TOKEN.finditer(t):
            left = t[m.start() - 1] if m.start() else ("^" if self.base else "*")
            right = t[m.end()] if m.end() < len(t) else "*"
            if left != "*" and right != "*":
                found.append(m.group())
        return sorted(set(found))


# --- fixed values: base rules of the registered query -----------------------------------------
BASE_RULES = (
    Rule("org/", "allow", True),
    Rule("example.org/es/", "block", True),
    Rule("example.org/en/1", "block", True),
    Rule("com/fr/", "allow", True),
    Rule("com/de/", "block", True),
)
# --- our own pattern rules: unwanted kinds of sites and pages, each in the usual forms --------
SITE_KINDS = ("adserver", "ads", "adclick", "banners", "doubleclick", "casino", "poker", "betting", "porn", "xxx",
              "escort", "viagra", "malware", "phishing", "warez", "torrent", "keygen", "popunder")
PAGE_KINDS = ("adclick", "adserve", "banner-ads", "popup-ads", "track-click", "casino-bonus", "xxx-videos",
              "cheap-viagra", "crack-download", "keygen-download", "free-porn", "torrent-download")


def default_patterns() -> tuple[Rule, ...]:
    """Host-label forms of each kind of site and path-segment forms of each kind of page."""
    hosts = [Rule(form % kind, "block") for kind in SITE_KINDS for form in (".%s.", "^%s.*/", "-%s.*/", "/%s/")]
    pages = [Rule(form % kind, "block") for kind in PAGE_KINDS for form in ("/%s/", "/%s.", "/%s?", "?page=%s^")]
    return tuple(hosts + pages)


# --- URL parts (DataFrame expressions) ---------------------------------------------------------

def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3)))


def ascii_lower(col: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(col, upper, upper.lower())


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """host (A-Z lower-cased), path, and the whole rest after the host; empty without ``://``."""
    rest = F.coalesce(after_scheme(url), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substr(rest, F.length(host) + F.lit(1))
    return ascii_lower(host), F.regexp_extract(tail, r"^[^?#]*", 0), tail


def token_counts(urls: DataFrame, wanted: Iterable[str]) -> dict[str, int]:
    """Number of URLs (column ``all``) per wanted token, over all rows."""
    words = sorted(set(wanted))
    tokens = F.array_intersect(F.split(ascii_lower(F.col("all")), r"[^a-z0-9]+"), F.lit(words))
    counted = urls.select(F.explode(tokens).alias("token")).groupBy("token").count()
    return {r["token"]: r["count"] for r in counted.collect()}   # at most one row per rule token


def build_index(rules: Iterable[Rule], counts: dict[str, int]) -> tuple[dict[str, list[Rule]], list[Rule]]:
    """(token -> rules filed under it, rules that have no token)."""
    index: dict[str, list[Rule]] = {}
    loose: list[Rule] = []
    for rule in rules:
        if rule.tokens:
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
            index.setdefault(rarest, []).append(rule)
        else:
            loose.append(rule)
    return index, loose


def judge(df: DataFrame, rules: Iterable[Rule], id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (longest base rule that fits), pattern (first pattern rule that
    matches, by text), verdict (that of the base rule, else of the pattern, else ``default``),
    candidates (rules tried)."""
    rules = tuple(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the index is sent to every worker and holds {MAX_RULES} at most")
    src = pick(df, page_id=id_col, url=url_col)
    host, path, tail = url_parts(F.col("url"))
    parts = src.select("page_id", host.alias("host"), path.alias("path"), tail.alias("tail"))
    urls = parts.select(F.concat("host", "tail").alias("all"))
    index, loose = build_index(rules, token_counts(urls, (t for r in rules for t in r.tokens)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled: dict[Rule, re.Pattern] = {}

        def fits(rule: Rule, base: str, url: str) -> bool:
            if rule not in compiled:
                compiled[rule] = re.compile(rule.regex, re.DOTALL)
            return compiled[rule].search(base if rule.base else url) is not None

        lower = {c: c + 32 for c in range(65, 91)}
        for pdf in batches:
            named, patterns, verdicts, tried = [], [], [], []
            for h, p, t in zip(pdf["host"], pdf["path"], pdf["tail"], strict=True):
                base, url = h + p, h + t.translate(lower)
                candidates = loose + [r for tok in set(_TOKEN.findall(url)) for r in index.get(tok, ())]
                hits = [r for r in candidates if fits(r, base, url)] if h or t else []
                best = max((r for r in hits if r.base), key=lambda r: len(r.text), default=None)
                other = min((r for r in hits if not r.base), key=lambda r: r.text, default=None)
                named.append(best and best.text)
                patterns.append(other and other.text)
                verdicts.append(best.action if best else other.action if other else default)
                tried.append(len(candidates))
            yield pdf[["page_id", "host", "path"]].assign(rule=named, pattern=patterns, verdict=verdicts,
                                                          candidates=tried)

    id_type = parts.schema["page_id"].dataType.simpleString()
    # nullable ids travel as text, pandas would turn them into floats
    out = parts.withColumn("page_id", F.col("page_id").cast("string")).mapInPandas(
        run, "page_id string, host string, path string, rule string, pattern string, verdict string, candidates long")
    return out.withColumn("page_id", F.col("page_id").cast(id_type))
