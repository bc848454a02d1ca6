"""URL filter with redirect equivalence.

Rules (host, path prefix, action) judge urls; the longest rule that fits wins. Urls that a redirect or a
canonical link joins are aliases: a page without a rule of its own takes the decision of its connected
component, block if some alias is blocked, but allow if some alias is allowed by a rule. A page's own
rule always comes first. Components are found by distributed steps over the link table.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import words as W
from shelfrank.llm.components import components
from shelfrank.llm.tables import Scratch

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # host, path with its leading slash, "block" or "allow"


def rest_of(url: Column) -> Column:
    """What follows the first "://"; empty for a null url or one without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(rest_of(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """Identity of a url: scheme and host lower-cased, without fragment, as 16 bytes; null for a null url
    or one without "://"."""
    at = F.instr(url, "://")
    scheme = F.translate(F.substr(url, F.lit(1), F.greatest(at - 1, F.lit(0))), _UPPER, _LOWER)
    after = F.regexp_extract(rest_of(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(at > 0, F.unhex(F.md5(F.concat(scheme, F.lit("://"), host_of(url), after))))


def judge(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct<rule, action> of the longest rule that fits, null fields if none does. A rule fits its host
    and the host's subdomains if the path starts with the rule's. The rules are a list in the program, so
    they are small; of equally long ones the first in order wins."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, said in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r), reverse=True):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, action = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(action)
    return F.struct(rule.alias("rule"), action.alias("action"))


_HIDDEN = re.compile(r"<(?:!--|(script|style|noscript|template)\b)", re.I)
_TAG = re.compile(r"<(link|meta)\b((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.I)
# Possessive, and names only from their first letter on, so that no input takes quadratic time.
_ATTR = re.compile(r"(?<![A-Za-z-])([A-Za-z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_REFRESH = re.compile(r"^\s*+[\d.]*+\s*+[;,]?+\s*+url\s*+=\s*+[\"']?+([^\"']+)", re.I)


def shown(page: str) -> str:
    """The page without comments and the bodies of scripts, styles, noscripts and templates, in one forward scan. What is
    never closed goes to the end of the page, as in a browser."""
    low = page.lower() if page.isascii() else re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), page)  # positions stay
    out, at = [], 0
    while (m := _HIDDEN.search(page, at)) is not None:
        out.append(page[at:m.start()])
        closing = f"</{m[1].lower()}" if m[1] else "-->"
        at = low.find(closing, m.end())
        while at >= 0 and m[1]:  # the name ends there, but for blanks
            end = at + len(closing)
            while page[end:end + 1].isspace():
                end += 1
            if page[end:end + 1] == ">":
                at = end + 1
                break
            at = low.find(closing, at + 1 if end == at + len(closing) else end)
        if at < 0:
            return "".join(out)
        at += 0 if m[1] else 3
    return "".join(out) + page[at:]


def targets(url: str, page: str) -> list[str]:
    """Absolute targets of a page's canonical links and refresh redirects, outside comments and scripts."""
    out = []
    for tag, inside in _TAG.findall(shown(page)):
        attrs = {k.lower(): entities.unescape(a or b or c) for k, a, b, c in _ATTR.findall(inside)}
        found = None
        if tag.lower() == "link" and "canonical" in attrs.get("rel", "").lower().split():
            found = attrs.get("href")
        elif tag.lower() == "meta" and attrs.get("http-equiv", "").lower() == "refresh":
            m = _REFRESH.match(attrs.get("content", ""))
            found = m[1] if m else None
        if found and found.strip():
            try:
                out.append(urljoin(url, found.strip()))
            except ValueError:  # no url, such as an open IPv6 bracket
                continue
    return out


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo, hi in W.slices(whole.column("html")):
            batch = whole.slice(lo, hi - lo)
            pairs = [(u, t) for u, h in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()) for t in targets(u, h)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())],
                                             names=["src", "dst"])


def links(pages: DataFrame) -> DataFrame:
    """(src, dst) urls of the canonical links and refresh redirects of pages (url, html)."""
    text = F.lower(F.col("html"))
    some = pages.where(F.col("url").isNotNull() & (text.contains("canonical") | text.contains("refresh"))).select("url", "html")
    return some.mapInArrow(_links, "src string, dst string")


def decide(spark: SparkSession, pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of pages (page_id, url, html, ...).

    ``redirects`` (src, dst urls), for example of HTTP answers, joins the links found in the pages. A null
    url, or one without "://", has empty host and path, no aliases, and is allowed. Rows that repeat a url
    share its component; rows stay one for one. Targets that are no page pass decisions on, and count with
    the rules that fit them. Targets that are no url at all (such as an open IPv6 bracket) are no links. A very long
    page is scanned once, in time linear in its length.
    """
    scratch = Scratch(spark, "url-filter")
    found = links(pages)
    if redirects is not None:
        found = found.union(redirects.select(F.col("src").cast("string"), F.col("dst").cast("string")))
    edges = scratch.table(found.select(
        "src", "dst", node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b")).where("a <> b"), "links")
    url = F.col("url").cast("string")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    judged = judged.withColumn("own", judge(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", "node", F.col("own.rule").alias("rule"), F.col("own.action").alias("action"))
    if edges.isEmpty():
        return judged.select("page_id", "host", "path", "rule", F.coalesce("action", F.lit("allow")).alias("verdict"))
    parts = scratch.table(components(scratch, edges), "components")
    ends = edges.select(F.col("src").alias("url"), F.col("a").alias("node")).union(
        edges.select(F.col("dst").alias("url"), F.col("b").alias("node")))
    actions = ends.withColumn("own", judge(host_of(F.col("url")), path_of(F.col("url")), rules)).where(
        "own.action is not null").select("node", F.col("own.action").alias("action"))
    decided = actions.join(parts, "node").groupBy("component").agg(
        F.when(F.bool_or(F.col("action") == "allow"), "allow").otherwise("block").alias("shared"))
    by_node = scratch.table(parts.join(decided, "component").select("node", "shared"), "decisions")
    scratch.drop("components", "links")
    return judged.join(by_node, "node", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("action", "shared", F.lit("allow")).alias("verdict"))
