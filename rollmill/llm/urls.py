"""URL filters that follow redirects: decisions spread over pages that name each other."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import ascii_lower, arrow_schema, small, written
from rollmill.llm.graph import components
from rollmill.plans.scale import attach


class Rule(NamedTuple):
    """A host with all its subdomains, and what their paths start with."""

    verdict: str
    host: str
    path: str


# The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

#: Tags that name another address of the page, and what hides such tags.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript)\b.*?(?:</\1\s*>|\Z)"
    r"""|<(link|meta|base)\b((?:"[^"]*"|'[^']*'|[^>"'])*)>""",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.S)
REFRESH = re.compile(r"""\s*[0-9.]*\s*[;,]?\s*url\s*=\s*["']?([^"']*)""", re.I)


def aliases(url: str | None, page: str | None) -> list[str]:
    """Absolute addresses that the page gives as its canonical link or as the target of a refresh, without fragments."""
    found, base = [], url or ""
    for m in TAG.finditer(page or ""):
        tag = (m[2] or "").lower()
        if not tag:
            continue
        have = {k.lower(): entities.unescape(a or b or c) for k, a, b, c in reversed(ATTRIBUTE.findall(m[3]))}
        if tag == "base":
            base = joined(base, have.get("href", ""))
        elif tag == "link" and "canonical" in have.get("rel", "").lower().split():
            found.append(joined(base, have.get("href", "")))
        elif tag == "meta" and have.get("http-equiv", "").lower() == "refresh":
            target = REFRESH.match(have.get("content", ""))
            found.append(joined(base, target[1]) if target else "")
    return sorted({f.split("#")[0] for f in found if "://" in f})


def joined(base: str, target: str) -> str:
    """`target` seen from `base`; '' if it is none or no address."""
    try:
        return urljoin(base, target.strip()) if target.strip() else ""
    except ValueError:
        return ""


def with_aliases(pages: DataFrame) -> DataFrame:
    """url, alias: the addresses that each page names as its own."""
    schema = "url string, alias string"
    arrow = arrow_schema(pages.sparkSession, schema)

    def work(batches):
        for b in small(batches):
            pairs = [(u, a) for u, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for a in aliases(u, h)]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)], schema=arrow)

    return pages.select("url", "html").mapInArrow(work, schema)


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z in lower case; '' without ://."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def judged(df: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """`df` with host, path, rule (host and path of the longest that fits, else NULL) and ruled (its verdict).

    Of rules that are equally long, an allow wins. The rules are expressions of the plan: some hundreds at most.
    """
    df = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    longest_last = sorted(rules, key=lambda r: (len(r.host) + len(r.path), r.verdict == "allow"))

    def pick(rest: Column, r: Rule) -> Column:
        on_host = (F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))
        value = F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("ruled"))
        return F.when(on_host & F.startswith("path", F.lit(r.path)), value).otherwise(rest)

    nothing = F.lit(None).cast("struct<rule:string,ruled:string>")
    return df.withColumn("_r", reduce(pick, longest_last, nothing)).select("*", "_r.rule", "_r.ruled").drop("_r")


def bare(url: Column) -> Column:
    """The address without its fragment, as a 64-bit hash."""
    return F.xxhash64(F.regexp_replace(url, r"(?s)#.*", ""))


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Columns page_id, url, host, path, rule, verdict (allow or block), component, blocked; one row per input row.

    1. The longest rule that fits a page's own address decides: an explicit allow (or block) holds whatever its aliases do.
    2. Pages without one are aliases of what they name as canonical link or refresh target, whether that is a page
       here or not. If any address of the connected component is blocked by a rule, so are they; otherwise they are allowed.

    `component` is NULL for addresses without links, `blocked` tells whether the component holds a blocked address. Equal
    addresses are one node, a fragment (#...) makes no other. NULL or malformed addresses have host and path '' and are
    allowed, NULL or empty html names nothing. Other columns are not read. Empty tables give no rows. Hosts that everyone
    links to are hubs: their edges are grouped in parts, joined by skew-safe joins, never gathered. Addresses are 64-bit hashes.
    """
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    links = written(with_aliases(named), "links")
    edges = links.select(bare(F.col("url")).alias("a"), bare(F.col("alias")).alias("b")).where("a != b")
    roots = components(edges)
    sides = links.select(F.explode(F.array("url", "alias")).alias("url")).withColumn("node", bare(F.col("url")))
    blocks = judged(sides, rules).where("ruled = 'block'").select("node").distinct()
    barred = attach(roots, blocks.withColumn("hit", F.lit(True)), ["node"])
    verdicts = barred.groupBy("root").agg(F.coalesce(F.bool_or("hit"), F.lit(False)).alias("blocked"))
    known = attach(roots, verdicts, ["root"]).withColumnsRenamed({"node": "_node", "root": "component"})
    rows = judged(named.select("page_id", "url"), rules).withColumn("_node", bare(F.col("url")))
    found = attach(rows, known, ["_node"])
    spread = F.when(F.coalesce("blocked", F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        "page_id", "url", "host", "path", "rule", F.coalesce("ruled", spread).alias("verdict"), "component", F.coalesce("blocked", F.lit(False)).alias("blocked")
    )
