"""Block and allow decisions on urls, carried over to redirects and canonical links.

A url that a rule fits has the rule's verdict. Redirects (meta refresh) and canonical links tie
urls to one another; the classes of tied urls are connected components. A url without a rule is
blocked if its class holds a url that a rule blocks and none that a rule allows; an allow, its
own or one in its class, goes first. All else is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatewright.llm.components import components
from slatewright.session import written

# fixed values: verdict, host, path prefix
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?s).*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: str) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?s).*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: str, path: str, rules: list[tuple[str, str, str]]) -> Column:
    """rule and verdict of the longest rule that fits (the first listed of equally long ones); else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, own, prefix in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((F.col(host) == own) | F.col(host).endswith("." + own)) & F.col(path).startswith(prefix)
        found = F.when(fits, F.struct(F.lit(own + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _node(url: Column) -> Column:
    """A url as a node: without the fragment, which servers never see, and with scheme and host lower-cased."""
    whole = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    head = F.regexp_extract(whole, r"^(?s)(.*?://[^/?#]*)", 1)
    return F.concat(F.translate(head, _UPPER, _UPPER.lower()), F.substr(whole, F.length(head) + 1))


def resolved(base: Column, target: Column) -> Column:
    """A target against the url it was found at: absolute, ``//host/x``, ``/x``, ``?x`` or relative to the url's folder.

    Dot segments of the path go. Null for an empty target, one of a fragment alone, one of a scheme
    without ``://``, and a relative one on a url without ``://``.
    """
    whole = F.regexp_replace(F.trim(target), r"(?s)#.*$", "")
    site = F.regexp_extract(base, r"^(?s)(.*?://[^/?#]*)", 1)
    path = F.substr(F.regexp_replace(base, r"(?s)[?#].*$", ""), F.length(site) + 1)
    folder = F.concat(F.regexp_replace(path, "(?s)[^/]*$", ""), F.when(path.contains("/"), "").otherwise("/"))
    schemed = whole.rlike("^[A-Za-z][A-Za-z0-9+.-]*:")
    full = (
        F.when(whole.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), whole)
        .when(schemed | (whole == "") | (site == ""), F.lit(None))
        .when(whole.startswith("//"), F.concat(F.regexp_extract(site, r"^(?s)(.*?:)//", 1), whole))
        .when(whole.startswith("/"), F.concat(site, whole))
        .when(whole.startswith("?"), F.concat(site, path, whole))
        .otherwise(F.concat(site, folder, whole))
    )
    return _without_dots(full)


def _without_dots(url: Column) -> Column:
    """A url whose path has no ``.`` and ``..`` segments."""
    head = F.regexp_extract(url, r"^(?s)(.*?://[^/?]*)", 1)
    query = F.regexp_extract(url, r"(?s)(\?.*)$", 1)
    path = F.regexp_replace(F.substr(url, F.length(head) + 1), r"(?s)\?.*$", "")
    parts = F.split(path, "/")
    step = lambda kept, s: (
        F.when(s == ".", kept).when(s == "..", F.regexp_replace(kept, "/[^/]*$", "")).otherwise(F.concat(kept, F.lit("/"), s))
    )
    plain = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.lit(""), step)
    ending = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    return F.when(path.rlike(r"(^|/)[.][.]?(/|$)"), F.concat(head, plain, ending, query)).otherwise(url)


def alias_links(pages: DataFrame) -> DataFrame:
    """a, b: from each page's url to the urls it names as redirect target or canonical address, relative ones resolved."""
    low = F.coalesce("html", F.lit(""))
    tags = F.regexp_extract_all(low, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    marked = pages.where(F.col("url").isNotNull() & low.rlike(r"(?i)canonical|http-equiv"))
    tag = marked.select("url", F.explode(tags).alias("tag"))
    canonical = F.when(
        F.col("tag").rlike(r"""(?i)rel\s*=\s*["']?canonical\b"""),
        F.regexp_extract("tag", r"""(?is)href\s*=\s*["']?([^"'\s>]+)""", 1),
    )
    refresh = F.when(
        F.col("tag").rlike(r"""(?i)http-equiv\s*=\s*["']?refresh\b"""),
        F.regexp_extract("tag", r"""(?is)url\s*=\s*["']?([^"'\s>]+)""", 1),
    )
    target = F.replace(F.coalesce(canonical, refresh), F.lit("&amp;"), F.lit("&"))
    found = tag.select("url", target.alias("target")).where(F.col("target").isNotNull())
    found = found.select(_node(F.col("url")).alias("a"), _node(resolved(F.col("url"), F.col("target"))).alias("b"))
    return found.where(F.col("b").contains("://")).distinct()


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every page row.

    A null url or one without ``://`` has an empty host and path, fits no rule and is allowed.
    Null html names no alias; aliases may be relative urls. Repeated rows are judged alike; an empty table gives no rows.
    """
    links = written(alias_links(pages), "aliases")
    rows = pages.select("page_id", "url", host_of("url").alias("host"), path_of("url").alias("path"))
    rows = rows.withColumn("found", rule_of("host", "path", rules))
    own = rows.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("own"), "url")
    if links.isEmpty():
        return own.select("page_id", "host", "path", "rule", F.coalesce("own", F.lit("allow")).alias("verdict"))
    classes = components(links, "a", "b")
    nodes = classes.withColumns({"host": host_of("node"), "path": path_of("node")})
    nodes = nodes.withColumn("found", rule_of("host", "path", rules))
    blocked = nodes.groupBy("component").agg(
        F.max(F.col("found.verdict") == "block").alias("block"), F.max(F.col("found.verdict") == "allow").alias("allow")
    )
    stopped = blocked.where("block and not coalesce(allow, false)").select("component")
    stopped = written(classes.join(stopped, "component", "left_semi").select("node").distinct(), "stopped")
    marked = own.withColumn("node", _node(F.col("url"))).join(stopped.withColumn("stopped", F.lit(True)), "node", "left")
    verdict = F.coalesce("own", F.when(F.col("stopped"), "block"), F.lit("allow"))
    return marked.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
