"""URL filters: rules by host and path, and block decisions carried over redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Work, fresh, hint_if_small, lower_ascii
from shelfwise.llm.components import components

ALLOW, BLOCK = "allow", "block"
#: rule and verdict; a rule is a host, which stands for its subdomains too, and the start of a path
RULES = (
    ("org/", ALLOW),
    ("example.org/es/", BLOCK),
    ("example.org/en/1", BLOCK),
    ("com/fr/", ALLOW),
    ("com/de/", BLOCK),
)

_AUTHORITY = r"^.*?://([^/?#]*)"
_PATH = r"^.*?://[^/?#]*([^?#]*)"
_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
_REL = r"""(?is)\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_REFRESH = r"""(?is)\bhttp-equiv\s*=\s*["']?refresh\b"""
_CONTENT = r"""(?is)\bcontent\s*=\s*(?:"([^"]*)"|'([^']*)')"""
_TARGET = r"""(?is);\s*url\s*=\s*['"]?\s*([^'"]*?)\s*['"]?\s*$"""


def host(url: Column) -> Column:
    """After the first :// up to a slash, question mark, hash or the end, with A-Z in small letters."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, "(?s)" + _AUTHORITY, 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)" + _PATH, 1), F.lit(""))


def address(url: Column) -> Column:
    """A url as a node of the alias graph: without its fragment, scheme and host in small letters."""
    bare = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    scheme = lower_ascii(F.regexp_extract(bare, r"(?s)^(.*?)://", 1))
    rest = F.regexp_extract(bare, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    return F.when(F.locate("://", bare) > 0, F.concat(scheme, F.lit("://"), host(bare), rest))


def resolved(link: Column, base: Column) -> Column:
    """A link as an absolute url: absolute, scheme-relative, host-relative or relative to the page's folder."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(base, "(?s)" + _AUTHORITY, 1))
    folder = F.concat(root, F.regexp_replace(F.concat(F.lit("/"), F.ltrim(F.lit("/"), path(base))), r"(?s)[^/]*$", ""))
    return (
        F.when((link == "") | link.isNull(), F.lit(None))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(root, path(base), link))
        .when(link.startswith("#") | link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(folder, link))
    )


def _attribute(tag: Column, pattern: str, groups: int) -> Column:
    found = F.concat(*(F.regexp_extract(tag, pattern, g) for g in range(1, groups + 1)))
    return F.trim(F.replace(found, F.lit("&amp;"), F.lit("&")))


def links(pages: DataFrame) -> DataFrame:
    """src and dst: the addresses of pages and of their canonical links and redirects."""
    tags = pages.select("url", F.explode(F.regexp_extract_all("html", F.lit(_TAG), 0)).alias("tag"))
    # step by step, so that each long expression is evaluated once
    tags = tags.filter(F.col("tag").rlike(_REL) | F.col("tag").rlike(_REFRESH))
    hrefs = tags.select("url", "tag", _attribute(F.col("tag"), _HREF, 3).alias("href"))
    found = hrefs.select(
        "url",
        F.when(F.col("tag").rlike(_REL), F.col("href"))
        .otherwise(F.regexp_extract(_attribute(F.col("tag"), _CONTENT, 2), _TARGET, 1))
        .alias("link"),
    )
    whole = found.select("url", resolved(F.col("link"), F.col("url")).alias("target"))
    ends = whole.select(address(F.col("url")).alias("src"), address(F.col("target")).alias("dst"))
    return ends.filter("src IS NOT NULL AND dst IS NOT NULL AND src != dst")


def ruled(pages: DataFrame, rules: DataFrame, work: Work) -> DataFrame:
    """pages with host, path, rule and ruling of the longest rule that fits, else null.

    A host is looked up by each of its endings at a dot (as many as it has labels), an
    equi-join with the rules' hosts; the longest rule is a maximum of what comes back.
    Each url is judged once, in its own row: the lookup gives an array of the few rules for a
    host's endings, for rules that are broadcast.
    """
    parts = rules.select(
        "rule",
        F.col("verdict").alias("ruling"),
        lower_ascii(F.substring_index("rule", "/", 1)).alias("rule_host"),
        F.expr("substring(rule, locate('/', rule))").alias("rule_path"),
    ).filter("rule LIKE '%/%'")
    by_host = parts.groupBy("rule_host").agg(F.collect_list(F.struct("rule_path", "rule", "ruling")).alias("rules"))
    table = hint_if_small(by_host.select("rule_host", F.explode("rules").alias("r")).select("rule_host", "r.*"), work)
    hosts = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    ending = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."),
    )
    ends = hosts.select("host", "path", F.explode(ending).alias("rule_host"))
    hits = ends.join(table, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    # of equal rules, an allowing one
    best = F.min_by(F.struct("rule", "ruling"), F.struct(-F.length("rule"), "ruling")).alias("best")
    chosen = hits.groupBy("host", "path").agg(best).select("host", "path", "best.*")
    return pages.join(chosen, ["host", "path"], "left")


def judged(pages: DataFrame, rules: DataFrame, work: Work) -> DataFrame:
    """page_id, host, path, rule, verdict and alias_group of each row of pages.

    A page with a rule has the rule's verdict, whatever its aliases have. One without a rule
    is blocked if one of its aliases is blocked by a rule and none is allowed by one:
    aliases are all addresses that redirects and canonical links connect, in either direction and
    over any number of steps, whether they are pages here or not. All others are allowed.
    A null url, or one without ://, has an empty host and path, no rule and no aliases. Null
    html has no links. alias_group is the smallest address of the aliases, else null.
    """
    page_id = F.col("page_id").cast("long").alias("page_id")
    seen = pages.select(
        page_id, host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), address(F.col("url")).alias("node")
    )
    rows = work.keep(ruled(seen, rules, work))
    edges = work.keep(links(pages).distinct())
    groups = work.keep(components(edges, work))
    known = rows.join(groups, "node", "left").withColumn("alias_group", F.coalesce("component", "node"))
    # the rules judge all addresses of a group, also those that are no pages here
    ends = groups.select("component", host(F.col("node")).alias("host"), path(F.col("node")).alias("path"))
    named = ruled(ends, rules, work).filter("rule IS NOT NULL").withColumnRenamed("component", "alias_group")
    rulings = named.groupBy("alias_group").agg(F.min("ruling").alias("first"))
    # "allow" sorts before "block": the first is "block" only if there is nothing else
    blocked = rulings.filter(F.col("first") == BLOCK).select("alias_group", F.lit(True).alias("blocked"))
    found = known.join(blocked, "alias_group", "left")
    verdict = F.coalesce("ruling", F.when(F.col("blocked"), F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "alias_group")


def rule_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "rule string, verdict string")


def drop_blocked(pages: DataFrame, rules: DataFrame, work: Work) -> DataFrame:
    """The rows of pages that are allowed; all columns pass through, null ids included."""
    key = fresh(pages, "row_key")
    keyed = pages.withColumn(key, F.xxhash64("page_id", "url"))
    numbered = keyed.select(F.col(key).alias("page_id"), "url", "html")
    gone = hint_if_small(judged(numbered, rules, work).filter(F.col("verdict") == BLOCK).select("page_id"), work)
    return keyed.join(gone, keyed[key] == gone["page_id"], "left_anti").drop(key)
