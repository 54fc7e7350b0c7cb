"""URL filter whose block decisions hold for all addresses of a page.

Rules name a host, its subdomains with it, and the start of a path. Pages name other addresses of themselves: ``<link rel="canonical">`` and ``<meta http-equiv="refresh">``
in their html, and, where given, a table of redirects as a crawler met them. These edges join addresses into classes (distributed connected components). An address
with a rule of its own gets that rule's verdict, so that an explicit allow takes precedence; any other is blocked if a rule blocks some address of its class, crawled or not, and allowed if not.

An address is host, path (at least ``/``) and query: scheme, fragment and upper case in the host do not tell pages apart. Links are resolved against the page's url; steps
``./`` and ``../`` are taken as they stand. Comments and scripts hold no links. Only edges and the addresses of pages without a rule are shuffled, never html; an address that very many edges or pages share
is split.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule and no aliases, and is allowed; null or empty html has no links; repeated pages are rows of their
own; an empty table gives no rows; a link to the page itself changes nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import ascii_lower, row_key, spread_join, stored, table, text_or_empty
from ledgerlens.llm.components import connected_components


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: The rules of the query.
RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]

#: Parts of html, for Java's and RE2's regular expressions alike.
_NO_LINKS = r"(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script|$)"
_TAGS = r"(?is)<(?:link|meta)\s[^>]*>"
_CANONICAL = r"""(?is)\srel\s*=\s*(?:"(?:[^"]*\s)?canonical[\s"]|'(?:[^']*\s)?canonical[\s']|canonical[\s/>])"""
_REFRESH = r"""(?is)\shttp-equiv\s*=\s*["']?refresh["'\s/>]"""
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_HREF, _CONTENT = r"(?is)\shref" + _VALUE, r"(?is)\scontent" + _VALUE
_TARGET = r"""(?is)url\s*=\s*["']?([^"']+)"""
_URL = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\??[^#]*)"


def with_parts(df: DataFrame, url: str, head: str = "") -> DataFrame:
    """Adds ``scheme``, ``host`` (A-Z in lower case), ``path`` and ``query`` with its ``?``, named after ``head``; all empty without ``://``."""
    text = text_or_empty(F.col(url))
    parts = [F.regexp_extract(text, _URL, k) for k in (1, 2, 3, 4)]
    return df.withColumns({f"{head}scheme": parts[0], f"{head}host": ascii_lower(parts[1]), f"{head}path": parts[2], f"{head}query": parts[3]})


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; of equally long ones an allowing one, then by name. Null if none fits."""
    fitting = [F.lit(None).cast("struct<rule: string, verdict: string>")]
    for r in sorted(rules, key=lambda r: (-len(r.host + r.path), r.verdict, r.host, r.path)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        fitting.insert(-1, F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))))
    return F.coalesce(*fitting)


def address_of(head: str = "") -> Column:
    """What tells pages apart, from the columns of ``with_parts``; null without a host."""
    host, path, query = (F.col(f"{head}{k}") for k in ("host", "path", "query"))
    return F.when(host != "", F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), query))


def _value(tag: Column, pattern: str) -> Column:
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


def page_links(pages: DataFrame) -> DataFrame:
    """``from_url, to_url`` of every canonical link and refresh in the html of the pages, resolved against the page's url; null where it names no page."""
    marked = pages.select(F.col("url").cast("string"), F.col("html").cast("string")).filter(F.col("html").rlike("(?i)canonical|refresh") & F.col("url").contains("://"))
    tags = marked.select("url", F.explode(F.regexp_extract_all(F.regexp_replace("html", _NO_LINKS, " "), F.lit(_TAGS), 0)).alias("tag"))
    tag, kind = F.col("tag"), F.lower(F.substring("tag", 1, 5))
    tags = tags.withColumn("held", F.when((kind == "<link") & tag.rlike(_CANONICAL), _value(tag, _HREF)).when((kind == "<meta") & tag.rlike(_REFRESH), _value(tag, _CONTENT)))
    # stored, and filtered by the caller, so that no condition drags all these expressions into one step
    held = stored(tags.select("url", "held", (kind == "<meta").alias("meta")).filter("held <> ''"), "page-links")
    target = F.when(F.col("meta"), F.regexp_extract("held", _TARGET, 1)).otherwise(F.col("held"))
    linked = held.withColumn("to", F.trim(F.replace(target, F.lit("&amp;"), F.lit("&"))))
    to, path = F.col("to"), F.col("path")
    linked = with_parts(linked, "url").withColumn("site", F.concat("scheme", F.lit("://"), "host"))
    folder = F.regexp_replace(F.when(path == "", F.lit("/")).otherwise(path), "(?s)[^/]*$", "")
    whole = F.when(to == "", F.lit(None)).when(to.rlike("(?i)^[a-z][a-z0-9+.-]*://"), to).when(to.startswith("//"), F.concat("scheme", F.lit(":"), to))
    whole = whole.when(to.startswith("/"), F.concat("site", to)).when(to.startswith("?"), F.concat("site", path, to))
    whole = whole.when(to.startswith("#") | to.rlike("(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None)).otherwise(F.concat(F.col("site"), folder, to))
    return linked.select(F.col("url").alias("from_url"), whole.alias("to_url"))


def _ends(edges: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Edges as ``a, b``, digests of the two addresses (null without a host), and whether a rule blocks each."""
    parts = with_parts(with_parts(edges, "from_url", "a_"), "to_url", "b_")
    return parts.select(*[
        column for k in "ab"
        for column in (F.md5(address_of(f"{k}_")).alias(k), F.coalesce(rule_of(F.col(f"{k}_host"), F.col(f"{k}_path"), rules)["verdict"] == "block", F.lit(False)).alias(f"{k}_blocks"))
    ])


def blocked_addresses(edges: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``v``, digests of the addresses of all classes that hold an address blocked by a rule."""
    ends = stored(_ends(edges, rules), "address-links").filter("a <> b")
    labels = connected_components(ends)
    bad = ends.filter("a_blocks").select(F.col("a").alias("v")).union(ends.filter("b_blocks").select(F.col("b").alias("v"))).distinct()
    classes = labels.join(bad, "v", "left_semi").select("c").distinct()
    return spread_join(labels, classes, "c").select("v")


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, cause`` of every row of ``page_id, url, html``; ``redirects`` has ``from_url, to_url``.

    The cause is ``rule``, ``alias`` (blocked as another address of the page is) or ``default``.
    """
    edges = page_links(pages)
    if redirects is not None:
        edges = edges.union(redirects.select(F.col("from_url").cast("string"), F.col("to_url").cast("string")))
    blocked = blocked_addresses(edges, rules).select("v", F.lit(True).alias("bad"))
    known = with_parts(pages.select("page_id", F.col("url").cast("string").alias("url")), "url")
    known = known.withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    # pages with a rule or without an address need no class: a key of their own meets nothing and spreads them
    key = F.when(F.col("own").isNull(), F.md5(address_of()))
    met = known.withColumn("v", F.coalesce(key, F.concat(F.lit("row "), row_key().cast("string")))).join(blocked, "v", "left")
    verdict = F.coalesce("own.verdict", F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow")))
    cause = F.when(F.col("own").isNotNull(), F.lit("rule")).when(F.col("bad"), F.lit("alias")).otherwise(F.lit("default"))
    return met.select("page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"), cause.alias("cause"))


#: The query in DuckDB's SQL; the block of a class is followed link by link.
ORACLE = rf"""
WITH RECURSIVE pg AS (
  SELECT page_id, url, html, regexp_extract(url, '{_URL}', 1) AS scheme,
    translate(regexp_extract(url, '{_URL}', 2), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '{_URL}', 3) AS path, regexp_extract(url, '{_URL}', 4) AS query FROM pages),
tags AS (
  SELECT url, scheme, host, path, unnest(regexp_extract_all(regexp_replace(html, '{_NO_LINKS}', ' ', 'g'), '{_TAGS}')) AS tag
  FROM pg WHERE html IS NOT NULL AND contains(url, '://')),
named AS (
  SELECT *, replace(CASE
      WHEN lower(tag) LIKE '<link%' AND regexp_matches(tag, '{_CANONICAL.replace("'", "''")}')
        THEN concat(regexp_extract(tag, '{_HREF.replace("'", "''")}', 1), regexp_extract(tag, '{_HREF.replace("'", "''")}', 2), regexp_extract(tag, '{_HREF.replace("'", "''")}', 3))
      WHEN lower(tag) LIKE '<meta%' AND regexp_matches(tag, '{_REFRESH.replace("'", "''")}')
        THEN regexp_extract(concat(regexp_extract(tag, '{_CONTENT.replace("'", "''")}', 1), regexp_extract(tag, '{_CONTENT.replace("'", "''")}', 2), regexp_extract(tag, '{_CONTENT.replace("'", "''")}', 3)), '{_TARGET.replace("'", "''")}', 1)
    END, '&amp;', '&') AS named_url FROM tags),
links AS (
  SELECT url AS a_url, CASE
      WHEN regexp_matches(t, '(?i)^[a-z][a-z0-9+.-]*://') THEN t
      WHEN starts_with(t, '//') THEN concat(scheme, ':', t)
      WHEN starts_with(t, '/') THEN concat(scheme, '://', host, t)
      WHEN starts_with(t, '?') THEN concat(scheme, '://', host, path, t)
      WHEN starts_with(t, '#') OR regexp_matches(t, '(?i)^[a-z][a-z0-9+.-]*:') THEN NULL
      ELSE concat(scheme, '://', host, regexp_replace(CASE WHEN path = '' THEN '/' ELSE path END, '(?s)[^/]*$', ''), t) END AS b_url
  FROM (SELECT *, trim(named_url) AS t FROM named) WHERE t <> ''),
ends AS (
  SELECT u, translate(regexp_extract(u, '{_URL}', 2), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(u, '{_URL}', 3) AS path, regexp_extract(u, '{_URL}', 4) AS query
  FROM (SELECT a_url AS u FROM links UNION SELECT b_url FROM links UNION SELECT url FROM pg)),
judged AS (
  SELECT *, CASE WHEN host <> '' THEN concat(host, CASE WHEN path = '' THEN '/' ELSE path END, query) END AS address,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM ends),
pairs AS (
  SELECT x.address AS a, y.address AS b, x.rule AS a_rule, y.rule AS b_rule FROM links
  JOIN judged x ON x.u = links.a_url JOIN judged y ON y.u = links.b_url
  WHERE x.address IS NOT NULL AND y.address IS NOT NULL AND x.address <> y.address),
steps AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reached AS (
  SELECT a AS v FROM pairs WHERE a_rule IN ('net/', 'example.com/de/') UNION SELECT b FROM pairs WHERE b_rule IN ('net/', 'example.com/de/')
  UNION SELECT steps.b FROM reached JOIN steps ON steps.a = reached.v)
SELECT pg.page_id, pg.host_ AS host, pg.path_ AS path, j.rule,
  CASE WHEN j.rule IN ('net/', 'example.com/de/') THEN 'block' WHEN j.rule IS NOT NULL THEN 'allow' WHEN r.v IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN j.rule IS NOT NULL THEN 'rule' WHEN r.v IS NOT NULL THEN 'alias' ELSE 'default' END AS cause
FROM (SELECT page_id, url, coalesce(host, '') AS host_, coalesce(path, '') AS path_ FROM pg) pg
LEFT JOIN judged j ON j.u = pg.url LEFT JOIN reached r ON r.v = j.address
"""


def op12_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
