"""URL filter: host and path rules, carried over redirect and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.components import connected_components
from shopmarts.llm.storage import written

MAX_RULES = 1000
#: The rules of the registered query, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty without ``://`` or for null."""
    rest = _after_scheme(url)
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, else null.

    A rule fits its host and all subdomains when ``path`` starts with the
    rule's.  Of equally long ones an allow wins, then the first in text order.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules fit one expression")
    found = []
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0], r[1] + r[2]))
    for verdict, h, p in ranked:
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        found.append(F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


def node_of(url: Column) -> Column:
    """The resource a url names: without scheme and fragment, host lower-cased,
    an empty path as ``/``.  A url without ``://`` names itself (after ``=``); null
    names nothing."""
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)?", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(
        F.lit("//"), host_of(url), F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url)),
        query)).otherwise(F.concat(F.lit("="), url))


def linked_urls(url: Column, html: Column) -> Column:
    """Absolute targets of the page's canonical links and meta refreshes."""
    tag = r"(?i)<(?:link|meta)\b[^>]*>"
    real = F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>", "")
    quoted = r"""(?is)\b{0}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""

    def attribute(t: Column, name: str) -> Column:
        rx = quoted.replace("{0}", name)
        return F.trim(F.concat(*(F.regexp_extract(t, rx, k) for k in (1, 2, 3))))

    def target(t: Column) -> Column:
        canonical = t.rlike(r"(?i)^<link\b") & F.lower(attribute(t, "rel")).rlike(r"(^|\s)canonical(\s|$)")
        refresh = t.rlike(r"(?i)^<meta\b") & (F.lower(attribute(t, "http-equiv")) == "refresh")
        to = F.regexp_extract(attribute(t, "content"), r"""(?i)^\s*[\d.]*\s*[;,]\s*url\s*=\s*['"]?([^'"]*)""", 1)
        ref = F.when(canonical, attribute(t, "href")).when(refresh, F.trim(to)).otherwise(F.lit(""))
        return _absolute(url, F.replace(ref, F.lit("&amp;"), F.lit("&")))

    worth = html.rlike(r"(?i)canonical|http-equiv")       # most pages have neither
    tags = F.when(worth, F.regexp_extract_all(real, F.lit(tag), F.lit(0))).otherwise(
        F.array().cast("array<string>"))
    return F.filter(F.transform(F.coalesce(tags, F.array().cast("array<string>")), target),
                    lambda u: u.isNotNull())


def _absolute(base: Column, ref: Column) -> Column:
    site = F.regexp_extract(base, r"^([^/?#]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([^/?#]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (F.when((ref == "") | ref.startswith("#"), F.lit(None).cast("string"))
            .when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), ref)
            .when(ref.startswith("//"), F.concat(F.lit("http:"), ref))
            .when(site == "", F.lit(None).cast("string"))
            .when(ref.startswith("/"), F.concat(site, ref))
            .when(folder.endswith("/"), F.concat(folder, ref))
            .otherwise(F.concat(folder, F.lit("/"), ref)))


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``id_col, host, path, rule, verdict, alias_block``.

    A page with a fitting rule has that rule's verdict.  Other pages are blocked
    when an alias is: urls joined by redirects (``redirects`` with columns
    ``source, target``, and the pages' meta refreshes) or canonical links, in
    either direction and over any number of steps, whether the alias was
    crawled or only linked to.  An explicit allow rule has precedence: its page
    stays allowed whatever its aliases are.  All else is allowed.  Urls that
    differ in scheme, fragment or an empty path's slash only are one.  Null urls and pages have empty
    host and path, no alias and are allowed; repeated rows come back as often;
    other columns are not read.
    """
    html = F.col(html_col).cast("string") if html_col in pages.columns else F.lit(None).cast("string")
    url = F.col(url_col).cast("string")
    rows = written(pages.select(
        F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
        node_of(url).alias("node"), F.transform(linked_urls(url, html), node_of).alias("to")), "pages")
    edges = rows.filter(F.col("node").isNotNull()).select("node", F.explode("to").alias("to"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(
            node_of(F.col("source").cast("string")).alias("node"),
            node_of(F.col("target").cast("string")).alias("to")))
    aliases = connected_components(edges)
    address = F.concat(F.lit("any:"), F.col("node"))
    verdict = matched_rule(host_of(address), path_of(address), rules)["verdict"]
    aliases = written(aliases.withColumn("bad", F.coalesce(verdict == "block", F.lit(False))), "aliases")
    bad = aliases.filter("bad").select("component").distinct()
    blocked = written(aliases.join(bad, "component", "left_semi")
                      .select(F.col("node").alias("blocked")), "blocked_aliases")
    out = rows.join(blocked, F.col("node") == F.col("blocked"), "left")
    own = matched_rule(F.col("host"), F.col("path"), rules)
    by_alias = F.col("blocked").isNotNull()
    return out.select(F.col("id").alias(id_col), "host", "path", own["rule"].alias("rule"), F.coalesce(
        own["verdict"], F.when(by_alias, "block").otherwise("allow")).alias("verdict"),
        (own.isNull() & by_alias).alias("alias_block"))
