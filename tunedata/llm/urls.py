"""URL filters with redirect equivalence.

Every url has a canonical form: https for http (the usual upgrade redirect),
lower-case host, no fragment, no tracking parameters, no trailing slash. Urls of
one form are aliases. Further edges come from the pages: canonical links and
refresh redirects (of any host). Connected components over the forms, found
with distributed joins, give the classes of aliases; a class that holds an
allowed url is allowed, else one that holds a blocked url is blocked, and that
is the verdict of its urls that no rule fits. A url's own rule always counts
first.

Defined cases: a null url, or one without ``://``, has empty host and path, fits
no rule, has no aliases and is allowed; null html has no links; equal urls share
a verdict and every page is returned, equal rows included; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunedata.llm.components import components
from tunedata.session import materialize

URL = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Parameters that tell where a visitor comes from, not which page is meant.
TRACKING = r"(?i)^(utm_[^=]*|ref|gclid|fbclid)(=|$)"

COMMENT = r"(?s)<!--.*?(?:-->|\z)"
# Quoted values are matched as a whole, so a tag doesn't end inside of one. Possessive: never backtracks.
TAG = r"""(?is)<%s[\s/](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
ATTRIBUTE = r"""[^\s=>"'/]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+)"""
REFRESH_URL = r"""(?is)(?:^|[;,\s])url\s*=\s*["']?\s*([^"'\s]+)"""
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, URL, 2)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 3), F.lit(""))


def canonical(url: Column) -> Column:
    """Canonical form; null for what is not a url."""
    scheme = lower_ascii(F.regexp_extract(url, URL, 1))
    query = F.array_join(F.filter(F.split(F.regexp_extract(url, URL, 4), "&"),
                                  lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    return F.when(F.contains(url, F.lit("://")), F.concat(
        F.when(scheme == "http", "https").otherwise(scheme), F.lit("://"), host_of(url),
        F.regexp_replace(path_of(url), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments; nothing is above the root."""
    def step(done: Column, segment: Column) -> Column:
        return (F.when(segment == ".", done)
                .when(segment == "..", F.slice(done, 1, F.greatest(F.lit(1), F.size(done) - 1)))
                .otherwise(F.concat(done, F.array(segment))))

    parts = F.split(path, "/")
    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.lit(0), F.size(parts) - 1)), F.slice(parts, 1, 1), step)
    ends = F.when(path.rlike(r"/\.\.?$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.when(path.contains("/."), F.array_join(F.concat(kept, ends), "/")).otherwise(path)


def resolve(base: Column, link: Column) -> Column:
    """``link`` of the page at ``base`` as a full url; fragments of the same page are the page."""
    scheme, host = F.regexp_extract(base, URL, 1), F.regexp_extract(base, URL, 2)
    site = F.concat(scheme, F.lit("://"), host)
    full = (F.when(link.rlike(SCHEME), link)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(site, link))
            .when(link.startswith("#"), base)
            .when(link.startswith("?"), F.concat(site, path_of(base), link))
            .otherwise(F.concat(site, F.regexp_replace(path_of(base), "[^/]*$", ""),
                                F.when(F.contains(path_of(base), F.lit("/")), "").otherwise("/"), link)))
    before = F.regexp_extract(full, r"(?s)^.*?://[^/?#]*", 0)
    path = path_of(full)
    return F.concat(before, without_dots(path), F.substr(full, F.length(before) + F.length(path) + 1))


def attribute(tag: Column, name: str) -> Column:
    """Value of the tag's first attribute of that name, '' if there is none."""
    own = F.filter(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0)), lambda a: a.rlike(rf"(?i)^{name}\s*="))
    value = F.regexp_replace(F.coalesce(F.get(own, 0), F.lit("")), r"(?s)^[^=]*=\s*", "")
    return F.trim(F.regexp_replace(value, r"""(?s)^["']|["']$""", ""))


def page_links(html: Column) -> Column:
    """Targets of the canonical links and refresh redirects in ``html``, comments left out."""
    plain = F.regexp_replace(html, COMMENT, "")

    def targets(name: str, fits, link) -> Column:
        tags = F.filter(F.regexp_extract_all(plain, F.lit(TAG % name), F.lit(0)), fits)
        found = F.transform(tags, lambda t: F.replace(link(t), F.lit("&amp;"), F.lit("&")))
        return F.filter(found, lambda u: u != "")

    return F.concat(
        targets("link", lambda t: F.array_contains(F.split(F.lower(attribute(t, "rel")), r"\s+"), "canonical"),
                lambda t: attribute(t, "href")),
        targets("meta", lambda t: F.lower(attribute(t, "http-equiv")) == "refresh",
                lambda t: F.regexp_extract(attribute(t, "content"), REFRESH_URL, 1)))


def fitting_rules(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``url, rule, own`` for the distinct ``urls``: the longest rule that fits and its verdict.

    A rule ``host/path`` fits the host and its subdomains where the path starts
    with the rule's. Urls are joined on the suffixes of their host, so the work
    does not grow with the number of rules.
    """
    spark = urls.sparkSession
    table = spark.createDataFrame([(r[:r.index("/")], r[r.index("/"):], r, v) for r, v in rules],
                                  "suffix string, start string, rule string, own string")
    labels = F.split(host_of(F.col("url")), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    fits = (urls.select("url", F.explode(suffixes).alias("suffix")).join(table, "suffix")
            .filter(F.startswith(path_of(F.col("url")), F.col("start")))
            .groupBy("url").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "own")).alias("r")))
    return urls.join(fits, "url", "left").select("url", F.col("r.rule").alias("rule"), F.col("r.own").alias("own"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages`` (``page_id, url, html``);
    ``rules`` are pairs of rule and verdict (``allow`` or ``block``)."""
    linked = (pages.filter(F.contains("url", F.lit("://")))
              .select("url", F.explode(page_links(F.col("html"))).alias("link"))
              .select("url", resolve(F.col("url"), F.col("link")).alias("target")).distinct())
    linked = materialize(linked)  # the pages' texts are read once
    urls = (pages.select("url").filter(F.contains("url", F.lit("://")))
            .union(linked.select("target")).distinct())
    ruled = materialize(fitting_rules(urls, rules).withColumn("form", canonical(F.col("url"))))
    aliases = components(linked.select(canonical(F.col("url")).alias("u"), canonical(F.col("target")).alias("v")))
    forms = ruled.groupBy("form").agg(F.max(F.col("own") == "allow").alias("allowed"),
                                      F.max(F.col("own") == "block").alias("blocked"))
    rooted = (forms.join(aliases, forms["form"] == aliases["node"], "left")
              .withColumn("root", F.coalesce("component", "form")))
    classes = rooted.groupBy("root").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked"))
    method = (rooted.select("form", "root").join(classes, "root")
              .select("form", F.when(F.col("blocked") & ~F.coalesce("allowed", F.lit(False)), "block")
                      .otherwise("allow").alias("method")))
    verdicts = ruled.join(method, "form").select("url", "rule", F.coalesce("own", "method").alias("verdict"))
    return (pages.select("page_id", "url").join(verdicts, "url", "left")
            .select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
                    F.coalesce("verdict", F.lit("allow")).alias("verdict")))
