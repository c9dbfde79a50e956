"""Allow and block rules over URLs, found by an equi-join on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import split_join

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes of the digest that the join compares; the whole digest is compared after it.
SHORT_BYTES = 4


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def _suffixes(host: Column, most: Column | int) -> Column:
    """The host's last 1, 2, ... labels, `most` at the most."""
    labels = F.split(host, r"\.")
    n = F.least(F.size(labels), F.lit(most))
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, -i, i), "."))


def _folders(path: Column, most: Column | int) -> Column:
    """The empty path and every prefix that ends with one of the first `most` slashes."""
    parts = F.split(path, "/")
    n = F.least(F.size(parts) - 1, F.lit(most))
    return F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))),
    )


def _digest(host: Column, folder: Column) -> Column:
    # The host's length keeps its border to the path apart.
    return F.unhex(F.sha2(F.concat(F.length(host).cast("string"), F.lit(":"), host, folder), 256))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with their join keys.

    A rule is filed under its host and the part of its path up to the last slash; the
    rest of the path is compared after the join, so that it may end inside a name.
    Of equal rules the blocking one counts. Rules without host, path or verdict count as none.
    """
    host = F.translate("host", _UPPER, _LOWER)
    named = rules.select(host.alias("host"), "path", "verdict").dropna().filter("host <> ''")
    folder = F.regexp_extract("path", "(?s)^(.*/)?", 0)
    whole = named.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block comes after allow
    return whole.withColumn("folder", folder).withColumn("digest", _digest(F.col("host"), F.col("folder")))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Every distinct url with (host, path, rule, verdict); null is one of the urls.

    A rule fits its host and all subdomains if the url's path starts with the rule's.
    The longest rule (host and path together) wins, of equally long ones that with the
    longer host, then block. A url that no rule fits gets the `default` verdict and a
    null rule.

    Each distinct url is expanded into its host suffixes and path prefixes, no deeper
    than the deepest rule, and joined by the first bytes of each expression's digest.
    A suffix shared by much of the table is a hot key of a join that Spark can split.
    """
    filed = prepare_rules(rules)
    # Two numbers about the rules, which bound what a url is expanded into without losing a rule.
    deepest = filed.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"),
        F.max(F.size(F.split("folder", "/")) - 1).alias("folders"),
    ).first()
    urls = pages.select(F.col(url_col).alias("url")).distinct()
    parts = urls.select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    if deepest["labels"] is None:
        return parts.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    expanded = (
        parts.filter("host <> ''")
        .select("url", "path", F.explode(_suffixes(F.col("host"), deepest["labels"])).alias("suffix"))
        .select("url", "path", "suffix", F.explode(_folders(F.col("path"), deepest["folders"])).alias("folder"))
        .select("url", "path", _digest(F.col("suffix"), F.col("folder")).alias("full"))
    )
    short = lambda col: F.substring(col, 1, SHORT_BYTES)
    hits = split_join(
        expanded.withColumn("short", short("full")),
        filed.select(
            short("digest").alias("short"), "digest", F.col("host").alias("on"), F.col("path").alias("under"), "verdict"
        ),
        "short",
    ).filter((F.col("full") == F.col("digest")) & F.startswith("path", F.col("under")))
    order = F.struct(
        (F.length("on") + F.length("under")).alias("length"),
        F.length("on").alias("host_length"),
        F.concat("on", "under").alias("rule"),
        "verdict",
    )
    best = hits.groupBy("url").agg(F.max(order).alias("best"))
    judged = split_join(parts, best, "url", "left")
    return judged.select(
        "url",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def filter_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per page: (id, host, path, rule, verdict).

    A null url, or one without `://`, has an empty host and path and gets the default
    verdict. Repeated rows and ids stay; other columns of the pages play no part. An
    empty table gives no rows.
    """
    judged = judge_urls(pages, rules, url_col, default)
    # A null url can't be joined; a text that no url has can stand for it.
    named = lambda col: F.when(F.col(col).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(col)))
    rows = pages.select(F.col(id_col), named(url_col).alias("_url"))
    marked = judged.withColumn("_url", named("url")).drop("url")
    return split_join(rows, marked, "_url").select(id_col, "host", "path", "rule", "verdict")
