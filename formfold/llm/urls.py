"""URL filters by host suffix and path prefix.

A URL's host is what stands after the first `://` up to `/`, `?`, `#` or the end, A-Z in
lower case; its path goes on up to `?`, `#` or the end.  Null URLs and such without `://`
have an empty host and path.  A rule (host, path) fits its host and all subdomains where
the path starts with the rule's; rule paths start and end with `/`.

Each distinct (host, path) is expanded into host suffixes times path prefixes, no deeper
than the deepest rule, so that long URLs stay small and nothing that could match is left
out.  Expressions meet rules in an equi-join on the first four bytes of their digests; full
digests confirm.  Of the rules that fit the one with the longest text wins, of equals the
longer host, then the smaller text, and block before allow.  Verdicts go back to the pages
by (host, path), where adaptive execution splits hot values.  All steps are SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every page; rules(host, path, verdict).

    otherwise is the verdict where no rule fits.  Repeated pages keep a row each; empty
    rule tables leave every page with `otherwise`; other columns are ignored.
    """
    rules = rules.select(
        F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
    rules = rules.select(
        "r_host", F.when(F.col("r_path").rlike(r"^/(?s:.*/)?$"), F.col("r_path")).otherwise(
            F.raise_error(F.lit("a rule's path starts and ends with /"))).alias("r_path"), "r_verdict").distinct()
    depth = rules.agg(
        F.max(F.size(F.split("r_host", r"\."))).alias("labels"),
        F.max(F.size(F.split("r_path", "/")) - 1).alias("steps")).first()
    host, path = host_and_path(F.col("url"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path"))
    labels, steps = F.split("host", r"\."), F.split("path", "/")
    hosts = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth.labels or 1))),
                        lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    # "/a/b" has the prefixes "/" and "/a/"; a path of another start has none that a rule could equal
    paths = F.when(F.size(steps) > 1, F.transform(
        F.sequence(F.lit(1), F.least(F.size(steps) - 1, F.lit(depth.steps or 1))),
        lambda n: F.concat(F.array_join(F.slice(steps, F.lit(1), n), "/"), F.lit("/"))))
    expanded = (seen.select("host", "path").distinct()
                .select("host", "path", F.explode(hosts).alias("e_host"), paths.alias("paths"))
                .select("host", "path", "e_host", F.explode("paths").alias("e_path")))
    digest = lambda h, p: F.sha2(F.concat(F.col(h), F.lit("\n"), F.col(p)), 256)
    short = lambda c: F.substring(c, 1, 8)
    asked = expanded.select("host", "path", digest("e_host", "e_path").alias("digest"))
    known = rules.select("*", digest("r_host", "r_path").alias("r_digest"))
    found = (asked.withColumn("short", short("digest"))
             .join(known.withColumn("short", short("r_digest")), "short")
             .where("digest = r_digest"))
    order = F.struct(
        F.length(F.concat("r_host", "r_path")).alias("n"), F.length("r_host").alias("h"),
        F.concat("r_host", "r_path").alias("rule"), (F.col("r_verdict") == "block").alias("b"), F.col("r_verdict").alias("verdict"))
    best = found.groupBy("host", "path").agg(F.max(order).alias("best"))
    return (seen.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict")))
