"""URL filters: host-suffix and path-prefix expressions matched by hash prefix.

Each URL is expanded into all pairs of a host suffix and a path prefix that a rule could be made
of. Expressions meet rules by equi-join on a short prefix of their hash; the full digests then
confirm the match, and of the confirmed rules the longest decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions import own_shuffle
from cohortry.llm.common import fresh

#: Hexadecimal digits of a digest that rules and expressions are joined on, as a number.
PREFIX_DIGITS = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path starts as given."""

    verdict: str
    host: str
    path: str


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """``(host, path, verdict)``, the form in which ``judge`` takes rules."""
    rows = [(r.host, r.path, r.verdict) for r in rules]
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with its ``url_host``, ``url_path``, ``url_rule`` and ``url_verdict``.

    ``rules`` has host, path and verdict; rules without host, path or verdict fit nothing. The
    longest rule (host and path together) wins, then the one with the longer host, then, for rules
    given twice with both verdicts, "block". Where no rule fits, the verdict is ``default`` and the
    rule null. A null URL, or one without ``://``, has an empty host and path, which no rule fits.
    Rows come out as they come in, also repeated ones; columns of ``urls`` of those four names are
    replaced. Of a URL as many expressions are made as there are pairs of a number of labels and a path
    length among the rules, as far as the URL has them.
    """
    known = rules.where("host <> '' and path is not null and verdict is not null").select(
        "host",
        "path",
        "verdict",
        F.sha2(_expression(F.col("host"), F.col("path")), 256).alias("digest"),
    )
    # Shapes of the rules, not the rules: how many labels and characters an expression can have.
    labels = [r[0] for r in known.select(F.size(F.split("host", "[.]"))).distinct().collect()]
    lengths = [r[0] for r in known.select(F.length("path")).distinct().collect()]
    parsed = urls.withColumns({"url_host": host_of(F.col(url)), "url_path": path_of(F.col(url))})
    parsed = parsed.drop("url_rule", "url_verdict")
    # An empty host fits no rule, and all such rows would meet in one place.
    without = parsed.where("url_host = ''").withColumns(
        {"url_rule": F.lit(None).cast("string"), "url_verdict": F.lit(default)}
    )
    parsed = parsed.where("url_host <> ''")
    # The verdict depends on host and path alone, so repeated ones are judged once.
    places = parsed.select(F.col("url_host").alias("h"), F.col("url_path").alias("p")).distinct()
    found = _expressions(places, labels, lengths)
    hits = found.join(known.select("host", "path", "verdict", F.col("digest").alias("of"), _prefix("digest")), "prefix")
    # Confirmed after the join: an equality would become one more key of it. Digests are of one length.
    hits = hits.where(F.startswith("digest", "of"))
    strength = F.struct(
        (F.length("host") + F.length("path")).alias("length"),
        F.length("host").alias("of_host"),
        F.col("verdict"),
        F.concat("host", "path").alias("rule"),
    )
    best = hits.groupBy("h", "p").agg(F.max(strength).alias("best"))
    h, p, place, rule, verdict = (fresh(n) for n in ("h", "p", "place", "rule", "verdict"))
    best = best.select(
        F.col("h").alias(h),
        F.col("p").alias(p),
        F.xxhash64("h", "p").alias(place),
        F.col("best.rule").alias(rule),
        F.col("best.verdict").alias(verdict),
    )
    # Joined on the places' hashes, in a shuffle of their own, so that a frequent URL's rows can be split.
    same = F.xxhash64("url_host", "url_path") == F.col(place)
    same &= (F.col("url_host") == F.col(h)) & (F.col("url_path") == F.col(p))
    judged = parsed.join(own_shuffle(best, place), same, "left")
    judged = judged.withColumns(
        {"url_rule": F.col(rule), "url_verdict": F.coalesce(F.col(verdict), F.lit(default))}
    )
    return judged.drop(h, p, place, rule, verdict).unionByName(without)


def _expressions(places: DataFrame, labels: Sequence[int], lengths: Sequence[int]) -> DataFrame:
    """Every host suffix with every path prefix, with digest and digest prefix.

    Only suffixes of as many labels and prefixes of as many characters as some rule has.
    """
    parts = F.size(F.split("h", "[.]"))
    rows = places.where("h <> ''").withColumn("parts", parts)
    rows = rows.withColumn("labels", F.explode(_literals(labels))).where("labels <= parts")
    rows = rows.withColumn("length", F.explode(_literals(lengths))).where("length <= length(p)")
    suffix = F.expr("substring_index(h, '.', -labels)")
    prefix = F.expr("substring(p, 1, length)")
    rows = rows.withColumn("digest", F.sha2(_expression(suffix, prefix), 256))
    return rows.select("h", "p", "digest", _prefix("digest"))


def _expression(host: Column, path: Column) -> Column:
    # The separator keeps a host's end and a path's beginning apart.
    return F.concat_ws(" ", host, path).cast("binary")


def _prefix(digest: str) -> Column:
    return F.conv(F.substring(digest, 1, PREFIX_DIGITS), 16, 10).cast("long").alias("prefix")


def _literals(numbers: Sequence[int]) -> Column:
    return F.array(*(F.lit(n) for n in sorted(numbers))).cast("array<int>")
