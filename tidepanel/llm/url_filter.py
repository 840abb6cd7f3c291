"""URL verdicts from lists of host and path rules.

A rule names a host and the beginning of a path. It fits the host itself and all its
subdomains, for every path that starts with the rule's. Each URL is expanded into the
expressions that a rule could have (host suffixes x path prefixes), these meet the rules in
an equi-join on a short hash prefix, the full digests confirm the hit, and the most specific
rule gives the verdict.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: hexadecimal digits of a digest that are joined on
PREFIX_DIGITS = 8

#: up to so many (labels, path length) shapes of rules a URL gets one expression for each; beyond that, hosts are looked up first
MAX_SHAPES = 4096


def host_of(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From after the host to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules ``(verdict, host, path)`` with their digests. Hosts are lower-cased."""
    df = spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")
    rule = F.concat(F.translate("host", UPPER, LOWER), "path")
    return df.select("verdict", F.translate("host", UPPER, LOWER).alias("host"), "path", rule.alias("rule")).withColumns(
        {"digest": _digest(F.col("rule")), "prefix": F.substring(_digest(F.col("rule")), 1, PREFIX_DIGITS)}
    )


def _by_shapes(urls: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """``host, path, full``: one digest for each shape that fits the URL."""
    labels = F.size(F.split("host", r"\."))
    expressions = F.array(
        *[
            F.when(
                (labels >= n) & (F.length("path") >= chars),
                F.concat(F.substring_index("host", ".", -n), F.substring(F.col("path"), 1, chars)),
            )
            for n, chars in shapes
        ]
    )
    return urls.select("host", "path", F.explode(F.array_compact(expressions)).alias("expression")).select(
        "host", "path", _digest(F.col("expression")).alias("full")
    )


def _by_hosts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, full`` for the host suffixes that have a rule, each with the path lengths of its own rules.

    A suffix meets the rule hosts by a short hash prefix, and the host confirms the hit. A URL gets at most one
    expression for each of its labels and path lengths, however many rules there are.
    """
    labels = F.size(F.split("host", r"\."))
    suffixes = urls.select("host", "path", F.explode(F.sequence(F.lit(1), labels)).alias("n")).select(
        "host", "path", F.expr("substring_index(host, '.', -n)").alias("suffix")
    )
    known = rules.groupBy(F.col("host").alias("listed")).agg(F.collect_set(F.length("path")).alias("lengths"))
    prefix = lambda c: F.substring(_digest(F.col(c)), 1, PREFIX_DIGITS)
    hit = suffixes.withColumn("at", prefix("suffix")).join(known.withColumn("at", prefix("listed")), "at").where("suffix = listed")
    each = hit.select("host", "path", "suffix", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("chars"))
    return each.select("host", "path", _digest(F.expr("concat(suffix, substring(path, 1, chars))")).alias("full"))


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", max_shapes: int = MAX_SHAPES) -> DataFrame:
    """All rows of ``df`` with ``host``, ``path``, ``rule`` and ``verdict``.

    The longest fitting rule wins; of equally long ones the longer host, then ``block``. Without
    a rule the verdict is ``default`` and ``rule`` is NULL. A NULL URL, or one without ``://``,
    has an empty host and path and so fits no rule. Rows may repeat; each is judged. Columns of
    ``df`` with those four names are replaced. Empty tables give empty results; without rules
    every row gets the default.

    The distinct ``(host, path)`` are expanded, so a page that repeats a million times costs one
    lookup. The rule list is broadcast only while Spark's own size check allows it. Rules of more than
    ``max_shapes`` different numbers of labels and path lengths are found by their hosts first, with the same result.
    """
    shapes = [
        (r.labels, r.chars)
        for r in rules.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars"))
        .distinct()
        .orderBy("labels", "chars")
        .limit(max_shapes + 1)
        .collect()
    ]
    own = [c for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    pages = df.select(*[F.col(f"`{c}`") for c in own], host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    if not shapes:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})

    urls = pages.select("host", "path").distinct()
    asked = _by_shapes(urls, shapes) if len(shapes) <= max_shapes else _by_hosts(urls, rules)
    asked = asked.withColumn("prefix", F.substring("full", 1, PREFIX_DIGITS))
    listed = rules.select("prefix", "digest", "rule", F.col("verdict").alias("said"), F.length("host").alias("host_chars"))
    best = (
        asked.join(listed, "prefix")
        .where(F.col("full") == F.col("digest"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("chars"), "host_chars", F.expr("said = 'block'").alias("blocks"), "rule", "said")).alias("best"))
    )
    return pages.join(best, ["host", "path"], "left").select(
        *[F.col(f"`{c}`") for c in own],
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.said", F.lit(default)).alias("verdict"),
    )
