"""URL filters: host-suffix and path-prefix expressions looked up by short hash prefixes.

A rule (host, path, action) fits its host and all subdomains where the URL's path starts with the rule's
path. Every distinct (host, path) is expanded into the suffixes and prefixes of the sizes that occur among
the rules, so a URL with thousands of labels or path steps yields no more rows than the rules have shapes.
The expansion meets the rules by an equi-join on four bytes of SHA-256; the full digest confirms. Of the
rules that fit, the longest wins, at equal length the longer host, then block. Without a rule: allow.

Nulls: a null URL or one without ``://`` has an empty host and path and no rule. Repeated URLs and a common
host are decided once. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.tables import BROADCAST_ROWS

DEFAULT = "allow"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Hexadecimal digits of the short hash.
SHORT = 8


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, LETTERS, LETTERS.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def _rule_table(rules: DataFrame) -> DataFrame:
    expression = F.concat("host", "path")
    ranked = rules.groupBy("host", "path").agg(F.min_by("action", F.when(F.col("action") == "block", 0).otherwise(1)).alias("action"))
    return ranked.select(
        F.substring(_digest(expression), 1, SHORT).alias("short"),
        _digest(expression).alias("digest"),
        F.struct(
            F.char_length(expression).alias("length"),
            F.char_length("host").alias("host_length"),
            expression.alias("rule"),
            F.col("action").alias("verdict"),
        ).alias("hit"),
    )


def decisions(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule, verdict for each distinct (host, path) that some rule fits."""
    labels = F.size(F.split("host", r"\.")).alias("labels")
    shapes = rules.select(labels, F.char_length("path").alias("steps")).distinct().collect()
    suffixes = {s.labels: F.substring_index("host", ".", -s.labels) for s in shapes}
    whole = F.size(F.split("host", r"\."))
    expressions = [
        F.when(
            (whole >= s.labels) & (F.char_length("path") >= s.steps),
            F.concat(suffixes[s.labels], F.substring("path", 1, s.steps)),
        )
        for s in shapes
    ]
    wanted = F.filter(F.array(*expressions), lambda e: e.isNotNull()) if expressions else F.expr("array_remove(array(''), '')")
    places = urls.select("host", "path").distinct().withColumn("expression", F.explode(wanted))
    places = places.withColumn("digest", _digest(F.col("expression"))).withColumn("short", F.substring("digest", 1, SHORT))
    known = _rule_table(rules)
    if rules.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    confirmed = (places["short"] == known["short"]) & (places["digest"] == known["digest"])
    return places.join(known, confirmed).groupBy("host", "path").agg(F.max("hit").alias("hit")).select("host", "path", "hit.rule", "hit.verdict")


def judged(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict: one row per row of ``pages`` (page_id, url)."""
    placed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    found = decisions(placed, rules)
    return placed.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict")
    )
