"""Allow and block rules for URLs by a sort-merge range join.

A rule (host, path, verdict) fits its host and all subdomains where the URL's path
starts with the rule's path. A canonical key is the host with its labels reversed,
a separator that no host holds, and the path; as a prefix of keys, a rule is an interval of
the sorted keys, and such intervals are nested or apart. A URL has one key per
domain above it that is no longer than the longest host of a rule, so a rule for a parent domain is found at the
parent's key. A key that many URLs share, such as that of a top domain's home pages, is swept once.

Rules and keys are dealt into ranges at bounds taken from a bounded sample of the
keys, each rule into every range that its interval meets, and each range is swept in
order with a stack of the active rules: rules that are no prefix of the
next key are popped, a rule is pushed, and the top of the stack is the longest rule
that fits a key at its domain. Among the domains of a URL the longest rule wins.
A task holds the stack only. URLs are judged once per different (host, path).

Defined results: a null URL, or one without `://`, has an empty host and path and gets
the default verdict, as does any URL that no rule fits; of rules with equal host and
path `block` wins; among equally long rules the longer host wins; rules without a host fit
nothing, a null path is empty; repeated rows are judged alike; other
columns are ignored.
"""

from __future__ import annotations

import bisect

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.common import cut_lineage, map_rows
from feedlake.session import BROADCAST_BYTES, measure

DEFAULT = "allow"
# Ranges are about this many keys; so many keys a range are sampled for the bounds.
RANGE_KEYS = 200_000
SAMPLED_PER_RANGE = 20
MAX_RANGES = 4096
_SEPARATOR = "\x01"
_TOP = 4 * "\U0010ffff"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path), empty where there is none."""
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, r"(?s)^.*?://", ""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    return F.translate(host, _UPPER, _LOWER), path


def _domain_keys(urls: DataFrame, most_labels: int) -> DataFrame:
    """(key, host, path): one key for the host and for each domain above it, up to a number of labels."""
    labels = F.reverse(F.split("host", r"\.", -1))
    above = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most_labels))), lambda n: F.array_join(F.slice(labels, 1, n), ".")
    )
    named = urls.filter("host != ''").select("host", "path", F.explode(above).alias("domain"))
    return named.select(F.concat("domain", F.lit(_SEPARATOR), "path").alias("key"), "host", "path")


def _rule_keys(rules: DataFrame) -> DataFrame:
    host = F.translate("host", _UPPER, _LOWER)
    reverse = F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")
    path = F.coalesce("path", F.lit(""))
    rows = rules.filter("host IS NOT NULL AND host != '' AND verdict IS NOT NULL")
    rows = rows.select(F.concat(reverse, F.lit(_SEPARATOR), path).alias("key"), host.alias("host"), path.alias("path"), "verdict")
    # 'block' comes after 'allow'.
    return rows.groupBy("key", "host", "path").agg(F.max("verdict").alias("verdict"))


def range_bounds(keys: DataFrame) -> list[str]:
    """Sorted bounds that deal the keys evenly, from a sample of bounded size."""
    total = keys.count()
    ranges = min(MAX_RANGES, -(-total // RANGE_KEYS))
    slots = keys.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranges = max(ranges, min(int(slots), total // 1000))
    if ranges < 2:
        return []
    wanted = ranges * SAMPLED_PER_RANGE
    sample = keys.select("key").sample(fraction=min(1.0, 1.2 * wanted / total), seed=7).limit(2 * wanted).collect()
    ordered = sorted(row["key"] for row in sample)
    return sorted({ordered[len(ordered) * k // ranges] for k in range(1, ranges)}) if ordered else []


def _dealt(rules: DataFrame, keys: DataFrame, bounds: list[str]) -> DataFrame:
    """All rules and (different) keys as (part, key, kind, host, path, verdict)."""
    shared = keys.sparkSession.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def part_of(values: pd.Series) -> pd.Series:
        return values.map(lambda key: bisect.bisect_right(shared.value, key)).astype("int32")

    spans = rules.withColumns({"_from": part_of("key"), "_to": part_of(F.concat("key", F.lit(_TOP)))})
    spans = spans.withColumn("part", F.explode(F.sequence("_from", "_to")))
    columns = ["part", "key", "kind", "host", "path", "verdict"]
    return spans.withColumn("kind", F.lit(0)).select(*columns).unionByName(
        keys.withColumns(
            {"part": part_of("key"), "kind": F.lit(1)} | {name: F.lit(None).cast("string") for name in ("host", "path", "verdict")}
        ).select(*columns)
    )


def _sweep(dealt: DataFrame) -> DataFrame:
    """(key, rule_host, rule_path, verdict): the top of the stack at each key with one."""
    names = ["key", "rule_host", "rule_path", "verdict"]

    def task():
        stack: list[tuple[str, str, str, str]] = []
        part = None

        def each(rows):
            nonlocal part
            out = {name: [] for name in names}
            for at, key, kind, host, path, verdict in zip(*rows.values(), strict=True):
                if at != part:
                    part = at
                    stack.clear()
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((key, host, path, verdict))
                elif stack:
                    for name, value in zip(names, (key, *stack[-1][1:]), strict=True):
                        out[name].append(value)
            return out

        return each

    arrow = pa.schema([(name, pa.string()) for name in names])
    return map_rows(dealt, task, ", ".join(f"{name} string" for name in names), arrow)


def _sized(lookup: DataFrame) -> DataFrame:
    """A lookup table for a join: broadcast while its measured size allows, else shuffled, whatever its files' size."""
    return F.broadcast(lookup) if measure(lookup)[1] <= BROADCAST_BYTES else lookup.hint("merge")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the different (host, path) that a rule fits."""
    rules = cut_lineage(_rule_keys(rules), "urls-rules")
    labels = rules.agg(F.max(F.size(F.split("host", r"\.", -1)))).first()[0]
    keys = cut_lineage(_domain_keys(urls, labels or 0).filter(F.lit(bool(labels))), "urls-keys")
    different = cut_lineage(keys.select("key").distinct(), "urls-different-keys")
    bounds = range_bounds(different)
    dealt = _dealt(rules, different, bounds)
    ordered = dealt.repartition(len(bounds) + 1, "part").sortWithinPartitions("part", "key", "kind")
    size = F.length("rule_host") + F.length("rule_path")
    rule = F.struct(size.alias("size"), F.length("rule_host").alias("host_size"), F.concat("rule_host", "rule_path").alias("rule"), "verdict")
    found = cut_lineage(_sweep(ordered), "urls-swept")
    best = keys.join(_sized(found), "key").groupBy("host", "path").agg(F.max(rule).alias("best"))
    return best.select("host", "path", "best.rule", "best.verdict")


def judged(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per page row."""
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    split = cut_lineage(split, "urls-split")
    verdicts = cut_lineage(matched(split.select("host", "path").distinct(), rules), "urls-verdicts")
    found = split.join(_sized(verdicts), ["host", "path"], "left")
    return found.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")
