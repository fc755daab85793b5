"""URL filters: nested host and path rules found by a sorted sweep over reversed hosts."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import ascii_lower, plain, shuffle_partitions, text_of
from millrace.llm.ranges import cut_points, part_of

_AFTER_ALL = "\U0010ffff"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path of a URL; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(host), path


def reversed_host(host: Column) -> Column:
    """``www.example.com`` as ``com.example.www.``: a host's subdomains have the host's key as their prefix."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


class _Active:
    """The rules of one host: their paths, looked up from the longest on."""

    def __init__(self, key: str):
        self.key, self.paths, self.lengths = key, {}, []

    def add(self, path: str, rule: str, verdict: str) -> None:
        if path not in self.paths and len(path) not in self.lengths:
            bisect.insort(self.lengths, len(path))
        if path not in self.paths or verdict > self.paths[path][1]:
            self.paths[path] = (rule, verdict)

    def find(self, path: str) -> tuple[str, str] | None:
        for length in reversed(self.lengths):
            if length <= len(path) and (found := self.paths.get(path[:length])):
                return found
        return None


def judge(
    pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per row of ``pages``: (id, host, path, rule, verdict).

    ``rules`` has (host, path, verdict). A rule fits its host and all its subdomains, if the URL's path starts with the
    rule's; of the rules that fit, the one with the most characters wins, then the one with the longer host. Two verdicts
    for one host and path: the alphabetically later one (``block`` before ``allow``). Without a rule ``rule`` is NULL and
    the verdict is ``default``.

    A rule's host is an interval of reversed hosts. URLs and intervals are dealt to parts of neighbouring keys, a rule to
    each part that its interval meets (only the few rules around a cut point meet several), and sorted; one sweep keeps a
    stack of the hosts that are open. Neither side is broadcast, and a host with very many URLs is cut by path and id.

    NULL URLs have an empty host and path, and so have URLs without ``://``; rules with a NULL or empty host or a NULL
    verdict fit nothing, a NULL path is empty. Repeated rows get equal answers. Empty tables: no pages, no rows; no rules,
    the default for all.
    """
    spark = pages.sparkSession
    parts = shuffle_partitions(spark)
    host, path = host_and_path(text_of(url_column))
    rows = pages.select(plain(id_column).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", reversed_host(F.col("host")))
    spread = F.xxhash64("id")
    points = cut_points(rows.select("key", "path", spread.alias("spread")), parts)
    rows = rows.withColumn("part", part_of(points, F.col("key"), F.col("path"), spread))

    rule_rows = (
        rules.select(ascii_lower(plain("host").cast("string")).alias("host"), text_of("path").alias("path"), "verdict")
        .filter("host != '' AND verdict IS NOT NULL").distinct()
        .withColumn("key", reversed_host(F.col("host")))
    )
    before, after = F.lit(-(2**63)).cast("long"), F.lit(2**63 - 1).cast("long")
    first = part_of(points, F.col("key"), F.lit(""), before)
    last = part_of(points, F.concat("key", F.lit(_AFTER_ALL)), F.lit(""), after)
    rule_rows = rule_rows.withColumn("part", F.explode(F.sequence(first, last)))

    id_type = rows.schema["id"].dataType
    both = rows.select("part", "key", F.lit(1).alias("kind"), "path", "host", "id", F.lit(None).cast("string").alias("verdict")).unionByName(
        rule_rows.select("part", "key", F.lit(0).alias("kind"), "path", "host", F.lit(None).cast(id_type).alias("id"), "verdict")
    )
    dealt = both.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "key", "kind", "path")
    schema = T.StructType([T.StructField("id", id_type)] + [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Active] = []
        for batch in batches:
            keys, kinds, paths, hosts, verdicts = (batch.column(c).to_pylist() for c in ("key", "kind", "path", "host", "verdict"))
            pages_at, found_rules, found_verdicts = [], [], []
            for row, (key, kind, path_, host_) in enumerate(zip(keys, kinds, paths, hosts)):
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1].key != key:
                        stack.append(_Active(key))
                    stack[-1].add(path_, host_ + path_, verdicts[row])
                    continue
                best = (None, default)
                for active in stack:  # from the shortest host on: of equal lengths the longer host wins
                    if (hit := active.find(path_)) and (best[0] is None or len(hit[0]) >= len(best[0])):
                        best = hit
                pages_at.append(row)
                found_rules.append(best[0])
                found_verdicts.append(best[1])
            taken = batch.take(pa.array(pages_at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken.column("id"), taken.column("host"), taken.column("path"), pa.array(found_rules, pa.string()), pa.array(found_verdicts, pa.string())],
                ["id", "host", "path", "rule", "verdict"],
            )

    return dealt.mapInArrow(run, schema).withColumnRenamed("id", id_column)
