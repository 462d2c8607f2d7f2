"""URL rules by a sort-merge range join.

A host's key is its labels in reverse, each followed by a dot: ``www.example.com`` becomes ``com.example.www.``.
A rule for a host and its subdomains is then the interval of all keys that begin with the host's key. Urls and
rules are sorted together; a sweep keeps the stack of rule hosts whose interval is open, and a url meets just
the rules on the stack. The line of keys is cut into ranges that are swept side by side: the cuts come from a
sample of the urls, equal hosts are spread by a hash of the url, so that one host with a third of all urls is
cut as well, and a rule is handed to every range that its interval touches. That are few copies: only the rules
of the hosts above a cut cross it.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

SAMPLE_PER_RANGE = 24      # urls, chosen by their hash, from which the cuts between ranges are taken

_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path as they stand in the url; both empty for null or without ``://``."""
    has = F.coalesce(F.instr(url, "://"), F.lit(0)) > 0
    tail = F.when(has, url.substr(F.instr(url, "://") + F.lit(3), F.length(url))).otherwise(F.lit(""))
    pattern = "^([^/?#]*)([^?#]*)"
    return (F.translate(F.regexp_extract(tail, pattern, 1), _AZ, _AZ.lower()), F.regexp_extract(tail, pattern, 2))


def host_key(host: Column) -> Column:
    """Labels in reverse, each with a dot; empty for an empty host."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _sweep(default: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []             # (host key, {path: (rule, verdict)}, path lengths, longest first)
        for batch in batches:
            ids, out = [], []
            columns = [batch.column(c).to_pylist() for c in range(1, 8)]
            for k, (range_, key, kind, host, path, rule, verdict) in enumerate(zip(*columns)):
                if range_ != part:
                    part, stack = range_, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}, []))
                    _, paths, lengths = stack[-1]
                    if path not in paths or verdict < paths[path][1]:
                        paths[path] = (rule, verdict)
                    if len(path) not in lengths:
                        lengths.append(len(path))
                        lengths.sort(reverse=True)
                    continue
                best = None
                for level, paths, lengths in stack:
                    for n in lengths:
                        found = paths.get(path[:n]) if n <= len(path) else None
                        if found is not None:
                            if best is None or (len(found[0]), len(level)) > best[0]:
                                best = ((len(found[0]), len(level)), found)
                            break
                ids.append(k)
                out.append((host, path, *(best[1] if best else (None, default))))
            hosts, paths_, rules, verdicts = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), *(pa.array(v, pa.string()) for v in
                                                                    (hosts, paths_, rules, verdicts))], names=names)
    return run


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", page_id: str = "page_id", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) of every url.

    ``rules`` has (host, path, verdict). A rule fits its host and all subdomains, if the url's path starts with
    the rule's. The longest rule (host and path together, then host) wins; equal rules with different verdicts
    count as the alphabetically first, so ``allow`` beats ``block``. Without a rule the verdict is ``default``
    and the rule null. Null urls and those without ``://`` have an empty host, which no rule fits. Rules with a
    null or empty host, or a null verdict, are left out; a null path is empty. Repeated urls each have a row.
    """
    spark = urls.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = host_and_path(F.col(url))
    pages = urls.select(F.col(page_id).alias("id"), host.alias("host"), path.alias("path"),
                        F.hex(F.xxhash64(F.col(url), F.col(page_id))).alias("salt"))
    kind = pages.schema["id"].dataType.simpleString()
    pages = pages.withColumn("key", host_key(F.col("host")))
    place = F.concat("key", F.lit("\0"), "salt")
    sample = sorted(r[0] for r in pages.select(place.alias("place")).orderBy(F.xxhash64("place"), "place")
                    .limit(ranges * SAMPLE_PER_RANGE).collect())
    cuts = sorted({sample[k * len(sample) // ranges] for k in range(1, ranges)}) if sample else []

    @F.arrow_udf(IntegerType())
    def range_of(places: pa.Array) -> pa.Array:
        return pa.array([bisect_right(cuts, p) for p in places.to_pylist()], pa.int32())

    @F.arrow_udf(IntegerType())
    def range_before(places: pa.Array) -> pa.Array:
        return pa.array([bisect_left(cuts, p) for p in places.to_pylist()], pa.int32())

    given = rules.select(F.translate(F.col("host"), _AZ, _AZ.lower()).alias("host"),
                         F.coalesce(F.col("path"), F.lit("")).alias("path"), F.col("verdict").alias("verdict"))
    given = given.filter("host is not null and host <> '' and verdict is not null").withColumn(
        "key", host_key(F.col("host")))
    end = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))      # the next sign after the dot
    given = given.withColumn("first", range_of(F.col("key"))).withColumn("last", range_before(end)).select(
        F.lit(None).cast(kind).alias("id"), F.explode(F.sequence("first", "last")).alias("range"), "key",
        F.lit(0).alias("kind"), "host", "path", F.concat("host", "path").alias("rule"), "verdict")
    pages = pages.select("id", range_of(place).alias("range"), "key", F.lit(1).alias("kind"), "host", "path",
                         F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    both = pages.unionByName(given).repartition("range").sortWithinPartitions("range", "key", "kind", "path", "verdict")
    names = [page_id, "host", "path", "rule", "verdict"]
    return both.mapInArrow(_sweep(default, names), f"`{page_id}` {kind}, host string, path string, rule string, verdict string")
