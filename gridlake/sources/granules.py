"""Satellite granule listings: names, dates, what is expected, found and pending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def list_granules(paths: DataFrame, path: str = "path", suffix: str = ".hdf") -> DataFrame:
    """Keep the paths with the suffix and add the base ``name``."""
    return paths.filter(F.col(path).endswith(suffix)).withColumn(
        "name", F.element_at(F.split(F.col(path), "/"), -1)
    )


def date_token(name: Column) -> Column:
    """The first dot-separated part that starts with ``A`` and has at least 8 characters."""
    tokens = F.filter(F.split(name, r"\."), lambda p: p.startswith("A") & (F.length(p) >= 8))
    return F.try_element_at(tokens, F.lit(1))


def time_from_filename(df: DataFrame, name: str = "name", strict: bool = True) -> DataFrame:
    """Add ``time`` from the ``AYYYYDDD`` part of a file name.

    A name without such a part is an error; with ``strict=False`` its time is NULL.
    """
    token = date_token(F.col(name))
    first = F.make_date(F.substring(token, 2, 4).cast("int"), F.lit(1), F.lit(1))
    day = F.date_add(first, F.substring(token, 6, 3).cast("int") - 1).cast("timestamp_ntz")
    if strict:
        day = F.when(token.isNotNull(), day).otherwise(
            F.raise_error(F.concat(F.lit("no AYYYYDDD part in file name: "), F.col(name)))
            .cast("timestamp_ntz")
        )
    return df.withColumn("time", day)


def granules_in_range(granules: DataFrame, spine: DataFrame, time: str = "time") -> DataFrame:
    """Keep granules whose time is one of the target times."""
    return granules.join(spine.select(time), time, "left_semi")


def pending_granules(expected: DataFrame, done: DataFrame, key) -> DataFrame:
    """Expected items that are not on disk yet."""
    return expected.join(done, key, "left_anti")


def missing_dates(expected: DataFrame, found: DataFrame, time: str = "time") -> DataFrame:
    """Expected days without a file."""
    return expected.select(time).join(found.select(time), time, "left_anti")


def completeness(expected: DataFrame, found: DataFrame, time: str = "time") -> DataFrame:
    """One row: files found, days expected, expected minus found, and days without any file.

    Several files for one day do not hide another day's gap: ``n_missing_days`` counts days.
    """
    days = expected.select(time).withColumn("_e", F.lit(1))
    files = found.groupBy(time).agg(F.count(F.lit(1)).alias("_n"))
    both = days.join(files, time, "full_outer")
    return both.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_found"),
        F.coalesce(F.sum("_e"), F.lit(0)).alias("n_expected"),
        F.count_if(F.col("_e").isNotNull() & F.col("_n").isNull()).alias("n_missing_days"),
    ).select(
        "n_found", "n_expected",
        (F.col("n_expected") - F.col("n_found")).alias("n_difference"),
        "n_missing_days",
    )


def chunk_accounting(granules: DataFrame, chunks: DataFrame, time: str = "time") -> DataFrame:
    """Granules per day chunk; chunks without any are listed with 0.

    ``chunks`` comes from ``day_chunks`` and carries the first day and length of the whole range,
    so that a granule finds its chunk by arithmetic and the join is on equality.
    """
    day = F.to_date(time)
    per_day = granules.groupBy(day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    days = chunks.select(
        "chunk", F.explode(F.sequence("chunk_start", "chunk_end")).alias("_day")
    )
    counts = days.join(per_day, "_day").groupBy("chunk").agg(F.sum("_n").alias("n_granules"))
    return chunks.join(counts, "chunk", "left").select(
        "chunk", "chunk_start", "chunk_end",
        F.datediff("chunk_end", "chunk_start").cast("bigint").alias("n_days_minus_one"),
        F.coalesce("n_granules", F.lit(0)).cast("bigint").alias("n_granules"),
    ).withColumn("n_expected", F.col("n_days_minus_one") + 1).drop("n_days_minus_one")


def accounting_total(accounting: DataFrame) -> DataFrame:
    return accounting.agg(
        F.sum("n_granules").alias("n_granules"), F.sum("n_expected").alias("n_expected")
    )
