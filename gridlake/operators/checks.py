"""Quality gates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridlake.cluster import scratch_path
from gridlake.sources.fields import is_complete, mark_complete


class IncompleteField(ValueError):
    """A field lacks cells or values that it must have."""


def completeness_report(df: DataFrame, expected: int | None = None, value: str = "value") -> DataFrame:
    """One row: rows, missing values, rows expected, and whether the field is complete."""
    report = df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(value).isNull()).alias("n_missing")
    ).withColumn("n_expected", F.lit(expected).cast("bigint"))
    return report.withColumn(
        "complete",
        (F.col("n_missing") == 0) & (F.coalesce("n_expected", "n_rows") == F.col("n_rows")),
    )


def observe_complete(df: DataFrame, expected: int | None = None, value: str = "value") -> tuple[DataFrame, Callable[[], None]]:
    """The field with its rows and missing values counted by whatever job runs over it, and the check to call after that job.

    No job is started for the counts: they are observed metrics of the plan.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(value).isNull()).alias("n_missing"))

    def check() -> None:
        rows, missing = seen.get["n_rows"], seen.get["n_missing"]
        if missing or (expected is not None and rows != expected):
            raise IncompleteField(f"{missing} missing values in {rows} rows; expected {rows if expected is None else expected} rows")

    return counted, check


def write_complete(df: DataFrame, path: str, expected: int | None = None, value: str = "value", overwrite: bool = False,
                   partition_by: Sequence[str] = ()) -> bool:
    """``write_field`` for a field that must be complete: its success marker is set only if the check holds.

    The rows are counted while they are written, in the one job that writes them. A field that fails leaves files
    without a marker, which count as not there, and raises ``IncompleteField``.
    """
    spark = df.sparkSession
    if is_complete(spark, path) and not overwrite:
        return False
    counted, check = observe_complete(df, expected, value)
    counted.write.mode("overwrite").partitionBy(*partition_by).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    check()
    mark_complete(spark, path)
    return True


def require_complete(df: DataFrame, expected: int | None = None, value: str = "value") -> DataFrame:
    """The field itself, written once to the shared folder, if no value is missing and the row count is as expected.

    What comes before runs once: the check rides on the write (``write_complete``), and the stored rows are what is returned.
    """
    path = scratch_path(df.sparkSession, "complete")
    write_complete(df, path, expected, value)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def require_present(df: DataFrame, value: str = "value") -> DataFrame:
    """The same rule inside the plan: a job fails at the first missing value it meets."""
    return df.withColumn(value, F.when(F.col(value).isNotNull(), F.col(value)).otherwise(
        F.raise_error(F.lit(f"missing value in {value}")).cast(dict(df.dtypes)[value])
    ))


def require_valid_face(df: DataFrame, face: str = "face") -> DataFrame:
    """Fail when a face number is outside 0..11."""
    return df.withColumn(face, F.when(F.col(face).between(0, 11), F.col(face)).otherwise(
        F.raise_error(F.format_string("face out of range: %d", F.col(face).cast("bigint")))
        .cast(dict(df.dtypes)[face])
    ))
