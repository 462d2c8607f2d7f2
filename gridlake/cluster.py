"""What the library asks of the session: shared scratch space and checked broadcasts."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A table is hinted as broadcast only if a bound of its rows, times the bytes of a row, stays below this.
BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> int | None:
    """Bytes of a row of fixed-size columns; None if a column's values can be of any length."""
    sizes = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4,
             "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}
    kinds = [sizes.get(t) for _, t in df.dtypes]
    return None if None in kinds else 8 + 8 * len(kinds)


def broadcast_within(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Hint a broadcast when parameters bound ``df`` to few bytes; otherwise leave the join to Spark.

    ``rows`` is an upper bound that follows from parameters (a grid size, an axis length). Nothing is
    counted: without a bound the optimizer, and adaptive execution once it knows sizes, decide.
    """
    width = row_bytes(df)
    if rows is None or width is None or rows * width > BROADCAST_BYTES:
        return df
    return F.broadcast(df)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it in ``spark.checkpoint.dir``.

    In local mode, where driver and executors share one disk, a temporary folder stands in.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="gridlake-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other table has."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so later steps start from files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def stage_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, order: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder, dealt into ``buckets`` files by ``keys`` and sorted within by them and ``order``.

    What comes later and works by these keys or by more (windows of a series, climatologies, joins of two such stages
    with as many buckets) finds the rows where they are, and shuffles nothing. That pays for fields whose
    series are equally long, as those on a grid are; a bucket is one task, so rows of a hot key are not split.

    Joins by more keys than the buckets have need a session from ``co_partitioned``. The stage is a table of the
    session's catalog, as the buckets are told there; only its entry is local to the application, not the files.
    """
    spark = df.sparkSession
    table = f"stage_{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys, *order) \
        .option("path", scratch_path(spark, name)).format("parquet").saveAsTable(table)
    return spark.table(table)


def co_partitioned(spark: SparkSession) -> SparkSession:
    """A session of the same application, with the same tables, in which a join by (cell, time) uses an order by cell.

    Spark otherwise deals both sides anew unless they are dealt by all the join's keys.
    """
    other = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        if (value := spark.conf.get(key, None)) is not None:
            other.conf.set(key, value)
    other.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return other
