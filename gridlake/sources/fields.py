"""Scan, normalise, lay out and write field tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlake.cluster import stage_table
from gridlake.functions.geo import lon_to_360
from gridlake.sources.parts import write_parts

# Names that older or other files give to the standard coordinates (fixed values).
OLD_NAMES = {
    "valid_time": "time",
    "sample": "time",
    "YDim:CMGgrid": "latitude",
    "XDim:CMGgrid": "longitude",
    "lat": "latitude",
    "lon": "longitude",
}


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def scan_field(spark: SparkSession, path, variable: str, keys: Sequence, value: str = "value") -> DataFrame:
    """Read one variable and its coordinates; other columns are not read. NaN becomes NULL.

    ``keys`` are column names or named columns computed from the file.
    """
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    v = F.col(variable)
    if dict(df.dtypes)[variable] in ("double", "float"):
        v = nan_to_null(v)
    return df.select(*keys, v.alias(value))


def scan_union(spark: SparkSession, paths: Sequence[str], keys: Sequence[str], check: bool = False, along: str | None = None) -> DataFrame:
    """Read many files of one field as one table. Files are matched by column name.

    A column that only some files have is missing in the rows of the others. ``check=True`` makes two rows for one label an
    error. With ``along``, the coordinate that tells the files apart, only files whose stretches of it overlap are
    searched for such rows; without, the key columns of the whole field are.
    """
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    if check:
        suspects = df if along is None else overlapping_rows(df, along)
        repeated = duplicate_labels(suspects, keys).limit(1).collect()
        if repeated:
            raise ValueError(f"label occurs more than once: {repeated[0].asDict()}")
    return df


def file_stretches(df: DataFrame, along: str) -> DataFrame:
    """One row for each file of a scan: ``file``, first and last label (``low``, ``high``), ``rows``, and ``stretch``.

    Files are swept in order of their first label: one that starts after all files before it have ended begins a
    new stretch, so files of different stretches share no label. Only the coordinate is read, and what is sorted is
    one row a file. Files without a label (no rows, or none with one) belong to no stretch and are not listed.
    """
    files = df.select(F.col("_metadata.file_path").alias("file"), along).groupBy("file").agg(
        F.min(along).alias("low"), F.max(along).alias("high"), F.count(along).alias("rows")).filter("rows > 0")
    order = Window.orderBy("low", "high", "file")
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = files.withColumn("_new", F.when(before.isNull() | (F.col("low") > before), 1).otherwise(0))
    return starts.withColumn("stretch", F.sum("_new").over(order) - 1).drop("_new")


def overlapping_rows(df: DataFrame, along: str) -> DataFrame:
    """The rows of those files of a scan that share a stretch with another file; the other files are not read again."""
    stretches = file_stretches(df, along)
    shared = stretches.groupBy("stretch").agg(F.count(F.lit(1)).alias("_n"), F.collect_list("file").alias("_files")).filter("_n > 1")
    names = [r[0] for r in shared.select(F.explode("_files")).collect()]        # names of files, of those that overlap
    if not names:
        return df.limit(0)
    return df.sparkSession.read.schema(df.schema).parquet(*names)


def concat_fields(fields: Sequence[DataFrame]) -> DataFrame:
    """Concatenate fields along a coordinate, matching columns by name.

    A column that only some fields have is missing in the rows of the others.
    """
    out = fields[0]
    for field in fields[1:]:
        out = out.unionByName(field, allowMissingColumns=True)
    return out


def duplicate_labels(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def rename_conventions(df: DataFrame, variable: str | None = None) -> DataFrame:
    """Old coordinate names to the standard ones; ``predictors`` to the variable's own name.

    A name is left alone when the standard column is already there.
    """
    names = dict(OLD_NAMES)
    if variable is not None:
        names["predictors"] = variable
    taken = set(df.columns)
    todo = {}
    for old in df.columns:
        new = names.get(old)
        if new is not None and new not in taken:
            todo[old] = new
            taken.add(new)
    return df.withColumnsRenamed(todo)


def assign_grid_coords(df: DataFrame, y="y", x="x", lat0=90.0, dlat=-0.05, lon0=-180.0, dlon=0.05) -> DataFrame:
    """Grid indices to degrees; the defaults are those of the 0.05 degree satellite grid."""
    return df.withColumns({
        "lat": F.lit(float(lat0)) + F.lit(float(dlat)) * F.col(y),
        "lon": F.lit(float(lon0)) + F.lit(float(dlon)) * F.col(x),
    })


def shift_longitude(df: DataFrame, lon: str = "lon") -> DataFrame:
    return df.withColumn(lon, lon_to_360(F.col(lon)))


def with_metadata(df: DataFrame, column: str, attributes: Mapping) -> DataFrame:
    """Attach attributes to a column; those already there are kept unless named again."""
    merged = {**df.schema[column].metadata, **attributes}
    return df.withMetadata(column, merged)


def _marker(spark: SparkSession, path: str):
    """The file system and path of a success marker. Goes through the session's JVM, so not in a Connect session."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()), marker


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether an earlier write to ``path`` finished (its success marker is there)."""
    store, marker = _marker(spark, path)
    return store.exists(marker)


def mark_complete(spark: SparkSession, path: str) -> None:
    """Set the success marker of a folder that was written without one."""
    store, marker = _marker(spark, path)
    store.create(marker, True).close()


def write_field(df: DataFrame | Callable[[], DataFrame], path: str, overwrite: bool = False,
                partition_by: Sequence[str] = (), spark: SparkSession | None = None) -> bool:
    """Write a field unless a finished one is there; returns whether it wrote.

    As a function of no arguments ``df`` is only called if there is something to write, so that a stage
    that looks at its input while it is built (strict selections, staged tables) does no work either; give
    ``spark`` with it. Leftovers of a write that did not finish are replaced.
    """
    if is_complete(spark or df.sparkSession, path) and not overwrite:
        return False
    if not isinstance(df, DataFrame):
        df = df()
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return True


def run_jobs(spark: SparkSession, jobs: Sequence[Mapping]) -> list[bool]:
    """Run a list of jobs, each ``{"path": ..., "make": function of no arguments, ...}``, that are not done yet.

    Further entries are options of ``write_field``. Returns which ones wrote.
    """
    out = []
    for job in jobs:
        options = {k: v for k, v in job.items() if k not in ("path", "make")}
        out.append(write_field(job["make"], job["path"], spark=spark, **options))
    return out


def layout_by_time(df: DataFrame, time: str = "time", within: Sequence[str] = ()) -> DataFrame:
    """Order for spatial work: consecutive times together, sorted within each partition.

    Cells are part of the range key, so that one time holding much of the data is split too.
    """
    return df.repartitionByRange(F.col(time), *within).sortWithinPartitions(time, *within)


def layout_by_cell(df: DataFrame, cell: Sequence[str], time: str = "time") -> DataFrame:
    """Order for time-axis work: each series in time order.

    Range partitioning on (cell, time) keeps a series together and still splits one that is larger
    than a partition.
    """
    return df.repartitionByRange(*cell, time).sortWithinPartitions(*cell, time)


def pack_frames(df: DataFrame, frame: Sequence[str], position: str, value: str = "value",
                size: int | None = None, unique: bool = False) -> DataFrame:
    """One dense FLOAT array per frame, ordered by ``position`` (a cell's place in the frame).

    ``frame`` names the key of a block, for example (role, channel, time) or, with a fine grid,
    (role, channel, time, face), which bounds a block by the cells of one face. A position that
    occurs twice is an error, as is a block whose length differs from ``size`` when that is given.

    Rows are first brought to one per position, so that a block cannot outgrow its frame. A caller
    who knows that labels do not repeat saves that shuffle with ``unique=True``.
    """
    cell = F.col(value).cast("float")
    if unique:
        cells = df.select(*frame, F.col(position).alias("_p"), cell.alias("_v"), F.lit(1).alias("_n"))
    else:
        cells = df.groupBy(*frame, F.col(position).alias("_p")).agg(
            F.first(cell).alias("_v"), F.count(F.lit(1)).alias("_n"))
    packed = cells.groupBy(*frame).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_p").alias("p"), F.col("_v").alias("v")))).alias("_cells"),
        F.max("_n").alias("_n"),
    )
    n = F.size("_cells")
    ok = F.col("_n") == 1
    if unique:      # the caller's word is checked where the positions stand side by side
        ok = ok & (F.size(F.array_distinct(F.transform("_cells", lambda c: c["p"]))) == n)
    if size is not None:
        ok = ok & (n == size)
    return packed.select(
        *frame,
        F.when(ok, F.transform("_cells", lambda c: c["v"])).otherwise(
            F.raise_error(F.format_string("frame is not dense: %d cells, up to %d rows for one", n, F.col("_n")))
            .cast("array<float>")
        ).alias("values"),
    )


def unpack_frames(df: DataFrame, frame: Sequence[str]) -> DataFrame:
    """Packed frames back to one row per cell."""
    return df.select(*frame, F.posexplode("values").alias("position", "value"))


def write_frames(df: DataFrame, path: str, overwrite: bool = False, period: str = "year", files: int = 4) -> bool:
    """Packed frames on disk: a folder for each role, channel and period (``sources.parts``), with at most ``files`` files."""
    if is_complete(df.sparkSession, path) and not overwrite:
        return False
    write_parts(df, path, period, cell=[c for c in ("face",) if c in df.columns], files=files, by=["role", "channel"])
    return True


def staged(df: DataFrame, name: str) -> DataFrame:
    return stage_table(df, name)
