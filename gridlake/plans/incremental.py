"""A build that takes new granules and rewrites only what they change.

A build is a folder of stored fields, each cut by time (``sources.parts``). Every step knows which parts of its
output a changed part of its input reaches, and reads the parts that those need:

- a label of the target axis changes if its source label does, or if its source was delivered again
  (``changed_labels`` compares the two axis maps, which are small);
- filling gaps in time reaches back to the last valid value and on to the next one. These stand in a table with one
  row for each series and part (``ends_of``), so a part is filled from itself and that table, and
  ``changed_parts`` are the parts for which some series has another neighbour than before;
- a trailing window of n steps reaches n - 1 steps on, and needs as many before (``parts_reached``, ``parts_needed``);
- remaps, masks and scalings reach nothing but their own time;
- a climatology is the sum of its parts' states.

A first build is the same with all parts changed, so both give the same store.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlake.cluster import broadcast_within, stage_table
from gridlake.functions import healpix
from gridlake.functions.timeaxis import elapsed_seconds, freq_seconds
from gridlake.operators import mask as masks
from gridlake.operators import regrid, stats, temporal
from gridlake.operators.axis import axis_map
from gridlake.operators.reshape import stack_channels
from gridlake.operators.select import cast_value
from gridlake.operators.spine import hpx_cells
from gridlake.plans.jobs import LL_KEYS, IndexGrid, in_roles
from gridlake.sources import granules as gr
from gridlake.sources.fields import is_complete
from gridlake.sources.parts import part_label, part_span, parts_between, read_parts, write_parts


# --- which parts a change reaches -----------------------------------------------------------------

def changed_labels(before: DataFrame | None, after: DataFrame, redelivered: DataFrame, time: str = "time") -> DataFrame:
    """Rows of the axis map ``after`` whose values differ from those under ``before``: (time, src, inside)."""
    if before is None:
        return after
    old = before.select(F.col(time).alias("_t"), F.col("src").alias("_src"), F.col("inside").alias("_inside"))
    again = redelivered.select(F.col(time).alias("_again")).distinct()
    # An outside label has no value whatever its nearest source is.
    same = F.col("inside").eqNullSafe(F.col("_inside")) & (~F.col("inside") | F.col("src").eqNullSafe(F.col("_src")))
    both = after.join(old, F.col(time) == F.col("_t"), "left").join(again, F.col("src") == F.col("_again"), "left")
    return both.filter(~same | F.col("_t").isNull() | (F.col("inside") & F.col("_again").isNotNull())).select(time, "src", "inside")


def ends_of(df: DataFrame, keys: Sequence[str], time: str = "time", value: str = "value", part: str = "part") -> DataFrame:
    """First and last valid (time, value) of each series in each part; missing where it has none."""
    row, at = F.struct(F.col(time).alias("time"), F.col(value).alias("value")), F.when(F.col(value).isNotNull(), F.col(time))
    return df.groupBy(*keys, part).agg(F.min_by(row, at).alias("first"), F.max_by(row, at).alias("last"))


def around(ends: DataFrame, keys: Sequence[str], part: str = "part") -> DataFrame:
    """For each series and part: the last valid row before the part (``before``) and the first after it (``after``).

    A window over one row for each part, so it is bounded by the number of periods.
    """
    w = Window.partitionBy(*keys).orderBy(part)
    return ends.select(*keys, part,
                       F.last("last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
                       F.first("first", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("after"))


def changed_parts(old: DataFrame, new: DataFrame, keys: Sequence[str], part: str = "part") -> set[str]:
    """Parts for which some series has another neighbour before or after than it had."""
    labels = [*keys, part]
    was = old.select(*[F.col(c).alias(f"_{c}") for c in labels], F.col("before").alias("_before"), F.col("after").alias("_after"))
    same_row = [F.col(c) == F.col(f"_{c}") for c in labels]
    both = new.join(was, same_row, "left")
    other = ~(F.col("before").eqNullSafe(F.col("_before")) & F.col("after").eqNullSafe(F.col("_after")))
    return {r[0] for r in both.filter(other).select(part).distinct().collect()}


def parts_reached(changed: Iterable[str], known: Iterable[str], seconds: int, period: str) -> set[str]:
    """The known parts whose trailing windows of ``seconds`` meet a changed one, themselves included."""
    known, out = set(known), set()
    for part in changed:
        start, past = part_span(part)
        out |= set(parts_between(start, past - timedelta(microseconds=1) + timedelta(seconds=seconds), period)) & known
    return out


def parts_needed(parts: Iterable[str], known: Iterable[str], seconds: int, period: str) -> set[str]:
    """The known parts that trailing windows of ``seconds`` in ``parts`` read."""
    known, out = set(known), set()
    for part in parts:
        start, past = part_span(part)
        out |= set(parts_between(start - timedelta(seconds=seconds), past - timedelta(microseconds=1), period)) & known
    return out


def known_parts(spark: SparkSession, path: str) -> set[str]:
    """The parts of a stored field; none if it is not there."""
    return {r[0] for r in spark.read.parquet(path).select("part").distinct().collect()} if is_complete(spark, path) else set()


# --- steps ------------------------------------------------------------------------------------------

def interpolate_parts(rows: DataFrame, neighbours: DataFrame, keys: Sequence[str], time: str = "time", value: str = "value",
                      part: str = "part") -> DataFrame:
    """``temporal.interpolate_time`` for some parts of a field, given what lies ``around`` them."""
    w = Window.partitionBy(*keys, part).orderBy(time)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(time).alias("time"), F.col(value).alias("value")))
    near = rows.withColumn("_k", known).withColumns({
        "_p": F.last("_k", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "_n": F.coalesce("_k", F.expr(f"lead(_k, 1) IGNORE NULLS OVER (PARTITION BY {', '.join(f'`{k}`' for k in (*keys, part))} ORDER BY `{time}`)")),
    }).join(neighbours, [*keys, part], "left")
    p, n = F.coalesce("_p", "before"), F.coalesce("_n", "after")
    line = p["value"] + (n["value"] - p["value"]) * (elapsed_seconds(p["time"], F.col(time)) / elapsed_seconds(p["time"], n["time"]))
    return near.withColumn(value, F.coalesce(F.col(value), F.when(n["time"] > p["time"], line))).select(*rows.columns)


def update_trailing(spark: SparkSession, source: str, target: str, changed: Iterable[str], n: int, step: str,
                    keys: Sequence[str] = ("pix",), period: str = "year", **layout) -> set[str]:
    """Bring the trailing mean at ``target`` up to date with a regular field at ``source``; returns the parts rewritten.

    ``changed`` are the source's changed parts; parts that the target does not have yet are added. Means of the
    first n - 1 steps of the field are missing, so a field that grows backward changes its old first steps too.
    """
    known = known_parts(spark, source)
    seconds = (n - 1) * freq_seconds(step)
    todo = parts_reached(set(changed) | (known - known_parts(spark, target)), known, seconds, period)
    if todo:
        rows = read_parts(spark, source, parts_needed(todo, known, seconds, period)).drop("part")
        mean = temporal.trailing_mean(rows, n, keys, step=step)
        write_parts(mean, target, period, only=todo if is_complete(spark, target) else None, **layout)
    return todo


def update_states(spark: SparkSession, source: str, target: str, changed: Iterable[str], keys: Sequence[str] = ("pix",),
                  period: str = "year") -> None:
    """Bring the climatology's states at ``target``, one for each part, up to date with a stored field."""
    changed = set(changed)
    if changed:
        rows = read_parts(spark, source, changed)
        state = stats.climatology_state(rows, ["part", *keys])
        _replace(state, target, changed)


def _replace(df: DataFrame, path: str, parts: Iterable[str]) -> None:
    """Write a small table with a folder for each part, replacing these parts if it is there."""
    spark = df.sparkSession
    mode = "dynamic" if is_complete(spark, path) else "static"
    stage_table(df.filter(F.col("part").isin(sorted(parts))), "parts").repartition("part").write.partitionBy("part") \
        .mode("overwrite").option("partitionOverwriteMode", mode).parquet(path)


# --- the satellite branch of a build ---------------------------------------------------------------

@dataclass(frozen=True)
class Build:
    """Where a build lies and what it is made for. ``ll_cells`` as of ``prepare_training_set``."""

    root: str
    spine: DataFrame
    ll_cells: DataFrame
    edges: DataFrame
    nside: int
    nlat: int
    nlon: int
    fill: float = -1.0
    period: str = "year"
    grid: IndexGrid = IndexGrid()
    wrap: str = "clamp"
    south_of: float | None = -60.0
    files: int = 4

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def static(self, name: str, make) -> DataFrame:
        """A table that depends on the grids only: written at the first build, read afterwards."""
        spark, path = self.spine.sparkSession, self.at(name)
        if not is_complete(spark, path):
            make().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


def add_granules(build: Build, cells: DataFrame, listing: DataFrame) -> dict[str, set[str]]:
    """Take granule cells (path, y, x, value) into the build; returns the parts rewritten of each stored field.

    Granules dated off the target axis are left out, as in ``process_satellite``. A day that was there before is replaced
    by its new granules. Running it again with the same granules gives the same store, so a run that broke off
    is simply repeated.
    """
    b, spark, period = build, cells.sparkSession, build.period
    wanted = stage_table(gr.granules_in_range(gr.time_from_filename(gr.list_granules(listing)), b.spine).select("path", "time"), "granules")
    days = wanted.select("time").distinct()
    new_days = [r[0] for r in days.collect()]                       # at most the labels of the axis
    if not new_days:
        return {"nearest": set(), "satellite": set(), "ndvi": set()}

    # Source days on the target grid; only the folders of the new days are written.
    lats, lons = b.grid.axes(spark)
    placed = b.grid.coords(cells.join(wanted, "path").select("time", "y", "x", "value")).select("time", "lat", "lon", "value")
    near = regrid.regrid_nearest(placed, b.ll_cells.select("lat"), b.ll_cells.select("lon"), source_lats=lats, source_lons=lons, rows=(b.nlat, b.nlon))
    near = near.join(broadcast_within(b.ll_cells, b.nlat * b.nlon), ["lat", "lon"]).select("time", *LL_KEYS, "value")
    touched = {part_label(t, period) for t in new_days}
    first = not is_complete(spark, b.at("times"))
    if not first:
        kept = read_parts(spark, b.at("nearest"), touched).drop("part").join(days, "time", "left_anti")
        near = near.unionByName(kept)
    old_times = None if first else stage_table(spark.read.parquet(b.at("times")), "times")
    write_parts(near, b.at("nearest"), period, cell=LL_KEYS, files=b.files, only=None if first else touched)

    # Labels of the target axis that now take other values, and their parts of the dense field.
    times = days if first else stage_table(old_times.unionByName(days).distinct(), "times")
    after = axis_map(times, b.spine, "time", "nearest")
    before = None if first else axis_map(old_times, b.spine, "time", "nearest")
    labels = stage_table(changed_labels(before, after, days), "labels")
    moved = labels.collect()                                        # at most the labels of the axis
    sources = {part_label(r["src"], period) for r in moved if r["inside"]}
    changed = {part_label(r["time"], period) for r in moved}
    taken = read_parts(spark, b.at("nearest"), sources).select(F.col("time").alias("src"), *LL_KEYS, "value") \
        .join(labels.filter("inside").select("time", "src"), "src").select("time", *LL_KEYS, "value")
    grid = broadcast_within(b.ll_cells.select(*LL_KEYS), b.nlat * b.nlon)
    index = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    slots = labels.select("time", index(b.nlat).alias("lat_idx")).select("time", "lat_idx", index(b.nlon).alias("lon_idx")) \
        .join(grid, list(LL_KEYS), "left_semi")
    dense = slots.join(taken, [*LL_KEYS, "time"], "left").select("time", *LL_KEYS, "value")
    if not first:
        old = read_parts(spark, b.at("satellite"), changed).drop("part").join(labels, "time", "left_anti")
        dense = dense.unionByName(old)
    write_parts(dense, b.at("satellite"), period, cell=LL_KEYS, files=b.files, only=None if first else changed)

    # Gaps are filled anew where a series has other values or other neighbours.
    ends = ends_of(read_parts(spark, b.at("satellite"), changed), LL_KEYS)
    filled = changed
    if not first:
        old_ends = spark.read.parquet(b.at("ends"))
        ends = ends.unionByName(old_ends.filter(~F.col("part").isin(sorted(changed))))
    ends = stage_table(ends, "ends")
    beside = stage_table(around(ends, LL_KEYS), "around")
    if not first:
        filled = changed | changed_parts(around(old_ends, LL_KEYS), beside, LL_KEYS)
    rows = read_parts(spark, b.at("satellite"), filled)
    full = temporal.fill_constant(interpolate_parts(rows, beside.filter(F.col("part").isin(sorted(filled))), LL_KEYS), b.fill).drop("part")

    hpx = hpx_cells(spark, b.nside)
    weights = b.static("weights", lambda: regrid.ll_to_hpx_weights(hpx, b.nlat, b.nlon, wrap=b.wrap))
    mask = b.static("mask", lambda: masks.icesheet_mask(hpx, b.edges, b.south_of))
    ndvi = masks.apply_mask(regrid.remap_ll_to_hpx(full, b.nside, b.nlat, b.nlon, weights=weights), mask, b.fill, rows=healpix.npix(b.nside))
    write_parts(ndvi, b.at("ndvi"), period, nside=b.nside, files=b.files, only=None if first else filled)
    update_states(spark, b.at("ndvi"), b.at("climatology"), filled, period=period)
    # What the comparisons start from comes last: until then, a repeated run finds the same changes.
    _replace(ends, b.at("ends"), changed)
    times.coalesce(1).write.mode("overwrite").parquet(b.at("times"))
    return {"nearest": touched, "satellite": changed, "ndvi": filled}


def satellite_store(build: Build, channel: str = "ndvi", metas: Sequence[str] = ("annual_range",)) -> DataFrame:
    """The build's channel as a training store in long form, with its constants from the climatology's states."""
    spark = build.spine.sparkSession
    field = spark.read.parquet(build.at("ndvi")).select("time", "pix", "value")
    store = in_roles(field, channel, [("inputs", 0), ("targets", 0)])
    state = stats.merge_states(spark.read.parquet(build.at("climatology")).drop("part"), ("pix",))
    still = stats.metas_of_state(state, channel, metas, ("pix",))
    named = {f"{channel}_{m}": still.select(F.lit(None).cast("timestamp_ntz").alias("time"), "pix", F.col(f"{channel}_{m}").alias("value")) for m in metas}
    store = store.unionByName(stack_channels(named, "constants"))
    return cast_value(store, "float").select("role", "channel", "channel_idx", "time", "pix", "value")
