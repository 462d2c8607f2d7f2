"""The stages of a training-data build, each a composition of operators.

A stage takes fields and parameters and returns a field. Stages that must look at their input first (time
axes, strict selections, tables that are read twice) run small jobs at once; the field itself is computed
when the caller writes it. Where a stage is read more than once by later ones, ``prepare_training_set`` writes it in between.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.cluster import broadcast_within, stage_table
from gridlake.functions import healpix, physics
from gridlake.operators import mask as masks
from gridlake.operators import regrid, select, stats, temporal
from gridlake.operators.align import align_inner
from gridlake.operators.reshape import append_roles, stack_channels, variable_files
from gridlake.operators.spine import densify, hpx_cells
from gridlake.sources import fields as src
from gridlake.sources import granules as gr
from gridlake.sources.parts import part_of, stage_parts

LL_KEYS = ("lat_idx", "lon_idx")


@dataclass(frozen=True)
class IndexGrid:
    """A regular grid whose cells are numbered ``y`` from ``lat0`` and ``x`` from ``lon0``."""

    ny: int = 3600
    nx: int = 7200
    lat0: float = 90.0
    dlat: float = -0.05
    lon0: float = -180.0
    dlon: float = 0.05

    def coords(self, df: DataFrame) -> DataFrame:
        """Degrees for ``y`` and ``x``, longitudes in 0..360."""
        return src.shift_longitude(src.assign_grid_coords(df, "y", "x", self.lat0, self.dlat, self.lon0, self.dlon))

    def axes(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """The latitudes and the longitudes, one row each."""
        y = spark.range(self.ny).select(F.col("id").alias("y"), F.lit(0).alias("x"))
        x = spark.range(self.nx).select(F.lit(0).alias("y"), F.col("id").alias("x"))
        return self.coords(y).select("lat"), self.coords(x).select("lon")


def process_satellite(cells: DataFrame, listing: DataFrame, spine: DataFrame, target_lats: DataFrame,
                      target_lons: DataFrame, grid: IndexGrid = IndexGrid(),
                      rows: tuple[int, int] | None = None) -> DataFrame:
    """Granule cells ``(path, y, x, value)`` to the target grid and times: ``(time, lat, lon, value)``.

    Only granules dated on a target time are used. Then nearest grid cell, then nearest time. The
    list of those granules is written once, as it serves the join and the time axis.
    """
    dated = gr.time_from_filename(gr.list_granules(listing))
    wanted = stage_table(gr.granules_in_range(dated, spine).select("path", "time"), "granules")
    found = cells.join(wanted, "path").select("time", "y", "x", "value")
    placed = grid.coords(found).select("time", "lat", "lon", "value")
    lats, lons = grid.axes(cells.sparkSession)
    on_grid = regrid.regrid_nearest(placed, target_lats, target_lons, source_lats=lats, source_lons=lons, rows=rows)
    return temporal.nearest_time(on_grid, spine, source_times=wanted.select("time"))


def impute_job(df: DataFrame, constant: float, start=None, end=None, keys: Sequence[str] = LL_KEYS,
               block: Column | None = None) -> DataFrame:
    """Slice, interpolate gaps in time, fill the rest with a constant. ``block`` as of ``interpolate_time``."""
    return temporal.impute(select.time_slice(df, start, end), constant, keys, block=block)


def impute_ocean_job(df: DataFrame, constant: float, start=None, end=None) -> DataFrame:
    """Slice and fill every missing value with a constant."""
    return temporal.fill_constant(select.time_slice(df, start, end), constant)


def derive_q2m(sp: DataFrame, td: DataFrame, start=None, end=None, keys: Sequence[str] = ("time", *LL_KEYS)) -> DataFrame:
    """2 m specific humidity from surface pressure (Pa) and 2 m dewpoint (K)."""
    p = select.time_slice(sp, start, end).select(*keys, F.col("value").alias("_sp"))
    t = select.time_slice(td, start, end).select(*keys, F.col("value").alias("_td"))
    return align_inner(p, t, keys).select(
        *keys, physics.specific_humidity(F.col("_sp"), F.col("_td")).alias("value")
    )


def accumulate_and_select(df: DataFrame, times: Sequence[str] | DataFrame | None = None, level: float | None = None,
                          accumulation_period: int | None = None, step: str | None = None,
                          keys: Sequence[str] = LL_KEYS, strict: bool = True) -> DataFrame:
    """Pick a level, accumulate over the trailing steps, then select the requested times.

    ``times`` is a list or a table of times; left out, the field is one that does not change in time.
    """
    if level is not None:
        df = select.select_level(df, level)
    if accumulation_period is not None:
        df = temporal.rolling_sum(df, accumulation_period, keys, step=step)
    df = select.drop_constant_time(df, times, strict=strict)
    if accumulation_period is not None:
        df = src.with_metadata(df, "value", {"accumulation_period": accumulation_period})
    return df


def mask_job(df: DataFrame, nside: int, edges: DataFrame, fill: float, start=None, end=None,
             mask_south: bool = False, mask: DataFrame | None = None, edge_rows: int | None = None) -> DataFrame:
    """Overwrite ice sheets, and on request everything south of 60 S, with a fill value.

    ``mask`` reuses a stored mask instead of testing the cells again. ``edge_rows`` bounds the number of edges.
    """
    if mask is None:
        mask = masks.icesheet_mask(hpx_cells(df.sparkSession, nside), edges, -60.0 if mask_south else None, rows=edge_rows)
    return masks.apply_mask(select.time_slice(df, start, end), mask, fill, rows=healpix.npix(nside))


def land_constants(df: DataFrame, variable: str, start=None, end=None, metas: Sequence[str] = stats.METAS,
                   keys: Sequence[str] = ("pix",)) -> DataFrame:
    """Time-invariant fields of a variable: range of its day-of-year climatology."""
    return stats.clim_metas(select.time_slice(df, start, end), variable, metas, keys)


def remap_job(df: DataFrame, nside: int, nlat: int, nlon: int, start=None, end=None, **kwargs) -> DataFrame:
    return regrid.remap_ll_to_hpx(select.time_slice(df, start, end), nside, nlat, nlon, **kwargs)


def trailing_average_job(df: DataFrame, window: str, dt: str, start=None, end=None,
                         keys: Sequence[str] = ("pix",), axis: DataFrame | None = None) -> DataFrame:
    """Slice, then average over the trailing window; the first steps of the slice are missing."""
    return temporal.trailing_mean_over(select.time_slice(df, start, end), window, dt, keys=keys, axis=axis)


def standardise(df: DataFrame, variable: str, start=None, end=None, log_epsilon: float | None = None) -> DataFrame:
    """One stored variable as ``(time, pix, value)``, on its own times."""
    df = src.rename_conventions(df, variable)
    if "varlev" in df.columns:
        df = select.first_varlev(df)
    df = select.time_slice(select.drop_columns(df), start, end)
    if variable in df.columns:
        df = df.withColumnRenamed(variable, "value")
    df = df.select("time", "pix", "value")
    if log_epsilon is not None:
        df = df.withColumn("value", physics.log_scale(F.col("value"), log_epsilon))
    return df


def compile_training(inputs: Mapping[str, DataFrame], outputs: Mapping[str, DataFrame],
                     constants: Mapping[str, DataFrame] | DataFrame, spine: DataFrame, start=None, end=None,
                     log_epsilon: Mapping[str, float] | None = None) -> DataFrame:
    """All roles of a training store in long form: ``(role, channel, channel_idx, time, pix, value)``.

    Without outputs the inputs are the targets; a variable in both is read from the output's field.
    Constants carry no time; they are fields by name, or one table (channel, channel_idx, pix, value). One job on the labels of all variables puts them on the spine's times.
    """
    scaling = log_epsilon or {}
    chosen = variable_files(inputs, outputs)
    ready = temporal.align_to_axes({name: standardise(df, name, start, end, scaling.get(name)) for name, df in chosen.items()}, spine)
    targets = list(outputs or inputs)
    store = None
    for name, df in ready.items():
        places = [(role, names.index(name)) for role, names in (("inputs", list(inputs)), ("targets", targets)) if name in names]
        part = in_roles(df, name, places)
        store = part if store is None else store.unionByName(part)
    if isinstance(constants, DataFrame):
        store = store.unionByName(constants.select(F.lit("constants").alias("role"), "channel", "channel_idx",
                                                   F.lit(None).cast("timestamp_ntz").alias("time"), "pix", "value"))
    elif constants:
        still = {name: df.select(F.lit(None).cast("timestamp_ntz").alias("time"), "pix", "value")
                 for name, df in constants.items()}
        store = store.unionByName(stack_channels(still, "constants"))
    return select.cast_value(store, "float").select("role", "channel", "channel_idx", "time", "pix", "value")


def in_roles(df: DataFrame, channel: str, places: Sequence[tuple[str, int]]) -> DataFrame:
    """A field as a channel of one or more roles; it is read once however many there are."""
    roles = F.array(*[F.struct(F.lit(role).alias("role"), F.lit(i).alias("channel_idx")) for role, i in places])
    return df.withColumn("_place", F.explode_outer(roles)).select(
        "_place.role", F.lit(channel).alias("channel"), "_place.channel_idx", *df.columns
    )


def pack_training(store: DataFrame, nside: int, unique: bool = False) -> DataFrame:
    """A long training store as one dense block per (role, channel, time, face)."""
    cells = healpix.with_face_height_width(store, nside).withColumn(
        "position", F.col("height") * nside + F.col("width")
    )
    return src.pack_frames(cells, ["role", "channel", "channel_idx", "time", "face"], "position", size=nside * nside, unique=unique)


def merge_training(stores: Mapping[str, Sequence[tuple[DataFrame, Sequence[str]]]], times=None,
                   strict: bool = True) -> DataFrame:
    """Chosen channels of several stores as one; ``times`` applies to inputs and targets.

    As a table of times (``time_spine``) it selects exactly these and, if ``strict``, each must be there; one job
    checks the channels and times of all parts.
    """
    roles = {role: [(df.filter(F.col("role") == role), names) for df, names in parts] for role, parts in stores.items()}
    return append_roles(roles, {role: None if role == "constants" else times for role in roles}, strict)


@dataclass(frozen=True)
class TrainingSet:
    """Parameters of a whole build."""

    start: str
    end: str
    freq: str
    nside: int
    nlat: int
    nlon: int
    window: str
    ocean_fill: float = 1.0
    satellite_fill: float = -1.0
    grid: IndexGrid = field(default_factory=IndexGrid)
    mask_south: bool = True
    wrap: str = "clamp"
    period: str = "year"        # of the folders that stored stages are cut into, and of the blocks of gap filling


def prepare_training_set(params: TrainingSet, soil: DataFrame, sp: DataFrame, td: DataFrame, cells: DataFrame,
                         listing: DataFrame, edges: DataFrame, spine: DataFrame, times: Column,
                         ll_cells: DataFrame, edge_rows: int | None = None) -> DataFrame:
    """From stored fields to a training store, in the order of the stages.

    ``ll_cells(lat_idx, lon_idx, lat, lon)`` is the target lat/lon grid and ``times`` the array of
    target times; ``edge_rows`` bounds the number of edges. Fields that several later stages read are written once to
    the shared folder, cut by time and laid out along the cells (``sources.parts``).
    """
    p = params
    span = {"start": p.start, "end": p.end}
    soil = impute_ocean_job(soil, p.ocean_fill, **span)
    q2m = derive_q2m(sp, td, **span)
    sat = process_satellite(cells, listing, spine, ll_cells.select("lat"), ll_cells.select("lon"), p.grid, (p.nlat, p.nlon))
    sat = sat.join(broadcast_within(ll_cells, p.nlat * p.nlon), ["lat", "lon"]).select("time", *LL_KEYS, "value")
    ndvi = impute_job(densify(sat, ll_cells, LL_KEYS, times), p.satellite_fill, **span, block=part_of(F.col("time"), p.period))

    # All variables cross to the cells together, and lie there cut by variable and time.
    spark = soil.sparkSession
    hpx = hpx_cells(spark, p.nside)
    weights = regrid.ll_to_hpx_weights(hpx, p.nlat, p.nlon, wrap=p.wrap)
    masked = broadcast_within(masks.icesheet_mask(hpx, edges, -60.0 if p.mask_south else None, rows=edge_rows)
                              .filter("mask").select("pix", F.lit(True).alias("_masked")), healpix.npix(p.nside))
    every = functools.reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("variable"), "time", *LL_KEYS, "value") for name, df in (("ndvi", ndvi), ("swvl1", soil), ("q2m", q2m))])
    on_cells = regrid.apply_weights(every, weights, LL_KEYS, ["pix"], ("variable", "time"), rows=4 * healpix.npix(p.nside))
    fill = F.when(F.col("variable") == "ndvi", F.lit(p.satellite_fill)).when(F.col("variable") == "swvl1", F.lit(p.ocean_fill))
    on_cells = on_cells.join(masked, "pix", "left").withColumn(
        "value", F.when(F.col("_masked") & fill.isNotNull(), fill).otherwise(F.col("value"))).drop("_masked")
    stored = stage_parts(on_cells, "fields", p.period, nside=p.nside, by=["variable"])
    one = lambda name: stored.filter(F.col("variable") == name).select("time", "pix", "value")
    mean = trailing_average_job(one("q2m"), p.window, p.freq, axis=one("q2m").select("time"))
    q2m_mean = stage_parts(mean, "q2m", p.period, nside=p.nside)

    ranges = stats.clim_metas(stored.filter(F.col("variable").isin("ndvi", "swvl1")), "c", keys=("variable", "pix"))
    kinds = [("ndvi", "annual_range"), ("swvl1", "min"), ("swvl1", "max")]
    still = ranges.select("variable", "pix", F.explode(F.array(*[
        F.struct(F.lit(v).alias("of"), F.lit(f"{v}_{m}").alias("channel"), F.lit(i).alias("channel_idx"), F.col(f"c_{m}").alias("value"))
        for i, (v, m) in enumerate(kinds)])).alias("c")).filter(F.col("c.of") == F.col("variable"))
    return compile_training(
        {"ndvi": one("ndvi"), "swvl1": one("swvl1"), "q2m-mean": q2m_mean}, {"ndvi": one("ndvi"), "swvl1": one("swvl1")},
        still.select("c.channel", "c.channel_idx", "pix", "c.value"), spine, **span
    )
