from pyspark.sql import functions as F

from gridlake.cluster import co_partitioned, stage_bucketed
from gridlake.operators import stats, temporal
from gridlake.operators.align import align_inner


def field(spark, factor, skip):
    cells = spark.range(40).withColumnRenamed("id", "cell")
    times = F.sequence(F.lit("2023-12-01").cast("timestamp_ntz"), F.lit("2024-03-01").cast("timestamp_ntz"), F.make_dt_interval(days=F.lit(1)))
    rows = cells.withColumn("time", F.explode(times)).withColumn("value", (F.col("cell") * factor + F.dayofyear("time")) % 17 * 1.0)
    return rows.filter((F.col("cell") + F.dayofmonth("time")) % skip != 0)


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = df._jdf.queryExecution().executedPlan().toString()
    df.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return text


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_by_cell_shuffle_nothing(spark):
    other = co_partitioned(spark)
    a, b = field(other, 3, 7), field(other, 5, 11)
    left, right = (stage_bucketed(x.withColumnRenamed("value", n), n, ["cell"], 4, ["time"]) for x, n in ((a, "sp"), (b, "td")))
    assert len(left.inputFiles()) == 4
    joined = align_inner(left, right, ["cell", "time"])
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    assert rows(joined) == rows(align_inner(a.withColumnRenamed("value", "sp"), b.withColumnRenamed("value", "td"), ["cell", "time"]))
    mean = temporal.trailing_mean(left.withColumnRenamed("sp", "value"), 3, step="D")
    assert "Exchange" not in plan_of(mean)
    assert rows(mean.select("cell", "time", "value")) == rows(temporal.trailing_mean(a, 3, step="D").select("cell", "time", "value"))
    clim = stats.doy_climatology(left.withColumnRenamed("sp", "value"))
    assert "Exchange" not in plan_of(clim) and rows(clim) == rows(stats.doy_climatology(a))
    ranges = stats.clim_metas(left.withColumnRenamed("sp", "value"), "v")
    assert "Exchange" not in plan_of(ranges) and rows(ranges) == rows(stats.clim_metas(a, "v"))
