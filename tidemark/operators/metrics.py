"""Windowed metrics over event logs. Quantiles come from histogram buckets, whose counts add up over windows and tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Upper bounds of the duration histogram in seconds (fixed values).
DURATION_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0)


def window_rate(rows: DataFrame, ts: str, minutes: int, by: list[str], amount: Column | None = None) -> DataFrame:
    """Rows, or the sum of ``amount``, per second in tumbling windows; works on streams with a watermark too."""
    total = F.count("*") if amount is None else F.sum(amount)
    return rows.groupBy(F.window(ts, f"{minutes} minutes").alias("w"), *by).agg((total / (minutes * 60)).alias("rate")).select(F.col("w.start").alias("window_start"), *by, "rate")


def bucket_counts(rows: DataFrame, value: str, by: list[str], buckets: tuple[float, ...] = DURATION_BUCKETS) -> DataFrame:
    """``by`` and ``counts``: how many values are at most each of ``buckets``, and last how many there are. One row of fixed size for each group."""
    counts = [F.count_if(F.col(value) <= b) for b in buckets] + [F.count(value)]
    return rows.groupBy(*by).agg(F.array(*counts).alias("counts"))


def histogram_quantile(counts: Column, q: float, buckets: tuple[float, ...] = DURATION_BUCKETS) -> Column:
    """A quantile by linear interpolation inside the bucket that holds its rank; values beyond the last bound count as that bound."""
    def at(k: int) -> Column:
        low, high = (buckets[k - 1] if k else 0.0), buckets[k]
        before = F.get(counts, k - 1) if k else F.lit(0)
        return F.lit(low) + (high - low) * (rank - before) / (F.get(counts, k) - before)

    rank = F.get(counts, len(buckets)) * q
    found = F.when(F.get(counts, len(buckets)) == 0, F.lit(None).cast("double"))
    for k in range(len(buckets)):
        found = found.when(F.get(counts, k) >= rank, at(k))
    return found.otherwise(F.lit(buckets[-1]))


def window_quantiles(rows: DataFrame, ts: str, value: str, width: int, by: list[str], q: float, slide: int = 1) -> DataFrame:
    """A quantile in windows of ``width`` minutes that begin every ``slide`` minutes.

    Rows are counted in slides first; only these counts, of fixed size, go into the ``width / slide`` windows that overlap them.
    """
    one = bucket_counts(rows.withColumn("_at", F.window(ts, f"{slide} minutes")["start"]), value, ["_at", *by])
    starts = F.transform(F.sequence(F.lit(0), F.lit(width // slide - 1)), lambda k: F.col("_at") - F.make_dt_interval(mins=k * slide))
    many = one.select(F.explode(starts).alias("window_start"), *by, "counts").groupBy("window_start", *by).agg(
        F.array(*[F.sum(F.get("counts", i)) for i in range(len(DURATION_BUCKETS) + 1)]).alias("counts"))
    return many.select("window_start", *by, histogram_quantile(F.col("counts"), q).alias("quantile"))


def window_ratio(rows: DataFrame, ts: str, minutes: int, hit: Column, by: list[str] = ()) -> DataFrame:
    return rows.groupBy(F.window(ts, f"{minutes} minutes").alias("w"), *by).agg((F.count_if(hit) / F.count("*")).alias("ratio")).select(F.col("w.start").alias("window_start"), *by, "ratio")


def alert_hold(windows: DataFrame, by: list[str], firing: Column, hold: int, minutes: int) -> DataFrame:
    """Runs of consecutive firing windows that last ``hold`` windows or longer: start, end, windows."""
    w = Window.partitionBy(*by).orderBy("window_start")
    gap = F.make_dt_interval(mins=F.lit(minutes))
    on = windows.filter(firing).withColumn("_new", F.coalesce(F.lag("window_start").over(w) + gap != F.col("window_start"), F.lit(True)).cast("int"))
    runs = on.withColumn("_run", F.sum("_new").over(w)).groupBy(*by, "_run").agg(
        F.min("window_start").alias("since"), F.max("window_start").alias("until"), F.count("*").alias("windows"))
    return runs.filter(F.col("windows") >= hold).drop("_run")


def duration_histogram(rows: DataFrame, value: str, by: list[str], buckets: tuple[float, ...] = DURATION_BUCKETS) -> DataFrame:
    """Cumulative counts for each upper bound, the last one unbounded (null); one pass."""
    le = F.array(*[F.lit(b) for b in buckets], F.lit(None).cast("double"))
    return bucket_counts(rows, value, by, buckets).select(*by, F.explode(F.arrays_zip(le.alias("le"), F.col("counts").alias("n"))).alias("x")).select(*by, "x.le", "x.n")


def zero_fill(series: DataFrame, labels: DataFrame, key: str, value: str, minutes: int) -> DataFrame:
    """The series for every label of ``labels`` and every window between the first and the last, 0 where there is none.

    First and last window are two values that reach the driver; each label then makes its windows by itself.
    """
    a, b = series.agg(F.min("window_start"), F.max("window_start")).first()
    if a is None:
        return series
    windows = F.sequence(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz"), F.make_dt_interval(mins=F.lit(minutes)))
    grid = labels.select(key).distinct().withColumn("window_start", F.explode(windows))
    return grid.join(series, ["window_start", key], "left").select("window_start", key, F.coalesce(value, F.lit(0)).alias(value))
