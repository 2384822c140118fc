"""Aggregate helpers: floor nearest-rank percentiles, exact log2 buckets, vector statistics."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def floor_percentiles(df: DataFrame, group_cols: list[str], value_col: str,
                      ps: dict[str, float], n_buckets: int = 64) -> DataFrame:
    """Per group, ``sorted(values)[int(p * (n - 1))]`` for each named p (exact).

    Differs from ``percentile`` (linear) and ``percentile_disc``.  Plan, built
    so that a group holding a large share of all rows is still split:

    1. per group, ``n_buckets - 1`` approximate quantile boundaries (a sketch
       aggregate with map-side partial aggregation);
    2. each value goes to the bucket ``#boundaries < value`` (monotone, equal
       values share a bucket), values are reduced to distinct
       ``(group, bucket, value, count)`` rows;
    3. per (group, bucket) counts give each bucket's offset (a tiny table);
    4. the running count runs inside ``(group, bucket)`` window partitions,
       and the answer is the first value whose offset + running count reaches
       the target rank.
    """
    g = list(group_cols)
    key = g if g else [F.lit(0).alias("__g")]
    part = g if g else ["__g"]
    base = df.select(*key, F.col(value_col).alias("__v")).filter(F.col("__v").isNotNull())
    qs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = base.groupBy(*part).agg(F.percentile_approx("__v", qs, 10000).alias("__b"))
    with_b = base.join(bounds, part).select(
        *part, "__v", F.size(F.filter("__b", lambda b: b < F.col("__v"))).alias("__k"))
    counts = with_b.groupBy(*part, "__k", "__v").agg(F.count(F.lit(1)).alias("__c"))
    per_bucket = counts.groupBy(*part, "__k").agg(F.sum("__c").alias("__bc"))
    w_off = Window.partitionBy(*part).orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*part, "__k", F.coalesce(F.sum("__bc").over(w_off), F.lit(0)).alias("__off"),
                                F.sum("__bc").over(Window.partitionBy(*part)).alias("__n"))
    w_run = Window.partitionBy(*part, "__k").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.join(offsets, part + ["__k"]).select(
        *part, "__v", (F.col("__off") + F.sum("__c").over(w_run)).alias("__cum"), "__n")
    aggs = [F.min(F.when(F.col("__cum") >= F.floor(F.lit(p) * (F.col("__n") - 1)) + 1,
                         F.col("__v"))).alias(name) for name, p in ps.items()]
    out = cum.groupBy(*part).agg(*aggs)
    return out.drop("__g") if not g else out


#: Values whose counts run in one window: those that share all but their last 11 bits.
_RUN_BITS = 11


def linear_percentiles(df: DataFrame, cols: dict[str, Column], ps: list[float]) -> DataFrame:
    """One row per ``name`` with a map ``p -> value``: exact percentiles with linear interpolation, like ``percentile``, of non-negative int columns.

    One scan counts the distinct values, spread by value; no task holds them all.
    Values that share all but their last 11 bits form a run: the runs' sums say how
    many values lie below each run (at most 2**20 rows for ints), and inside a run
    at most 2,048 rows are added up.  Nulls are left out; a column without values
    has no row.
    """
    each = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("int").alias("v")) for n, c in cols.items()])).alias("e")).select("e.*")
    run = F.shiftright("v", _RUN_BITS).alias("run")
    counts = each.filter(F.col("v").isNotNull()).groupBy("name", run, "v").agg(F.count(F.lit(1)).alias("c"))
    up_to = Window.partitionBy("name").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.groupBy("name", "run").agg(F.sum("c").alias("c")).select(
        F.col("name").alias("r_name"), F.col("run").alias("r_run"), F.coalesce(F.sum("c").over(up_to), F.lit(0)).alias("below"),
        F.sum("c").over(Window.partitionBy("name")).alias("n"))
    inside = Window.partitionBy("name", "run").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    found = counts.withColumn("up_to", F.sum("c").over(inside)).join(runs, (F.col("name") == F.col("r_name")) & (F.col("run") == F.col("r_run")))
    reached = F.col("below") + F.col("up_to")

    def at(rank: Column) -> Column:
        return F.min(F.when(reached > rank, F.col("v"))).cast("double")

    pos = [F.lit(float(p)) * (F.col("n") - 1) for p in ps]
    ranks = [c for i, x in enumerate(pos) for c in (at(F.floor(x)).alias(f"lo{i}"), at(F.ceil(x)).alias(f"hi{i}"))]
    one = found.groupBy("name", "n").agg(*ranks)
    value = [F.when(F.col(f"lo{i}") == F.col(f"hi{i}"), F.col(f"lo{i}")).otherwise(
        (F.ceil(x) - x) * F.col(f"lo{i}") + (x - F.floor(x)) * F.col(f"hi{i}")) for i, x in enumerate(pos)]
    return one.select("name", F.create_map(*[c for p, v in zip(ps, value) for c in (F.lit(float(p)), v)]).alias("percentiles"))


def floor_log2(x: Column) -> Column:
    """Exact ``floor(log2(x))`` for x > 0 (corrects the rounding of ln(x)/ln(2))."""
    b = F.floor(F.log2(x))
    b = F.when(F.pow(F.lit(2.0), b + 1) <= x, b + 1).otherwise(b)
    return F.when(F.pow(F.lit(2.0), b) > x, b - 1).otherwise(b)


def vector_stats(arr: Column) -> Column:
    """Mean, population std, min, max and zero fraction of a numeric array (two-pass)."""
    a = F.transform(arr, lambda x: x.cast("double"))
    n = F.size(a)
    mean = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / n
    var = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean)) / n
    zeros = F.size(F.filter(a, lambda x: x == 0.0))
    return F.when(n > 0, F.struct(
        mean.alias("mean"), F.sqrt(var).alias("std"), F.array_min(a).alias("min"),
        F.array_max(a).alias("max"), (zeros / n).alias("zero_fraction")))
