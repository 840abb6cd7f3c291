"""Statistics per group that are joined back or listed long.

Groups are reduced by partial aggregation. Percentiles are found by selection: a sketch brackets
each rank, and only what lies strictly inside a bracket is looked at value by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.session import materialize


def with_group_stats(df: DataFrame, keys: Sequence[str], **stats: Column) -> DataFrame:
    """Aggregates of each group on its rows. Spark broadcasts the small side if its size
    allows, and splits skewed keys otherwise."""
    table = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return df.join(table, list(keys), "left")


#: accuracy of the sketch that brackets a rank, and the reach of brackets in shares of a group's rows: of
#: groups up to 200 rows all rows, of groups the sketch holds whole ``NEAR``, of larger ones ``NARROW``
SKETCH = 10000
WHOLE, NEAR, NARROW = 200, 0.01, 5 / SKETCH


def percentiles(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], points: dict[str, float], stored: bool = False
) -> DataFrame:
    """Exact percentiles with linear interpolation: ``(keys, column, n, mean, std, min, max)`` and a column for each point.

    By selection, without sorting or holding a group. A sketch of each column brackets the wanted ranks. In a second
    pass rows are counted below, at and above the two ends of a bracket, added up in each task, and only the few
    values strictly inside one (a fixed share of the rows at most, however often values repeat) are counted one
    by one and ranked. Where the counts show a rank outside its bracket, the query fails instead of returning a
    wrong value. A column without values has NULL percentiles. ``df`` is read three times: it is written to the
    shared folder first unless it is ``stored`` already.
    """
    base = df.select(F.struct(*keys or [F.lit(0)]).alias("_key"), F.array(*[F.col(c).cast("double") for c in columns]).alias("_row"))
    if not stored:
        base = materialize(base, "percentiles")
    reach = [x for q in points.values() for d in (NEAR, NARROW) for x in (max(0.0, q - d), min(1.0, q + d))]
    at = F.array(*[F.lit(x) for x in (0.0, 1.0, *reach)])
    sketched = base.groupBy("_key").agg(
        F.array(*[F.count(F.col("_row")[i]) for i in range(len(columns))]).alias("n"),
        F.array(*[F.percentile_approx(F.col("_row")[i], at, F.lit(SKETCH)) for i in range(len(columns))]).alias("at"),
    )

    def ends(cell: Column, side: int) -> Column:
        """The lower (0) or upper (1) end of each point's bracket."""
        return F.array(*[
            F.when(cell["n"] <= WHOLE, cell["at"][side])
            .when(cell["n"] <= SKETCH, cell["at"][2 + 4 * j + side])
            .otherwise(cell["at"][4 + 4 * j + side])
            for j in range(len(points))
        ])

    zipped = F.arrays_zip("n", "at")
    cuts = sketched.select(
        "_key", F.transform(zipped, lambda x: F.struct(x["n"].alias("n"), ends(x, 0).alias("lo"), ends(x, 1).alias("hi"))).alias("_cut")
    )
    rows = base.join(cuts, "_key").select("_key", F.posexplode(F.arrays_zip("_row", "_cut")).alias("_c", "_cell"))
    rows = rows.select("_key", "_c", F.col("_cell._row").alias("v"), F.col("_cell._cut.lo").alias("lo"), F.col("_cell._cut.hi").alias("hi")).where("v IS NOT NULL")
    v, over = F.col("v"), range(len(points))
    tests = {
        "below": lambda j: v < F.col("lo")[j], "to_lo": lambda j: v <= F.col("lo")[j],
        "to_hi": lambda j: v < F.col("hi")[j], "upto": lambda j: v <= F.col("hi")[j],
    }
    counts = rows.groupBy("_key", "_c").agg(
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
        *[F.array(*[F.count_if(test(j)) for j in over]).alias(t) for t, test in tests.items()],
    )
    kept = F.array(*[F.when((v > F.col("lo")[j]) & (v < F.col("hi")[j]), F.lit(j)) for j in over])
    inside = rows.select("_key", "_c", "v", F.explode(F.filter(kept, lambda j: j.isNotNull())).alias("point"))
    inside = inside.groupBy("_key", "_c", "point", "v").agg(F.count(F.lit(1)).alias("times"))
    along = Window.partitionBy("_key", "_c", "point").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.select("*", F.sum("times").over(along).alias("upto_v"))

    known = cuts.select("_key", F.posexplode("_cut").alias("_c", "_cell")).select("_key", "_c", "_cell.*").join(counts, ["_key", "_c"], "left")
    asked = known.where("n > 0").select(
        "_key", "_c", "n",
        F.inline(F.array(*[
            F.struct(F.lit(j).alias("point"), F.lit(float(q)).alias("q"), *[F.col(c)[j].alias(c) for c in ("lo", "hi", *tests)])
            for j, q in enumerate(points.values())
        ])),
    ).withColumn("at", (F.col("n") - 1) * F.col("q"))
    ranks = {"first": F.floor("at"), "second": F.ceil("at")}
    by = ["_key", "_c", "point"]
    met = asked.select(*by, *[(r - F.col("to_lo")).alias(name) for name, r in ranks.items()]).join(ranked, by)
    picked = met.groupBy(*by).agg(
        *[F.max(F.when((F.col(r) >= F.col("upto_v") - F.col("times")) & (F.col(r) < F.col("upto_v")), v)).alias(f"in_{r}") for r in ranks]
    )

    def value(name: str) -> Column:
        r = ranks[name]
        return (
            F.when((r < F.col("below")) | (r >= F.col("upto")), F.raise_error(F.lit("a rank lies outside its bracket")).cast("double"))
            .when(r < F.col("to_lo"), F.col("lo"))
            .when(r >= F.col("to_hi"), F.col("hi"))
            .otherwise(F.col(f"in_{name}"))
        )

    a, b, part = value("first"), value("second"), F.col("at") - F.floor("at")
    found = asked.join(picked, by, "left").select(*by, F.when(a == b, a).otherwise(a * (1 - part) + b * part).alias("value"))
    flat = found.groupBy("_key", "_c").agg(*[F.max(F.when(F.col("point") == j, F.col("value"))).alias(name) for j, name in enumerate(points)])
    names = F.array(*[F.lit(c) for c in columns])
    return known.join(flat, ["_key", "_c"], "left").select(
        *[F.col("_key")[k].alias(k) for k in keys], F.get(names, "_c").alias("column"), "n", "mean", "std", "min", "max", *points
    )


def quantiles(
    df: DataFrame, keys: Sequence[str], column: str, points: dict[str, float]
) -> DataFrame:
    """Exact percentiles of one column with linear interpolation, one column per point. Groups without a value
    are left out."""
    return percentiles(df, keys, [column], points).where("n > 0").select(*keys, *points)


def approximate_quantiles(
    df: DataFrame, keys: Sequence[str], column: str, points: dict[str, float], accuracy: int = 10000
) -> DataFrame:
    """Sketch-based percentiles for groups with very many distinct values."""
    names = list(points)
    at = F.array(*[F.lit(float(points[n])) for n in names])
    return (
        df.groupBy(*keys)
        .agg(F.percentile_approx(column, at, F.lit(accuracy)).alias("_q"))
        .select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    )


def pearson(x: str, y: str) -> Column:
    """Correlation over the rows where both are known; NULL if either is constant there."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x).cast("double")), F.when(both, F.col(y).cast("double"))
    # extremes tell a constant column from one whose deviation is only rounding
    varies = (F.max(a) > F.min(a)) & (F.max(b) > F.min(b))
    return F.when(varies, F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def zscore(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Sample z-score per group; a flat or single-row group gives 0."""
    out = with_group_stats(df, keys, _mean=F.avg(column), _std=F.stddev_samp(column))
    z = F.when(F.col("_std") > 0, (F.col(column) - F.col("_mean")) / F.col("_std")).otherwise(0.0)
    return out.withColumn(name, z).drop("_mean", "_std")


def minmax(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Rescale to 0..100 per group; a flat group gives 50."""
    out = with_group_stats(df, keys, _lo=F.min(column), _hi=F.max(column))
    scaled = F.when(F.col("_hi") == F.col("_lo"), 50.0).otherwise(
        (F.col(column) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * 100.0
    )
    return out.withColumn(name, scaled).drop("_lo", "_hi")


def standardize(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Population scaling of several columns, one pass for all means and deviations."""
    stats: dict[str, Column] = {}
    for c in columns:
        stats[f"_m_{c}"] = F.avg(c)
        stats[f"_s_{c}"] = F.stddev_pop(c)
    out = with_group_stats(df, keys, **stats)
    scaled = {
        f"{c}_scaled": F.when(
            F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")
        ).otherwise(0.0)
        for c in columns
    }
    restored = {
        f"{c}_restored": F.col(f"{c}_scaled")
        * F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(1.0)
        + F.col(f"_m_{c}")
        for c in columns
    }
    return out.withColumns(scaled).withColumns(restored).drop(*stats)


def median_fill(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """NULLs of each column replaced by the median of the group. ``df`` is read several times."""
    medians = percentiles(df, keys, columns, {"mid": 0.5}, stored=True)
    wide = medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("column") == c, F.col("mid"))).alias(f"_mid_{c}") for c in columns]
    )
    out = df.join(wide, list(keys), "left")
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_mid_{c}")) for c in columns}
    return out.withColumns(filled).drop(*[f"_mid_{c}" for c in columns])


def describe(df: DataFrame, keys: Sequence[str], columns: Sequence[str], points: dict[str, float], stored: bool = False) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact percentiles, one row per column."""
    return percentiles(df, keys, columns, points, stored).select(*keys, "column", "n", "mean", "std", "min", "max", *points)
