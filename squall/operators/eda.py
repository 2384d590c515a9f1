"""Profiles and plot data: everything a chart needs, already aggregated."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.operators.columns import quoted
from squall.operators.quantiles import quantile_stats
from squall.operators.stats import STATS, attach, column_stats, figure, struct, unstacked
from squall.storage import materialise

KDE_POINTS = 200
REPEATED = 4  # times a value must occur on average to be counted first
WHISKER = 1.5


def profile(df: DataFrame, cols: Sequence[str], **options) -> DataFrame:
    """One row per column: type, counts, moments and quartiles."""
    figures = {
        "nulls": "count_if({x} is null)", "mean": "avg({x})", "std": "stddev_samp({x})",
    }
    quartiles = quantile_stats(df, cols, [0.25, 0.5, 0.75], **options)
    both = column_stats(df, cols, figures).withColumn("__q", quartiles.scalar())

    def row(c: str) -> str:
        q = f"__q.{quoted(c)}"
        return struct(
            {
                "column": f"'{c}'",
                "type": f"'{df.schema[c].dataType.simpleString()}'",
                "count": f"coalesce({q}.n, 0L)",
                "nulls": figure(c, "nulls"),
                "mean": figure(c, "mean"),
                "std": figure(c, "std"),
                "min": f"{q}.min",
                "q1": f"{q}.q[0]",
                "median": f"{q}.q[1]",
                "q3": f"{q}.q[2]",
                "max": f"{q}.max",
            }
        )

    return both.selectExpr(unstacked([row(c) for c in cols]))


def null_profile(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Number of missing cells over all `cols`."""
    return df.groupBy(*keys).agg(F.sum(null_cells(cols)).alias("null_cells"))


def null_cells(cols: Sequence[str]) -> Column:
    """Number of nulls in a row."""
    return F.expr(" + ".join(f"int({quoted(c)} is null)" for c in cols) or "0")


def correlation_matrix(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Pearson correlation `(col_a, col_b, corr)` over the rows where both are present.

    A constant column has no correlation: null. One pass: every row is expanded inside the generated code to
    its pairs of a column with itself and those after it, and these are combined map-side at once, so that one short
    aggregate serves any number of columns and only one row per pair and task is shuffled. (An aggregate with an
    expression per pair outgrows compilation; batches of such aggregates take three times as long at 50 columns.)
    """
    values = ", ".join(f"double({quoted(c)})" for c in cols)
    by = [*map(quoted, keys), "__i", "__j"]
    pairs = (
        df.selectExpr(*map(quoted, keys), f"array({values}) as __v")
        .selectExpr("*", "posexplode(__v) as (__i, __x)")
        .selectExpr(
            *map(quoted, keys), "__i", "__x",
            f"posexplode(slice(__v, __i + 1, {max(1, len(cols))})) as (__step, __y)",
        )
        .selectExpr(*map(quoted, keys), "__i", "__i + __step as __j", "__x", "__y")
    )
    x, y = "case when __y is not null then __x end", "case when __x is not null then __y end"
    corr = f"try_divide(covar_pop(__x, __y), sqrt(var_pop({x})) * sqrt(var_pop({y})))"
    upper = pairs.groupBy(*keys, "__i", "__j").agg(F.expr(corr).alias("corr"))
    names = ", ".join(f"'{c}'" for c in cols)
    cell = "named_struct('col_a', __names[{0}], 'col_b', __names[{1}])"
    both = f"array({cell.format('__i', '__j')}, {cell.format('__j', '__i')})"
    return upper.selectExpr(*by, "corr", f"array({names}) as __names").selectExpr(
        *map(quoted, keys), f"inline(slice({both}, 1, if(__i = __j, 1, 2)))", "corr"
    )


def histogram(df: DataFrame, col: str, **options) -> DataFrame:
    """`(bin, left, right, count)` with the bin width chosen from the data.

    The narrower of the Freedman-Diaconis and Sturges widths; the largest value belongs to the
    last bin and empty bins are listed.
    """
    shape = _bin_shape(df, col, **options)
    counts = (
        df.filter(F.col(col).isNotNull())
        .select(F.col(col).cast("double").alias("x"), shape.alias("s"))
        .select(_bin_of(F.col("x"), F.col("s.lo"), F.col("s.hi"), F.col("s.bins")).alias("bin"))
        .groupBy("bin")
        .count()
    )
    bins = (
        df.sparkSession.range(1)
        .select(shape.alias("s"))
        .filter("s.n > 0")
        .select("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("s.bins") - 1)).alias("bin"))
    )
    edge = lambda i: F.col("s.lo") + (F.col("s.hi") - F.col("s.lo")) * i / F.col("s.bins")
    return bins.join(counts, "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("left"),
        edge(F.col("bin") + 1).alias("right"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def _bin_shape(df: DataFrame, col: str, **options) -> Column:
    """Struct `n, lo, hi, bins` of a histogram, as a scalar subquery."""
    cell = F.col(STATS)[col]
    stats = quantile_stats(df, [col], [0.25, 0.75], **options).select(
        cell["n"].alias("n"), cell["min"].alias("lo"), cell["max"].alias("hi"),
        (cell["q"][1] - cell["q"][0]).alias("iqr"),
    )
    spread = F.col("hi") - F.col("lo")
    sturges = spread / (F.log2("n") + 1)
    diaconis = 2 * F.col("iqr") / F.cbrt("n")
    width = F.when(diaconis > 0, F.least(diaconis, sturges)).otherwise(sturges)
    bins = F.when(spread > 0, F.ceil(F.try_divide(spread, width))).otherwise(F.lit(1))
    pad = F.when(spread > 0, F.lit(0.0)).otherwise(F.lit(0.5))
    shape = F.struct(
        "n", (F.col("lo") - pad).alias("lo"), (F.col("hi") + pad).alias("hi"), bins.alias("bins")
    )
    return materialise(stats.select(shape.alias("shape")), "bin-shape").scalar()


def _bin_of(x: Column, lo: Column, hi: Column, bins: Column) -> Column:
    return F.least(F.floor(F.try_divide(x - lo, hi - lo) * bins), bins - 1)


def kde(
    df: DataFrame, col: str, points: int = KDE_POINTS, cells: int | None = None
) -> DataFrame:
    """Gaussian kernel density `(point, x, density)` between the extremes, Scott bandwidth.

    Every value adds to each of the fixed number of points, combined map-side, so rows are never shuffled by
    value. Only where values repeat often are equal ones counted first, which is less work. `cells` moves values
    to the centres of that many equal cells before: an approximation that needs few exponentials.
    """
    x = F.col(col).cast("double")
    figures = {
        "n": "count({x})", "lo": "min({x})", "hi": "max({x})", "std": "stddev_samp({x})",
        "distinct": "approx_count_distinct({x})",
    }
    stats = column_stats(df.select(x.alias(col)), [col], figures)
    shape = materialise(stats.select(F.col(STATS)[col].alias("s")).filter("s.std > 0"), "kde-shape")
    s = shape.scalar()
    values = df.filter(x.isNotNull()).select(x.alias("v"))
    found = shape.select("s.n", "s.distinct").first()
    repeated = cells is not None or found is None or found.n >= REPEATED * found.distinct
    if cells is not None:
        width = (s["hi"] - s["lo"]) / cells
        cell = _bin_of(F.col("v"), s["lo"], s["hi"], F.lit(cells))
        values = values.select((s["lo"] + (cell + 0.5) * width).alias("v"))
    bandwidth = F.col("s.std") * F.pow(F.col("s.n"), F.lit(-0.2))
    at = F.col("s.lo") + (F.col("s.hi") - F.col("s.lo")) * F.col("point") / (points - 1)
    z = (F.col("x") - F.col("v")) / F.col("h")
    kernel = F.exp(-z * z / 2) / (F.col("h") * F.sqrt(2 * F.pi()))
    counted = values.groupBy("v").agg(F.count(F.lit(1)).alias("m")) if repeated else values.withColumn("m", F.lit(1))
    return (
        counted.withColumn("s", s)
        .filter("s is not null")
        .select("v", "m", "s", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
        .select("v", "m", "point", at.alias("x"), bandwidth.alias("h"), F.col("s.n").alias("n"))
        .groupBy("point", "x", "n")
        .agg(F.sum(F.col("m") * kernel).alias("total"))
        .select("point", "x", (F.col("total") / F.col("n")).alias("density"))
    )


def boxplot(df: DataFrame, by: str, col: str, **options) -> DataFrame:
    """Quartiles, whiskers (extremes within 1.5 IQR) and number of outliers per group."""
    rows = df.filter(F.col(by).isNotNull() & F.col(col).isNotNull()).select(by, col)
    joined = attach(rows, quantile_stats(rows, [col], [0.25, 0.5, 0.75], [by], **options), [by])
    q = F.col(STATS)[col]["q"]
    reach = WHISKER * (q[2] - q[0])
    inside = F.col(col).between(q[0] - reach, q[2] + reach)
    return (
        joined.groupBy(by)
        .agg(
            F.count(col).alias("n"),
            F.first(q).alias("q"),
            F.min(F.when(inside, F.col(col))).alias("low"),
            F.max(F.when(inside, F.col(col))).alias("high"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(
            by,
            "n",
            F.least("low", F.col("q")[0]).alias("whisker_low"),
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
            F.greatest("high", F.col("q")[2]).alias("whisker_high"),
            "outliers",
        )
    )


def scatter_cells(df: DataFrame, actual: str, predicted: str, cells: int = 50) -> DataFrame:
    """Actual against predicted as counts on a `cells` × `cells` raster over their common range."""
    rows = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    lo = F.least(F.min(actual), F.min(predicted)).cast("double")
    hi = F.greatest(F.max(actual), F.max(predicted)).cast("double")
    extent = rows.agg(F.struct(lo.alias("lo"), hi.alias("hi")).alias("e")).scalar()
    e_lo, e_hi = F.col("e.lo"), F.col("e.hi")

    def cell(c: str) -> Column:
        return F.coalesce(_bin_of(F.col(c).cast("double"), e_lo, e_hi, F.lit(cells)), F.lit(0))

    return (
        rows.select(actual, predicted, extent.alias("e"))
        .groupBy(cell(actual).alias("actual_bin"), cell(predicted).alias("predicted_bin"), "e")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "actual_bin",
            "predicted_bin",
            (e_lo + (e_hi - e_lo) * (F.col("actual_bin") + 0.5) / cells).alias("actual_mid"),
            (e_lo + (e_hi - e_lo) * (F.col("predicted_bin") + 0.5) / cells).alias("predicted_mid"),
            "n",
        )
    )
