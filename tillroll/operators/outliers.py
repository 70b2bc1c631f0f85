"""Outlier bounds, counts, removal and histograms of the RFM measures."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import percent
from tillroll.functions.ordering import exact_quantiles
from tillroll.schema import MEASURES


def iqr_bounds(rfm: DataFrame, factor: float = 1.5) -> DataFrame:
    """Exact quartiles and the fences ``factor`` interquartile ranges outside them."""
    quartiles = (
        exact_quantiles(rfm, MEASURES, [0.25, 0.75])
        .groupBy("measure")
        .agg(
            F.max(F.when(F.col("probability") == 0.25, F.col("value"))).alias("q1"),
            F.max(F.when(F.col("probability") == 0.75, F.col("value"))).alias("q3"),
        )
    )
    reach = (F.col("q3") - F.col("q1")) * factor
    return quartiles.select(
        "measure", "q1", "q3", (F.col("q1") - reach).alias("lower_bound"), (F.col("q3") + reach).alias("upper_bound")
    )


def fences(rfm: DataFrame, factor: float = 1.5) -> dict[str, tuple[float, float]]:
    """The bounds as plain numbers, one row per measure; as literals they reach the scan."""
    return {r["measure"]: (r["lower_bound"], r["upper_bound"]) for r in iqr_bounds(rfm, factor).collect()}


def _outside(measure: str, fences: dict[str, tuple[float, float]]) -> Column:
    if measure not in fences:
        return F.lit(False)
    lower, upper = fences[measure]
    return (F.col(measure) < lower) | (F.col(measure) > upper)


def _any_outside(fences: dict[str, tuple[float, float]]) -> Column:
    hit = F.lit(False)
    for measure in MEASURES:
        hit = hit | _outside(measure, fences)
    return hit


def outlier_summary(rfm: DataFrame, factor: float = 1.5) -> DataFrame:
    """Rows outside the fences and their share, per measure and for ``any`` of them."""
    found = fences(rfm, factor)
    tests = {m: _outside(m, found) for m in MEASURES} | {"any": _any_outside(found)}
    counts = rfm.agg(
        F.count(F.lit(1)).alias("customers"), *[F.count_if(test).alias(name) for name, test in tests.items()]
    )
    return counts.unpivot("customers", list(tests), "measure", "outliers").select(
        "measure", "outliers", F.round(percent(F.col("outliers"), F.col("customers")), 1).alias("outlier_pct")
    )


def remove_outliers(rfm: DataFrame, factor: float = 1.5) -> DataFrame:
    """Rows within the fences of all measures, each (customer, country) row on its own."""
    return within(rfm, fences(rfm, factor))


def within(rfm: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows within given fences, for rows that come after those the fences were found on."""
    return rfm.filter(~_any_outside(bounds))


def trim_bounds(
    rfm: DataFrame, lower: float = 0.01, upper: float = 0.99, relative_error: float = 0.0
) -> dict[str, tuple[float, float]]:
    """Two quantiles per measure, each of the rows that the measures before it have left."""
    bounds: dict[str, tuple[float, float]] = {}
    for measure in MEASURES:
        left = within(rfm, bounds)
        if relative_error:
            found = left.approxQuantile(measure, [lower, upper], relative_error)
        else:
            found = sorted(row["value"] for row in exact_quantiles(left, [measure], [lower, upper]).collect())
        if found:
            bounds[measure] = (found[0], found[-1])
    return bounds


def trim_quantiles(
    rfm: DataFrame, lower: float = 0.01, upper: float = 0.99, relative_error: float = 0.0
) -> DataFrame:
    """Keep the rows between two quantiles, measure after measure on the rows left so far.

    A ``relative_error`` above 0 takes bounded-size sketches instead of exact quantiles.
    """
    return within(rfm, trim_bounds(rfm, lower, upper, relative_error))


def outlier_rows(rfm: DataFrame, factor: float = 1.5) -> DataFrame:
    """Rows outside the fences of any measure: what ``remove_outliers`` takes away."""
    return rfm.filter(_any_outside(fences(rfm, factor)))


def histogram(rfm: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width bins per measure over its whole range, empty ones included; the last is closed.

    A measure with a single value has no range; its range is taken as one unit around the value.
    """
    edges = rfm.agg(
        *[edge(m).cast("double").alias(f"{m}_{name}") for m in MEASURES for name, edge in (("low", F.min), ("high", F.max))]
    ).first()
    columns = []
    for m in MEASURES:
        low, high = edges[f"{m}_low"], edges[f"{m}_high"]
        if low == high and low is not None:
            low, high = low - 0.5, high + 0.5
        place = F.floor((F.col(m) - F.lit(low)) / (F.lit(high) - F.lit(low)) * bins)
        columns.append(F.least(place, F.lit(bins - 1)).cast("int").alias(m))
    counted = (
        rfm.select(*columns)
        .unpivot([], MEASURES, "measure", "bin")
        .groupBy("measure", "bin")
        .agg(F.count(F.lit(1)).alias("filled"))
    )
    # bins x 3 rows.
    grid = rfm.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), F.explode(F.array(*[F.lit(m) for m in MEASURES])).alias("measure")
    )
    return grid.join(counted, ["measure", "bin"], "left").select(
        "measure", "bin", F.coalesce("filled", F.lit(0)).alias("rows")
    )
