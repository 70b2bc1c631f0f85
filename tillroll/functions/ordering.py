"""Ranks, running totals and exact quantiles over a whole table.

A window without PARTITION BY moves every row into one task. Here the table is
range-partitioned and sorted on the key, and written out together with each
row's place: the number of its partition and its position in it. Totals per
partition, one small row each, give the offset at which a partition starts; a
rank is that offset and the position. Writing the table first freezes the
places, so that the offsets and the rows always agree, also after a lost
executor. Exact quantiles need no order at all: sketches and counts close in on
a rank until few values are left around it.
"""

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.sizing import partitions_for
from tillroll.scratch import materialize, materialize_bucketed

_SLOT, _POSITION = "_slot", "_position"
ROWS_PER_SLOT = 100_000
SKETCH_ERROR = 0.001
VALUES_AT_ONCE = 50_000  # that go to the driver for one rank


MOST_BUCKETS = 10_000


def _place(df: DataFrame, order: Sequence[Column], slots: int, label: str, bucketed: bool = False) -> DataFrame:
    """Rows with their slot and, from 0, their position in it; written in order.

    ``bucketed`` writes them as a table in buckets of slots: a window by slot
    then reads it as it lies.
    """
    placed = df.repartitionByRange(slots, *order).sortWithinPartitions(*order)
    # Numbers rows as they come: the partition in the upper bits, the position in the lower 33.
    place = placed.withColumn("_place", F.monotonically_increasing_id())
    split = {_SLOT: F.shiftright("_place", 33).cast("int"), _POSITION: F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))}
    if not bucketed:
        return materialize(place, label).withColumns(split).drop("_place")
    return materialize_bucketed(place.withColumns(split).drop("_place"), label, min(slots, MOST_BUCKETS), _SLOT)


def with_global_rank(
    df: DataFrame,
    order: Sequence[Column],
    totals: dict[str, Column] | None = None,
    rows_per_slot: int = ROWS_PER_SLOT,
) -> DataFrame:
    """Add ``rank`` (from 1) and ``row_total``; per total its ``_running`` and ``_total`` sums.

    ``order`` must end in a unique key: it makes the ranks definite, and it lets
    the range partitioning split runs of equal values. Each slot is ordered by a
    task of its own.
    """
    totals = totals or {}
    slots = partitions_for(df, rows_per_slot)
    placed = _place(df, order, slots, "ranked", bucketed=bool(totals))
    sizes = placed.groupBy(_SLOT).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_{n}") for n, c in totals.items()]
    )
    # One row per partition of the placed table, whatever its number of rows.
    before = Window.orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    names = ["rows", *totals]
    starts = sizes.select(
        F.col(_SLOT),
        *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in names],
        *[F.sum(f"_{n}").over(every).alias(f"_{n}_total") for n in names],
    )
    ranked = placed.join(F.broadcast(starts), _SLOT)
    rank = (F.col(_POSITION) + 1 + F.col("_rows_before")).alias("rank")
    if not totals:
        return ranked.select(*df.columns, rank, F.col("_rows_total").alias("row_total"))
    upto = Window.partitionBy(_SLOT).orderBy(_POSITION).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranked.select(
        *df.columns,
        rank,
        F.col("_rows_total").alias("row_total"),
        *[(F.sum(c).over(upto) + F.col(f"_{n}_before")).alias(f"{n}_running") for n, c in totals.items()],
        *[F.col(f"_{n}_total").alias(f"{n}_total") for n in totals],
    )


class _Open(NamedTuple):
    """Where a rank of a column is looked for: strictly between two values, None for no bound.

    ``before`` is the number of values up to ``low``, ``inside`` of those between.
    """

    column: str
    low: float | None
    high: float | None
    before: int
    inside: int

    def has(self) -> Column:
        value = F.col(self.column)
        found = value.isNotNull()
        if self.low is not None:
            found = found & (value > F.lit(self.low))
        if self.high is not None:
            found = found & (value < F.lit(self.high))
        return found


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    error: float = SKETCH_ERROR,
    values_at_once: int = VALUES_AT_ONCE,
) -> DataFrame:
    """Exact quantiles with linear interpolation: (measure, probability, value). Runs when called.

    A rank is first looked for among all values of its column. As long as there
    are more than ``values_at_once``, a sketch of those that are left proposes
    two values around the rank, and one pass counts what is below, at, between
    and above them: the rank is at one of the two, or some four times ``error``
    of the values are left. Each round is a sketch and a count for all ranks
    together; the values left at the end, ``values_at_once`` per rank at most,
    are fetched and sorted. Runs of one value, however long, are settled by
    their counts. Nulls and NaN do not count, and a column without values has no
    quantiles.
    """
    spark = df.sparkSession
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    sizes = numbers.agg(*[F.count(c).alias(c) for c in columns]).first()
    wanted = [(c, float(p), (sizes[c] - 1) * float(p)) for c in columns if sizes[c] for p in probabilities]
    ranks = {(c, whole) for c, _, place in wanted for whole in (math.floor(place), math.ceil(place))}
    waiting = {key: _Open(key[0], None, None, 0, sizes[key[0]]) for key in ranks}
    found: dict[tuple[str, int], float] = {}
    while waiting:
        few = {key: where for key, where in waiting.items() if where.inside <= values_at_once}
        found |= _fetched(numbers, few)
        narrowed = _narrowed(numbers, {key: where for key, where in waiting.items() if key not in few}, error)
        waiting = {}
        for key, result in narrowed.items():
            if isinstance(result, _Open):
                waiting[key] = result
            else:
                found[key] = result
    rows = []
    for c, p, place in wanted:
        low, high = found[c, math.floor(place)], found[c, math.ceil(place)]
        rows.append((c, p, low if low == high else low + (high - low) * (place % 1)))
    return spark.createDataFrame(rows, "measure string, probability double, value double")


def _fetched(numbers: DataFrame, few: dict[tuple[str, int], _Open]) -> dict[tuple[str, int], float]:
    """Values at ranks that have few values around them."""
    if not few:
        return {}
    places = list(dict.fromkeys(few.values()))
    values = numbers.agg(*[F.sort_array(F.collect_list(F.when(w.has(), F.col(w.column)))).alias(f"v{i}") for i, w in enumerate(places)])
    arrays = values.first()
    return {key: arrays[f"v{places.index(where)}"][key[1] - where.before] for key, where in few.items()}


def _narrowed(numbers: DataFrame, many: dict[tuple[str, int], _Open], error: float) -> dict[tuple[str, int], _Open | float]:
    """One round for all ranks: the value at the rank, or a narrower place for it."""
    if not many:
        return {}
    places = list(dict.fromkeys(many.values()))
    inside = numbers.select(*[F.when(w.has(), F.col(w.column)).alias(f"v{i}") for i, w in enumerate(places)])
    shares = sorted({_around(rank, w, error)[end] for (_, rank), w in many.items() for end in (0, 1)})
    sketched = inside.approxQuantile([f"v{i}" for i in range(len(places))], shares, error)
    proposed = {}
    for key, where in many.items():
        values = dict(zip(shares, sketched[places.index(where)]))
        proposed[key] = tuple(values[share] for share in _around(key[1], where, error))
    tests = {}
    for k, (key, where) in enumerate(many.items()):
        low, high = proposed[key]
        value, has = F.col(where.column), where.has()
        tests |= {
            f"below{k}": has & (value < low),
            f"low{k}": has & (value == low),
            f"between{k}": has & (value > low) & (value < high),
            f"high{k}": has & (value == high) & F.lit(high > low),
        }
    counts = numbers.agg(*[F.count_if(test).alias(name) for name, test in tests.items()]).first()
    results: dict[tuple[str, int], _Open | float] = {}
    for k, (key, where) in enumerate(many.items()):
        low, high = proposed[key]
        column, before, rank = where.column, where.before, key[1]
        steps = [
            (counts[f"below{k}"], where.low, low),
            (counts[f"low{k}"], low, None),
            (counts[f"between{k}"], low, high),
            (counts[f"high{k}"], high, None),
        ]
        for n, start, stop in steps:
            if rank < before + n:
                results[key] = start if stop is None else _Open(column, start, stop, before, n)
                break
            before += n
        else:
            results[key] = _Open(column, high, where.high, before, where.inside + where.before - before)
    return results


def _around(rank: int, where: _Open, error: float) -> tuple[float, float]:
    """Shares of the values inside between which a rank lies, whatever the error of a sketch."""
    share = (rank - where.before) / max(where.inside - 1, 1)
    return max(0.0, share - 2 * error), min(1.0, share + 2 * error)
