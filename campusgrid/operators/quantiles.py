"""Exact quantiles and modes that never hold a whole column in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_column

_BINS = 512


def _ranks(n: int, q: float) -> tuple[int, int, float]:
    """0-based ranks around quantile q, and the weight of the upper one."""
    place = q * (n - 1)
    low = math.floor(place)
    return low, min(low + 1, n - 1), place - low


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], quantiles: Sequence[float]
) -> dict[str, list[float | None]]:
    """Exact, linearly interpolated quantiles of several columns.

    Keeps, for every wanted rank, an interval of values known to hold it. Each round is
    one job that counts rows per histogram bin inside the open intervals of all columns;
    the bin with the rank becomes the next interval. Only bin counts (a fixed number per
    interval) reach the driver, and a sketch gives the first interval, so a few rounds do
    for any table size. Nulls and NaN are skipped."""
    spark = df.sparkSession
    finite = df.select(
        *[
            F.when(~F.isnan(as_column(c).cast("double")), as_column(c).cast("double")).alias(f"x{i}")
            for i, c in enumerate(cols)
        ]
    )
    infinity = F.lit(float("inf"))
    first = []
    for i in range(len(cols)):
        x = F.col(f"x{i}")
        inner = F.when(F.abs(x) < infinity, x)
        first.append(
            F.struct(
                F.count(x).alias("n"),
                F.count_if(x == -infinity).alias("below"),
                F.count_if(x == infinity).alias("above"),
                F.min(inner).alias("low"),
                F.max(inner).alias("high"),
                F.percentile_approx(inner, [min(max(q + d, 0.0), 1.0) for q in quantiles for d in (-0.01, 0.01)], 1000).alias("near"),
            ).alias(f"x{i}")
        )
    start = finite.agg(*first).first()

    known: dict[tuple[int, int], float] = {}
    pending: dict[tuple[int, int], tuple[float, float, int]] = {}
    for i in range(len(cols)):
        s = start[f"x{i}"]
        for q in quantiles:
            for rank in set(_ranks(s.n, q)[:2]) if s.n else ():
                if rank < s.below:
                    known[i, rank] = -math.inf
                elif rank >= s.n - s.above:
                    known[i, rank] = math.inf
                else:
                    pending[i, rank] = (s.low, s.high, s.below)

    # Bracket by the sketch. The brackets are guesses: rows on either side are counted in
    # the first round, and a rank that proves to be outside restarts from the full range.
    guesses = {}
    for i in range(len(cols)):
        near = start[f"x{i}"].near
        for j, q in enumerate(quantiles):
            for rank in set(_ranks(start[f"x{i}"].n, q)[:2]) if near else ():
                if (i, rank) in pending:
                    guesses[i, rank] = (near[2 * j], near[2 * j + 1])

    while pending:
        for (i, r), (low, high, _) in list(pending.items()):
            if low == high:
                known[i, r] = low
                del pending[i, r]
        if not pending:
            break
        intervals = sorted({(i, *(guesses.get((i, r)) or span[:2])) for (i, r), span in pending.items()})
        counted = _count_bins(finite, intervals)
        for (i, r), (low, high, below) in list(pending.items()):
            guess = guesses.pop((i, r), None)
            low, high = guess or (low, high)
            bins = counted[intervals.index((i, low, high))]
            if guess:
                below = start[f"x{i}"].below + bins["under"]
            seen = below
            for count, bin_low, bin_high in bins["bins"]:
                if seen <= r < seen + count:
                    pending[i, r] = (bin_low, bin_high, seen)
                    break
                seen += count
            # otherwise the guess missed: the full range stays pending

    answer = {}
    for i, c in enumerate(cols):
        n = start[f"x{i}"].n
        values = []
        for q in quantiles:
            if not n:
                values.append(None)
                continue
            low, high, weight = _ranks(n, q)
            a, b = known[i, low], known[i, high]
            values.append(a if weight == 0 or a == b else a + (b - a) * weight)
        answer[c] = values
    return answer


def _count_bins(finite: DataFrame, intervals: Sequence[tuple[int, float, float]]) -> list[dict]:
    """Rows, smallest and largest value per bin of each interval, and rows under the interval."""
    hits = []
    for number, (i, low, high) in enumerate(intervals):
        width = high / _BINS - low / _BINS
        if width > 0:
            place = f"least(floor((x{i} / {_BINS} - {low / _BINS!r}D) / {width!r}D * {_BINS}), {_BINS - 1})"
        else:
            place = f"if(x{i} <= {low!r}D, 0, 1)"
        hits.append(
            f"case when abs(x{i}) = double('infinity') or x{i} > {high!r}D then null "
            f"when x{i} < {low!r}D then named_struct('interval', {number}, 'bin', -1, 'x', x{i}) "
            f"when x{i} >= {low!r}D then named_struct('interval', {number}, 'bin', cast(greatest({place}, 0) as int), 'x', x{i}) end"
        )
    rows = (
        finite.select(F.explode(F.expr(f"array({', '.join(hits)})")).alias("h"))
        .where("h is not null")
        .groupBy("h.interval", "h.bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("h.x").alias("low"), F.max("h.x").alias("high"))
        .collect()
    )
    result = [{"under": 0, "bins": []} for _ in intervals]
    for row in sorted(rows, key=lambda r: (r.interval, r.bin)):
        if row.bin < 0:
            result[row.interval]["under"] = row.n
        else:
            result[row.interval]["bins"].append((row.n, row.low, row.high))
    return result


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """Most frequent non-null value per column, smallest first among equals.

    Counts (column, value) pairs with partial aggregation and reduces those counts per
    column, so no task builds a map of all values."""
    long = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(i).alias("i"), as_column(c).cast("string").alias("v")) for i, c in enumerate(cols)])
        )
    )
    best = (
        long.where("v is not null")
        .groupBy("i", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("i")
        .agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v"))
        .collect()
    )
    found = {row.i: row.v for row in best}
    return {c: found.get(i) for i, c in enumerate(cols)}
