"""K-means with many starts in shared passes, nearest-centre labels, elbow and profile.

A fit reads the rows a bounded number of times, however many numbers of clusters and starts are asked for:

* rows far from each other are drawn in a few rounds, from all rows, with odds by squared distance to those drawn before;
* one pass sums up the rows around each drawn row, so a few hundred weighted points stand for all rows;
* every start of every k settles on these points on the driver, with swaps of centres until none helps;
* the best few settle on all rows together, and a last pass tries, for all of them at once, whether any centre would be
  better placed at a far row; what a swap would save follows exactly from each row's nearest and second-nearest centre."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_column
from ..session import keep, ship_package
from .aggregate import group_means

#: Rows drawn at first and in each later round, and rounds: what stands for all rows has at most their sum of points.
_FIRST, _MORE, _ROUNDS = 64, 256, 2
#: Draws of every start on these points, settled runs of each k that go on to all rows, and far points tried in place
#: of a centre.
_DRAWS, _FINALISTS, _TRIED = 4, 2, 12
#: Rows whose distances to all centres are held at a time.
_CHUNK = 4096


@dataclass(frozen=True)
class KMeansFit:
    k: int
    columns: tuple[str, ...]
    centers: tuple[tuple[float, ...], ...]
    inertia: float


def _uniform(place: np.ndarray, turn: int) -> np.ndarray:
    """A number in (0, 1] per row, from its hash: the same however the rows are spread."""
    x = place.view(np.uint64) + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53 + 2.0**-54


def _gaps(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres."""
    gaps = x @ (-2.0 * centers.T)
    gaps += (x * x).sum(axis=1)[:, None] + (centers * centers).sum(axis=1)
    return np.maximum(gaps, 0.0, out=gaps)


@dataclass(frozen=True)
class _Points:
    """Cached rows (``x`` an array, ``_place`` a hash), moved so that their mean is zero."""

    frame: DataFrame
    dims: int
    n: int
    mean: np.ndarray
    spread: float

    @property
    def matrices(self):
        """A function from a task's batches to matrices of rows, with their hashes."""
        dims, mean = self.dims, self.mean

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                place = batch.column("_place").to_numpy(zero_copy_only=False)
                for at in range(0, len(x), _CHUNK):
                    yield x[at : at + _CHUNK] - mean, place[at : at + _CHUNK]

        return read

    def first(self) -> np.ndarray:
        """The rows with the smallest hashes."""
        found = self.frame.orderBy("_place").limit(_FIRST).select("x").toArrow()["x"].to_pylist()
        return np.unique(np.array(found, dtype=float).reshape(-1, self.dims) - self.mean, axis=0)

    def far(self, chosen: np.ndarray, turn: int) -> np.ndarray:
        """Rows drawn from all rows, without replacement, with odds by squared distance to the chosen ones.

        A row's waiting time is exponential with that rate; the shortest ones are the draw. A task sends its shortest
        only, and these are thinned out in every partition they are dealt to before they meet."""
        matrices, dims = self.matrices, self.dims

        def shortest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best, rows = np.zeros(0), np.zeros((0, dims))
            for x, place in matrices(batches):
                rate = _gaps(x, chosen).min(axis=1)
                rate = np.where(rate > 1e-12 * (1.0 + (x * x).sum(axis=1)), rate, 0.0)
                with np.errstate(divide="ignore"):
                    wait = -np.log(_uniform(place, turn)) / rate
                some = np.isfinite(wait)
                best, rows = np.concatenate([best, wait[some]]), np.concatenate([rows, x[some]])
                if len(best) > _MORE:
                    few = np.argpartition(best, _MORE)[:_MORE]
                    best, rows = best[few], rows[few]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.reshape(-1)), dims).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(best), lists], names=["wait", "x"])

        drawn = self.frame.mapInArrow(shortest, "wait double, x array<double>").repartition("wait")
        found = drawn.orderBy("wait", "x").limit(_MORE).select("x").toArrow()["x"].to_pylist()
        return np.array(found, dtype=float).reshape(-1, dims)

    def sums(self, runs: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """One pass for all runs: per centre the number of its rows, their coordinate sums and squared distances. A task
        sends one row per centre."""
        matrices, dims = self.matrices, self.dims
        order = list(runs)
        edges = np.cumsum([0, *[len(runs[r]) for r in order]])
        centers = np.concatenate([runs[r] for r in order])
        names = [f"p{i}" for i in range(dims + 2)]

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(centers), dims + 2))
            for x, _ in matrices(batches):
                gaps = _gaps(x, centers)
                for a, b in zip(edges[:-1], edges[1:]):
                    near = gaps[:, a:b].argmin(axis=1)
                    by = np.argsort(near, kind="stable")
                    own, at = np.unique(near[by], return_index=True)
                    rows = np.column_stack([np.ones(len(x)), x, gaps[np.arange(len(x)), a + near]])
                    total[a + own] += np.add.reduceat(rows[by], at)
            columns = [pa.array(np.arange(len(total))), *[pa.array(np.ascontiguousarray(c)) for c in total.T]]
            yield pa.RecordBatch.from_arrays(columns, names=["center", *names])

        parts = self.frame.mapInArrow(partial, ", ".join(["center bigint", *[f"{p} double" for p in names]]))
        table = parts.groupBy("center").agg(*[F.sum(p).alias(p) for p in names]).toArrow().to_pandas()
        table = table.sort_values("center")[names].to_numpy()
        return {r: table[a:b] for r, a, b in zip(order, edges[:-1], edges[1:])}

    def swaps(self, runs: dict[int, np.ndarray], tried: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        """Per run its cost, and the cost after every swap of a centre for one of the tried rows: one pass."""
        matrices = self.matrices
        order = list(runs)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = {r: _swap_sums(np.zeros((0, len(runs[r][0]))), np.zeros(0), runs[r], tried[r]) for r in order}
            for x, _ in matrices(batches):
                for r in order:
                    totals[r] = totals[r] + _swap_sums(x, np.ones(len(x)), runs[r], tried[r])
            flat = np.concatenate([totals[r].reshape(-1) for r in order])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["spot", "v"])

        parts = self.frame.mapInArrow(partial, "spot bigint, v double")
        table = parts.groupBy("spot").agg(F.sum("v").alias("v")).toArrow().to_pandas().sort_values("spot")["v"].to_numpy()
        out, at = {}, 0
        for r in order:
            shape = (len(tried[r]) + 1, len(runs[r]) + 1)
            part = table[at : at + shape[0] * shape[1]].reshape(shape)
            at += part.size
            out[r] = float(part[0, 0]), part[1:, :1] + part[1:, 1:]
        return out


def _swap_sums(x: np.ndarray, weight: np.ndarray, centers: np.ndarray, tried: np.ndarray) -> np.ndarray:
    """First line: the cost. Then a line per tried row: the cost with this row as one more centre, and what is added to
    it by taking each centre away, as rows of that centre go to their second-nearest one or to the new one."""
    out = np.zeros((len(tried) + 1, len(centers) + 1))
    if not len(x):
        return out
    gaps = _gaps(x, centers)
    near = gaps.argmin(axis=1)
    lines = np.arange(len(x))
    one = gaps[lines, near]
    gaps[lines, near] = np.inf
    two = gaps.min(axis=1)
    out[0, 0] = (weight * one).sum()
    if len(tried):
        new = _gaps(x, tried)
        with_new = np.minimum(one[:, None], new)
        out[1:, 0] = weight @ with_new
        lost = (np.minimum(two[:, None], new) - with_new) * weight[:, None]
        by = np.argsort(near, kind="stable")
        own, at = np.unique(near[by], return_index=True)
        out[1:, 1 + own] = np.add.reduceat(lost[by], at).T
    return out


def _settle(points: np.ndarray, weight: np.ndarray, centers: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Centres (runs x k x dims) moved to rest on weighted points, all runs together, and the cost of every run."""
    centers = centers.copy()
    _, k, dims = centers.shape
    moving = np.arange(len(centers))
    for _ in range(rounds):
        near = _gaps(points, centers[moving].reshape(-1, dims)).reshape(len(points), len(moving), k).argmin(axis=2)
        member = np.zeros((len(points), len(moving) * k))
        np.put_along_axis(member, near + k * np.arange(len(moving)), weight[:, None], axis=1)
        count = member.sum(axis=0)[:, None]
        moved = np.where(count > 0, (member.T @ points) / np.where(count > 0, count, 1.0), centers[moving].reshape(-1, dims))
        moved = moved.reshape(-1, k, dims)
        changed = (moved != centers[moving]).any(axis=(1, 2))
        centers[moving] = moved
        moving = moving[changed]
        if not len(moving):
            break
    gaps = _gaps(points, centers.reshape(-1, dims)).reshape(len(points), -1, k).min(axis=2)
    return centers, weight @ gaps


def _scattered(points: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k weighted points drawn apart from each other."""
    chosen = [rng.choice(len(points), p=weight / weight.sum())]
    gap = _gaps(points, points[chosen])[:, 0]
    while len(chosen) < k:
        odds = weight * gap
        total = odds.sum()
        chosen.append(rng.choice(len(points), p=odds / total) if total > 0 else rng.integers(len(points)))
        gap = np.minimum(gap, _gaps(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def _improved(points: np.ndarray, weight: np.ndarray, centers: np.ndarray, cost: float) -> tuple[np.ndarray, float]:
    """Swaps of a centre for a point, settled, until none of the most promising ones lowers the cost.

    Points that cost most are tried: a swap pays by the cost it takes away."""
    while True:
        price = weight * _gaps(points, centers).min(axis=1)
        tried = points[np.argsort(-price, kind="stable")[: 2 * _TRIED]]
        sums = _swap_sums(points, weight, centers, tried)
        after = sums[1:, :1] + sums[1:, 1:]
        new, old = np.divmod(np.argsort(after, axis=None, kind="stable")[:_TRIED], len(centers))
        swapped = np.repeat(centers[None], len(new), axis=0)
        swapped[np.arange(len(new)), old] = tried[new]
        moved, costs = _settle(points, weight, swapped)
        best = int(costs.argmin())
        if costs[best] >= cost * (1 - 1e-9):
            return centers, cost
        centers, cost = moved[best], float(costs[best])


def _summary(points: _Points) -> tuple[np.ndarray, np.ndarray]:
    """Weighted points that stand for all rows: the means and numbers of rows around rows drawn far from each other."""
    chosen = points.first()
    for turn in range(_ROUNDS):
        more = points.far(chosen, turn)
        if not len(more):
            break
        chosen = np.unique(np.concatenate([chosen, more]), axis=0)
    sums = points.sums({0: chosen})[0]
    sums = sums[sums[:, 0] > 0]
    return sums[:, 1:-1] / sums[:, :1], sums[:, 0]


def _finalists(points: np.ndarray, weight: np.ndarray, k: int, starts: int, seed: int) -> list[np.ndarray]:
    """The best few of ``starts`` runs (several draws each) on weighted points, by swaps from where they came to rest."""
    draws = [np.random.default_rng([seed, k, start]) for start in range(starts)]
    settled, costs = _settle(points, weight, np.array([_scattered(points, weight, k, r) for r in draws for _ in range(_DRAWS)]))
    leading = np.argsort(costs, kind="stable")
    leading = [i for n, i in enumerate(leading) if not n or costs[i] > costs[leading[n - 1]] * (1 + 1e-9)][: 2 * _FINALISTS]
    improved = sorted((_improved(points, weight, settled[i], float(costs[i])) for i in leading), key=lambda f: f[1])
    out: list[tuple[np.ndarray, float]] = []
    for centers, cost in improved:
        if all(abs(cost - c) > 1e-9 * (cost + 1e-300) for _, c in out):
            out.append((centers, cost))
    return [centers for centers, _ in out[:_FINALISTS]]


def _at_rest(points: _Points, runs: dict[int, np.ndarray], limit: float, max_iter: int) -> dict[int, np.ndarray]:
    """All runs move together until each one's centres move by less than ``limit``."""
    runs, moving = dict(runs), set(runs)
    for _ in range(max_iter):
        if not moving:
            break
        for run, table in points.sums({r: runs[r] for r in moving}).items():
            count = table[:, :1]
            moved = np.where(count > 0, table[:, 1:-1] / np.maximum(count, 1.0), runs[run])
            if ((moved - runs[run]) ** 2).sum() <= limit:
                moving.discard(run)
            runs[run] = moved
    return runs


def fit_kmeans_grid(
    df: DataFrame,
    cols: Sequence[str],
    ks: Sequence[int],
    *,
    key: str,
    starts: int = 10,
    seed: int = 42,
    max_iter: int = 300,
    tol: float = 1e-4,
    max_swaps: int = 10,
) -> dict[int, KMeansFit]:
    """Best of ``starts`` k-means runs for every k, on complete numeric columns.

    All runs of all k share their passes over the data. Draws are made from all rows by hashes of the key, so they
    do not depend on partitioning, and rows far from all others are found however few they are. A fit ends when no
    swap of a centre for one of the far points tried lowers its cost over all rows (or after ``max_swaps`` rounds of
    them). The rows keep the partitioning they come with. Centres are ordered by their coordinates, which makes the
    cluster numbers stable."""
    ship_package(df.sparkSession)
    numbers = [as_column(c).cast("double") for c in cols]
    place = F.xxhash64(F.lit(seed), as_column(key), *[as_column(c) for c in cols])
    rows = keep(df.select(F.array(*numbers).alias("x"), place.alias("_place")))
    try:
        at = [F.col("x")[i] for i in range(len(cols))]
        n, *moments = rows.agg(F.count(F.lit(1)), *[F.avg(c) for c in at], *[F.var_pop(c) for c in at]).first()
        if not n:
            raise ValueError("no rows to cluster")
        mean, variance = np.array(moments[: len(cols)], dtype=float), np.array(moments[len(cols) :], dtype=float)
        points = _Points(rows, len(cols), n, mean, float(variance.mean()))
        few, weight = _summary(points)
        runs, of = {}, {}
        for k in dict.fromkeys(ks):
            for centers in _finalists(few, weight, k, starts, seed):
                of[len(runs)] = k
                runs[len(runs)] = centers
        open_runs, cost = dict(runs), {}
        for turn in range(max_swaps + 1):
            open_runs = _at_rest(points, open_runs, tol * points.spread, max_iter)
            tried = {r: _costly(few, weight, c) for r, c in open_runs.items()}
            again = {}
            for run, (now, after) in points.swaps(open_runs, tried).items():
                if run not in cost or now < cost[run]:
                    cost[run], runs[run] = now, open_runs[run]
                    if after.size and after.min() < now * (1 - 1e-7) and now > 0:
                        new, old = divmod(int(after.argmin()), of[run])
                        again[run] = runs[run].copy()
                        again[run][old] = tried[run][new]
            if not again:
                break
            open_runs = again
    finally:
        rows.unpersist()
    best = {}
    for run, k in of.items():
        if k not in best or cost[run] < cost[best[k]]:
            best[k] = run
    return {
        k: KMeansFit(k, tuple(cols), tuple(sorted(tuple(map(float, c + mean)) for c in runs[run])), cost[run])
        for k, run in best.items()
    }


def _costly(few: np.ndarray, weight: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The weighted points that cost most under the centres."""
    price = weight * _gaps(few, centers).min(axis=1)
    return few[np.argsort(-price, kind="stable")[:_TRIED]]


def fit_kmeans(df: DataFrame, cols: Sequence[str], k: int, *, key: str, **options) -> KMeansFit:
    return fit_kmeans_grid(df, cols, [k], key=key, **options)[k]


def elbow(df: DataFrame, cols: Sequence[str], *, key: str, k_max: int = 10, **options) -> DataFrame:
    """Within-cluster squared distance for k = 2..k_max."""
    fits = fit_kmeans_grid(df, cols, range(2, k_max + 1), key=key, **options)
    return df.sparkSession.createDataFrame(
        [(k, fit.inertia) for k, fit in sorted(fits.items())], "k int, inertia double"
    )


def nearest_center(cols: Sequence[str], centers: Sequence[Sequence[float]]) -> Column:
    """Number of the closest centre (the first one on a tie)."""
    gaps = []
    for center in centers:
        steps = [as_column(c) - F.lit(float(v)) for c, v in zip(cols, center)]
        gaps.append(reduce(add, [step * step for step in steps]))
    distances = F.array(*gaps)
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def assign_clusters(df: DataFrame, fit: KMeansFit, *, name: str = "cluster") -> DataFrame:
    """Add the cluster number; the key and all other columns stay."""
    return df.withColumn(name, nearest_center(fit.columns, fit.centers))


def cluster_profile(df: DataFrame, cols: Sequence[str], *, name: str = "cluster") -> DataFrame:
    return group_means(df, name, cols)
