"""Cross-validated lasso for very many columns, such as the values of open categories.

Rows stay sparse, and no square of all columns is ever formed. All that the fits must know of a category (its rows, and
the sums of the numbers and of the target over them, per fold) is summed up once, into a table with one row per
category that stays distributed. The penalties are taken in blocks from large to small. For a block, the strong rule
names the few columns that can matter; cross products of these alone give the solutions of all folds; then one pass over
the table checks for every column, fold and penalty that leaving it out was right, and any column that fails the check
joins. So the rule decides the work, the check the result. The driver gets only the columns that fail or pull hardest."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_column, hash_bucket, present
from ..session import keep, ship_package
from .prepare import MedianImputer, ZScaler

#: So many numbers are multiplied with all others in the first pass; further ones when they are wanted.
_ALONG = 100


def lasso_solution(cov: np.ndarray, target: np.ndarray, alpha: float, start: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    """Coordinate descent on a covariance from ``start``: the columns in use come to rest, then any other column that
    pulls harder than the penalty joins them."""
    weights = start.copy()
    scale = np.diagonal(cov)
    used = np.flatnonzero(weights)
    for _ in range(max_iter):
        for _ in range(max_iter):
            biggest = 0.0
            for j in used.tolist():
                pull = target[j] - cov[j, used] @ weights[used] + scale[j] * weights[j]
                new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / scale[j]
                biggest = max(biggest, abs(new - weights[j]))
                weights[j] = new
            if biggest <= tol:
                break
        pull = np.abs(target - cov[:, used] @ weights[used])
        joins = (pull > alpha * (1 + 1e-9)) & (weights == 0) & (scale > 1e-12)
        joins[used] = False
        if not joins.any():
            break
        used = np.flatnonzero(joins | (weights != 0))
    return weights


@dataclass(frozen=True)
class _Rows:
    """``fold``, ``y``, ``n0``, ... (scaled numbers) and ``t0``, ... (texts).

    The driver names a column by (-1, place) if it is a number, and a category by (place of its text, value)."""

    frame: DataFrame
    numbers: int
    texts: int
    folds: int

    def crossed(self, right: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """Per fold the cross products of [1, numbers, y] with the ``right`` ones of these, and the squares of all."""
        numbers, folds, right = self.numbers, self.folds, list(right)
        shape = (folds, numbers + 2, len(right) + 1)

        def run(batches):
            total = np.zeros(shape)
            for batch in batches:
                n = batch.num_rows
                num = batch.column("num").flatten().to_numpy(zero_copy_only=False).reshape(n, numbers)
                fold, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "y"))
                x = np.column_stack([np.ones(n), num, y])
                for f in np.unique(fold):
                    own = x[fold == f]
                    total[f, :, :-1] += own.T @ own[:, right]
                    total[f, :, -1] += (own**2).sum(axis=0)
            total = total.reshape(-1)
            for a in range(0, len(total), 1 << 16):
                part = total[a : a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(a, a + len(part))), pa.array(part)], names=["spot", "v"])

        num = F.array(*[F.col(f"n{i}") for i in range(numbers)]).cast("array<double>")
        parts = self.frame.select("fold", "y", num.alias("num")).mapInArrow(run, "spot bigint, v double")
        found = parts.groupBy("spot").agg(F.sum("v").alias("v")).toArrow()
        total = np.zeros(shape)
        total.reshape(-1)[found["spot"].to_numpy()] = found["v"].to_numpy()
        return total[..., :-1], total[..., -1]

    def _pairs(self, frame: DataFrame, *cols: str) -> DataFrame:
        pairs = F.inline(F.array(*[F.struct(F.lit(i).alias("which"), F.col(f"t{i}").alias("value")) for i in range(self.texts)]))
        return frame.select("fold", *cols, pairs).where("value is not null")

    def categories(self) -> DataFrame:
        """``which`` text, ``value`` and ``products``: a line for each fold, [fold, rows, sums of the numbers, sum of y]."""
        if not self.texts:
            return self.frame.sparkSession.createDataFrame([], "which int, value string, products array<double>")
        cols = [*[f"n{i}" for i in range(self.numbers)], "y"]
        sums = [F.count(F.lit(1)).cast("double").alias("rows"), *[F.sum(c).alias(c) for c in cols]]
        found = self._pairs(self.frame, *cols).groupBy("which", "value", "fold").agg(*sums)
        line = F.array(F.col("fold").cast("double"), "rows", *cols)
        return found.groupBy("which", "value").agg(F.flatten(F.collect_list(line)).alias("products"))

    def beside(self, active: Sequence[tuple[int, str]]) -> DataFrame:
        """``which``, ``value`` and ``others``: in how many rows the category stands beside ``active`` ones, in lines
        [place in active, fold, rows]."""
        frame = self.frame.select("fold", *[f"t{i}" for i in range(self.texts)])
        places = []
        for i in range(self.texts):
            own = [(at, value) for at, (which, value) in enumerate(active) if which == i]
            if own:
                named = pa.table({f"t{i}": pa.array([v for _, v in own], pa.string()), f"a{i}": pa.array([a for a, _ in own], pa.int32())})
                frame = frame.join(self.frame.sparkSession.createDataFrame(named), f"t{i}", "left")
                places.append(F.col(f"a{i}"))
        found = frame.withColumn("at", F.explode(F.array_compact(F.array(*places))))
        counted = self._pairs(found, "at").groupBy("which", "value", "at", "fold").agg(F.count(F.lit(1)).alias("rows"))
        line = F.array(*[F.col(c).cast("double") for c in ("at", "fold", "rows")])
        return counted.groupBy("which", "value").agg(F.flatten(F.collect_list(line)).alias("others"))


def _rows(df: DataFrame, numbers: Sequence[str], texts: Sequence[str], target: str, key: str, folds: int) -> DataFrame:
    """The columns of ``_Rows``, numbers as they are."""
    return df.where(present(df, [target])).select(
        hash_bucket(key, folds).cast("int").alias("fold"), as_column(target).cast("double").alias("y"),
        *[as_column(c).cast("double").alias(f"n{i}") for i, c in enumerate(numbers)],
        *[as_column(c).cast("string").alias(f"t{i}") for i, c in enumerate(texts)],
    )


def _lines(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of ``width`` numbers out of flat lists, and the row that each comes from."""
    lines = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) // width
    return np.repeat(np.arange(len(counts)), counts), lines


def _named(spark: SparkSession, keys: Sequence[tuple[int, str]], **more: Sequence[float]) -> DataFrame:
    """A small table of categories."""
    columns = {"which": pa.array([k[0] for k in keys], pa.int32()), "value": pa.array([k[1] for k in keys], pa.string())}
    return spark.createDataFrame(pa.table({**columns, **{name: pa.array(v, pa.float64()) for name, v in more.items()}}))


def _gathered(table: DataFrame, column: str, width: int, keys: Sequence[tuple[int, str]]) -> Iterator[tuple[tuple[int, str], np.ndarray]]:
    """Some categories with their lines."""
    if keys:
        found = table.join(_named(table.sparkSession, keys), ["which", "value"]).select("which", "value", column)
        for batch in found.toArrow().to_batches():
            row, lines = _lines(batch.column(column), width)
            own = np.split(lines, np.searchsorted(row, np.arange(1, batch.num_rows)))
            yield from zip(zip(batch.column("which").to_pylist(), batch.column("value").to_pylist()), own)


def _hardest(table: DataFrame, fits: Sequence[tuple], n: float, folds: int, limits: np.ndarray, most: int) -> DataFrame:
    """The categories that pull harder than ``limits`` in any solution, and after these the ones that pull hardest in the
    last solution of any fit; ``most`` in all.

    A fit has its held-out fold (-1: none), its number of rows, and for each solution the weights of [1, numbers, y] and
    of the active categories in the residual."""

    def run(batches):
        for batch in batches:
            row, lines = _lines(batch.column("products"), len(fits[0][2]) + 1)
            sums = np.zeros((batch.num_rows, folds, len(fits[0][2])))
            sums[row, lines[:, 0].astype(int)] = lines[:, 1:]
            share = sums[..., 0].sum(axis=1) / n
            variance = np.maximum(share - share**2, 0.0)
            weight = np.where(variance > 1e-12, 1 / np.sqrt(np.where(variance > 1e-12, variance, 1.0)), 0.0)
            other = _lines(batch.column("others"), 3) if "others" in batch.schema.names else None
            pull, fails = np.zeros(batch.num_rows), np.zeros(batch.num_rows, dtype=bool)
            for held, size, line, own in fits:
                rest = sums[:, np.arange(folds) != held].sum(axis=1) @ line
                if other:
                    at, count = other[1][:, 0].astype(int), np.where(other[1][:, 1] == held, 0.0, other[1][:, 2])
                    for i in range(rest.shape[1]):
                        rest[:, i] += np.bincount(other[0], count * own[at, i], batch.num_rows)
                rest = np.abs(rest / size * weight[:, None])
                fails |= (rest > limits).any(axis=1)
                pull = np.maximum(pull, rest[:, -1])
            order = np.lexsort((-np.where(np.isnan(pull), np.inf, pull), ~fails))[:most]
            found = [batch.column("which").take(pa.array(order)), batch.column("value").take(pa.array(order))]
            yield pa.RecordBatch.from_arrays([*found, pa.array(pull[order]), pa.array(fails[order])], names=["which", "value", "pull", "fails"])

    return table.mapInArrow(run, "which int, value string, pull double, fails boolean").orderBy(F.desc("fails"), F.desc("pull")).limit(most)


def _moments(products: np.ndarray, scale: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(n, means, covariance) of the scaled columns and the target."""
    n = products[0, 0]
    means = products[0, 1:] / n / scale
    return n, means, products[1:, 1:] / n / np.outer(scale, scale) - np.outer(means, means)


def wide_lasso_cv(
    df: DataFrame, features: Sequence[str], target: str, *, key: str, folds: int = 5, alphas: int = 100, ratio: float = 1e-3,
    max_iter: int = 1000, tol: float = 1e-8, max_active: int = 2000, block: int = 8,
) -> DataFrame:
    """What ``lasso_cv`` gives, for any number of category values: one row per column (``feature``, ``coefficient``,
    ``selected``, ``alpha``).

    The driver and every task hold the products of the columns in use with each other and with the numbers, nothing per
    category; more columns in use than ``max_active`` are an error."""
    spark = df.sparkSession
    ship_package(spark)
    kinds = dict(df.dtypes)
    numbers, texts = ([f for f in features if (kinds[f] == "string") == wanted] for wanted in (False, True))
    used = keep(_rows(df, numbers, texts, target, key, folds))
    kept = [used]
    try:
        frame = used
        if numbers:
            names = [f"n{i}" for i in range(len(numbers))]
            filled = MedianImputer(inputCols=names).fit(used).transform(used)
            frame = ZScaler(inputCols=names).fit(filled).transform(filled)
        rows = _Rows(frame, len(numbers), len(texts), folds)
        kept.append(keep(rows.categories()))
        # Of every text column the first value has no column.
        firsts = kept[-1].groupBy("which").agg(F.min("value").alias("value")).collect()
        left_out = reduce(or_, [(F.col("which") == r.which) & (F.col("value") == F.lit(r.value)) for r in firsts], F.lit(False))
        table = kept[-1].where(~left_out)
        last = len(numbers) + 1
        first, squares = rows.crossed([0, last, *range(1, min(len(numbers), _ALONG) + 1)])
        one, aim = first[..., 0], first[..., 1]
        n = one[:, 0].sum()
        if not n or not numbers and table.isEmpty():
            return spark.createDataFrame([], "feature string, coefficient double, selected boolean, alpha double")
        #: Per column and fold the products with [1, numbers, y].
        known = {(-1, i): first[..., i + 2] for i in range(first.shape[-1] - 2)}
        held_out = [f for f in range(folds) if one[f, 0] > 0]
        fits = [*held_out, -1]

        def part(values, f):
            """Over the rows that fold f trains on (-1: all)."""
            return values[np.arange(folds) != f].sum(axis=0)

        def spread(mean, square):
            variance = np.maximum(square - mean**2, 0.0)
            return variance > 1e-12, np.where(variance > 1e-12, np.sqrt(variance), 1.0)

        varied, scale = spread(one[:, 1:last].sum(axis=0) / n, squares[:, 1:last].sum(axis=0) / n)

        def learn(wanted):
            """Know the products of ``wanted`` columns."""
            if new := [i for which, i in wanted if which < 0 and (which, i) not in known]:
                found, _ = rows.crossed([i + 1 for i in new])
                known.update({(-1, i): found[..., k] for k, i in enumerate(new)})
            for w, lines in _gathered(table, "products", last + 2, [w for w in wanted if w not in known]):
                known[w] = np.zeros((folds, last + 1))
                known[w][lines[:, 0].astype(int)] = lines[:, 1:]

        def stacked(wanted):
            """Per fold the products of [1, wanted columns, y] with [1, numbers, y]."""
            return np.stack([one, *[known[w] for w in wanted], aim], axis=1)

        def crossed(wanted, together):
            """Per fold the cross products of [1, wanted columns, y]. ``together``: of the categories among them."""
            stack = stacked(wanted)
            plain = sum(which < 0 for which, _ in wanted) + 1
            at, basis = [*range(plain), len(wanted) + 1], [0, *[i + 1 for _, i in wanted[: plain - 1]], last]
            products = np.zeros((folds, len(wanted) + 2, len(wanted) + 2))
            products[:, :, at] = stack[:, :, basis]
            products[:, at, :] = stack[:, :, basis].transpose(0, 2, 1)
            products[:, plain:-1, plain:-1] = together
            own = np.arange(plain, len(wanted) + 1)
            products[:, own, own] = stack[:, own, 0]
            return products

        def pulls(wanted, beside, lines, limits, most):
            """(column, pull, whether it fails) of the other columns: all numbers, and the categories that matter. ``lines``:
            per fit the weights of [1, wanted columns, y] in the residuals."""
            stack = stacked(wanted)
            plain = sum(which < 0 for which, _ in wanted) + 1
            pull, fails, asked = np.zeros(len(numbers)), np.zeros(len(numbers), dtype=bool), []
            for f, line in lines.items():
                size = part(one, f)[0]
                rest = np.abs(part(stack, f)[:, 1:last].T @ line / size / scale[:, None] * varied[:, None])
                fails |= (rest > limits).any(axis=1)
                pull = np.maximum(pull, rest[:, -1])
                weights = np.zeros((last + 1, line.shape[1]))
                weights[[0, *[i + 1 for _, i in wanted[: plain - 1]], last]] = line[[*range(plain), -1]]
                asked.append((f, size, weights, line[plain:-1]))
            others = table if beside is None else table.join(beside, ["which", "value"], "left")
            if len(wanted) >= plain:
                others = others.join(_named(spark, wanted[plain - 1 :]), ["which", "value"], "left_anti")
            found = [((-1, i), pull[i], fails[i]) for i in range(len(numbers)) if (-1, i) not in wanted]
            return found + [((r.which, r.value), r.pull, r.fails) for r in _hardest(others, asked, n, folds, limits, most).collect()]

        # So many that a list that ends there is too long for any block.
        most = 2 * max_active + 1
        means = {f: np.array([[-part(aim, f)[0] / part(one, f)[0]], [1.0]]) for f in fits}
        nothing = np.array([np.inf])
        top = float(np.max([p for _, p, _ in pulls([], None, {-1: means[-1]}, nothing, 1)]))
        grid = np.geomspace(top, top * ratio, alphas) if top > 0 else np.array([0.0])
        error, path = np.zeros(len(grid)), []
        listed = pulls([], None, means, nothing, most)
        active, weights = [], {f: np.zeros(0) for f in fits}
        beside, beside_of, together = None, [], 0.0
        done, before = 0, float(np.max([p for _, p, _ in listed]))

        def likely(penalty):
            return sorted({*active, *[c for c, p, _ in listed if p >= 2 * penalty - before]})

        while done < len(grid):
            some = min(block, len(grid) - done)
            wanted = likely(grid[done + some - 1])
            while some > 1 and len(wanted) > max(max_active // 2, 2 * len(active)):
                some = (some + 1) // 2  # a shorter block names fewer columns
                wanted = likely(grid[done + some - 1])
            penalties = grid[done : done + some]
            while True:
                if len(wanted) > max_active:
                    raise ValueError(f"{len(wanted)} columns in use exceed max_active={max_active}; raise it or ratio")
                learn(wanted)
                categories = [w for w in wanted if w[0] >= 0]
                if len(texts) > 1 and categories != beside_of:
                    if beside is not None:
                        kept.remove(beside)
                        beside.unpersist()
                    beside, beside_of = keep(rows.beside(categories)), categories
                    kept.append(beside)
                    together = np.zeros((folds, len(categories), len(categories)))
                    for c, lines in _gathered(beside, "others", 3, categories):
                        together[lines[:, 1].astype(int), categories.index(c), lines[:, 0].astype(int)] = lines[:, 2]
                products = crossed(wanted, together)
                counts = np.array([known[w][:, 0].sum() / n for w in categories])
                own = np.concatenate([scale[[i for which, i in wanted if which < 0]], spread(counts, counts)[1]])
                unit = np.append(own, 1.0)
                found, intercepts, lines = {}, {}, {}
                for f in fits:
                    _, centre, cov = _moments(part(products, f), unit)
                    start = np.zeros(len(wanted))
                    start[[wanted.index(a) for a in active]] = weights[f]
                    for i, alpha in enumerate(penalties):
                        start = lasso_solution(cov[:-1, :-1], cov[:-1, -1], alpha, start, max_iter, tol)
                        found[f, i] = start
                        intercepts[f, i] = centre[-1] - centre[:-1] @ start
                    lines[f] = np.stack([np.concatenate([[-intercepts[f, i]], -found[f, i] / own, [1.0]]) for i in range(some)], axis=1)
                listed = pulls(wanted, beside, lines, penalties * (1 + 1e-6) + 1e-9 * top, most)
                fails = [c for c, _, failed in listed if failed]
                if not fails:
                    break
                wanted = sorted({*wanted, *fails})
            for i in range(some):
                for f in held_out:
                    line = np.concatenate([[intercepts[f, i]], found[f, i] / own, [-1.0]])
                    error[done + i] += (line @ products[f] @ line) / products[f][0, 0] / len(held_out)
                path.append((wanted, found[-1, i]))
            weights = {f: found[f, some - 1] for f in fits}
            active, before, done = wanted, float(penalties[-1]), done + some
        best = int(error.argmin())
        chosen = {w: float(v) for w, v in zip(*path[best]) if v != 0}
        named = spark.createDataFrame([(c, chosen.get((-1, i), 0.0)) for i, c in enumerate(numbers)], "feature string, coefficient double")
        if texts:
            values = keep(table.select("which", "value"))
            values.count()
            label = F.concat(F.element_at(F.array(*map(F.lit, texts)), F.col("which") + 1), F.lit("_"), "value")
            listed = [w for w in chosen if w[0] >= 0]
            if listed:
                values = values.join(_named(spark, listed, coefficient=[chosen[w] for w in listed]), ["which", "value"], "left")
            else:
                values = values.withColumn("coefficient", F.lit(None).cast("double"))
            named = named.unionByName(values.select(label.alias("feature"), F.coalesce("coefficient", F.lit(0.0)).alias("coefficient")))
        return named.select("feature", "coefficient", (F.col("coefficient") != 0).alias("selected"), F.lit(float(grid[best])).alias("alpha"))
    finally:
        for x in kept:
            x.unpersist()
