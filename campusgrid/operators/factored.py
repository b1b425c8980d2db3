"""Counts and means over many-to-many joins, without the joined rows.

A chain of many-to-many joins multiplies rows; its aggregates do not need them. Every table is reduced to one row per
join key and group with its number of rows, and each measure's number and sum. Joining two such tables multiplies
numbers: a sum on one side counts once for every row of the other. So a join never makes more rows than there are
combinations of keys and groups, whatever the tables' rows would multiply to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_column


@dataclass(frozen=True)
class Joined:
    """A table in a tree of left joins. ``on``: (column of the table it hangs on, own column). ``groups`` and ``measures``
    are own columns, under names that no other table of the tree uses for these."""

    table: DataFrame
    on: tuple[str, str] | None = None
    groups: Sequence[str] = ()
    measures: Sequence[str] = ()
    branches: Sequence[Joined] = field(default=())

    def names(self, kind: str) -> list[str]:
        return [*getattr(self, kind), *[n for b in self.branches for n in b.names(kind)]]


def _factors(node: Joined) -> DataFrame:
    """``_key`` (of the join to the table above), groups of the subtree, ``_n`` rows, and ``_c``, ``_s`` of each measure."""
    up = as_column(node.on[1]) if node.on else F.lit(None).cast("string")
    links = [as_column(b.on[0]).alias(f"_link{i}") for i, b in enumerate(node.branches)]
    one = [F.count(as_column(m)).alias(f"_c_{m}") for m in node.measures]
    total = [F.coalesce(F.sum(as_column(m).cast("double")), F.lit(0.0)).alias(f"_s_{m}") for m in node.measures]
    keys = [up.alias("_key"), *links, *[as_column(g) for g in node.groups]]
    out = node.table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *one, *total)
    groups, sums = list(node.groups), [f"_{p}_{m}" for m in node.measures for p in "cs"]
    for i, branch in enumerate(node.branches):
        below = _factors(branch).withColumnsRenamed({"_key": "_below", "_n": "_m"}).where("_below is not null")
        more_groups, more = branch.names("groups"), [f"_{p}_{m}" for m in branch.names("measures") for p in "cs"]
        met = out.join(below, F.col(f"_link{i}") == F.col("_below"), "left")
        times = F.coalesce(F.col("_m"), F.lit(1))  # a row that meets none stays as one row
        out = met.select(
            "_key", *[f"_link{j}" for j in range(i + 1, len(node.branches))], *[as_column(g) for g in [*groups, *more_groups]],
            (F.col("_n") * times).alias("_n"), *[(as_column(s) * times).alias(s) for s in sums],
            *[(F.coalesce(as_column(s), F.lit(0)) * F.col("_n")).alias(s) for s in more],
        )
        groups, sums = [*groups, *more_groups], [*sums, *more]
    if not node.branches:
        return out
    return out.groupBy("_key", *[as_column(g) for g in groups]).agg(F.sum("_n").alias("_n"), *[F.sum(as_column(s)).alias(s) for s in sums])


def joined_means(root: Joined) -> DataFrame:
    """Per combination of the tree's groups: ``rows`` of the left joins, and the mean of every measure over them.

    Nulls are left out of means, null keys meet nothing, null groups are groups; a group or measure of a table that a
    row does not meet is null, as in the joins themselves."""
    groups, measures = root.names("groups"), root.names("measures")
    names = [*groups, *measures]
    if len(set(names)) < len(names):
        raise ValueError(f"groups and measures must have names of their own: {names}")
    means = [F.try_divide(as_column(f"_s_{m}"), as_column(f"_c_{m}")).alias(m) for m in measures]
    return _factors(root).select(*[as_column(g) for g in groups], F.col("_n").alias("rows"), *means)
