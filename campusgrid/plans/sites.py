"""One wide row per school site from register, classrooms, buildings, history and distances."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_column, flag_present, ordinal_map, zero_pad_code
from ..operators.aggregate import flag_sum, number_max, profile, row_count, value_count
from ..operators.relational import keep_first, left_join
from ..operators.reshape import mean_or_zero, observed_values
from . import names as N


def site_register(register: DataFrame, *, order: Sequence[str]) -> DataFrame:
    """The register with the first row of every site."""
    wanted = register.select(*[as_column(c) for c in dict.fromkeys((*N.REGISTER, *order))])
    return keep_first(wanted, N.SITE, order).select(*[as_column(c) for c in N.REGISTER])


def classroom_profile(classrooms: DataFrame) -> DataFrame:
    """Rooms, highest floor, rooms in use and rooms by type, from one shuffle. Type counts are
    null for a site that states no type at all."""
    return profile(
        classrooms,
        N.SITE,
        row_count().alias("n_aulas"),
        number_max("P61_2").alias("max_piso"),
        flag_sum("P61_3").alias("P61_3"),
        *[value_count("P61_4", v).alias(f"P61_4{v}") for v in N.ROOM_TYPES],
    )


def building_profile(buildings: DataFrame, *, states: Sequence[str] | None = None) -> DataFrame:
    """Buildings, feature flags and buildings by state, from one shuffle. The states are those
    found in the data, in order, unless listed."""
    if states is None:
        states = observed_values(buildings, ["P53_10"])["P53_10"]
    return profile(
        buildings,
        N.SITE,
        row_count().alias("n_edificios"),
        *[flag_sum(c).alias(c) for c in N.BUILDING_FLAGS],
        *[value_count("P53_10", v).alias(f"P5310{v}") for v in states],
    )


def achievement_history(history: DataFrame, *, order: Sequence[str], width: int = 6) -> DataFrame:
    """Programme flags of the first row of a site, and its mean level per subject.

    A subject the site was never tested in counts as 0; a tested one without a known level
    stays null. Flags and means come from one aggregate."""
    subject = F.lower(as_column("Evaluación"))
    flags = [N.PROGRAMME_NAMES.get(c, c) for c in N.PROGRAMMES]
    # The flags travel as one number: with a numeric order column the aggregate then keeps
    # only numbers per group and can hash instead of sorting.
    packed = reduce(add, [flag_present(c) * (1 << i) for i, c in enumerate(N.PROGRAMMES)])
    prepared = history.select(
        zero_pad_code("Cod_Local", width).alias(N.SITE),
        packed.alias("_flags"),
        subject.alias("_subject"),
        ordinal_map("Nivel de logro", N.LEVELS).alias("_level"),
        _ranking(history, order).alias("_order"),
    )
    found = prepared.groupBy(N.SITE).agg(
        F.min_by("_flags", "_order").alias("_flags"),
        *[mean_or_zero("_subject", s, "_level").alias(name) for s, name in N.SUBJECTS.items()],
    )
    # Rows without a code form one group for the flags but have no subject means.
    return found.select(
        N.SITE,
        *[F.shiftright("_flags", i).bitwiseAND(F.lit(1)).alias(f) for i, f in enumerate(flags)],
        *[F.when(F.col(N.SITE).isNotNull(), as_column(n)).alias(n) for n in N.SUBJECTS.values()],
    )


def _ranking(df: DataFrame, order: Sequence[str]) -> Column:
    """An order that is never null, as a plain number when it is one integer column."""
    if len(order) == 1 and dict(df.dtypes)[order[0]] in ("int", "bigint"):
        return F.coalesce(as_column(order[0]).cast("bigint"), F.lit(-(2**63)))
    return F.struct(*[as_column(c) for c in order])


def site_distances(distances: DataFrame) -> DataFrame:
    return distances.withColumn(N.SITE, zero_pad_code(N.SITE))


def integrate_sites(
    register: DataFrame,
    classrooms: DataFrame,
    buildings: DataFrame,
    history: DataFrame,
    distances: DataFrame,
    *,
    register_order: Sequence[str],
    history_order: Sequence[str],
    states: Sequence[str] | None = None,
) -> DataFrame:
    """history <- (register <- (buildings <- classrooms)) <- distances, all left joins on the
    site. Every input is down to one row per site before it is joined, so nothing fans out."""
    infrastructure = left_join(building_profile(buildings, states=states), classroom_profile(classrooms), N.SITE)
    base = left_join(site_register(register, order=register_order), infrastructure, N.SITE)
    result = left_join(achievement_history(history, order=history_order), base, N.SITE)
    return left_join(result, site_distances(distances), N.SITE)
