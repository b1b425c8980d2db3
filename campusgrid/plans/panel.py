"""Exploratory panel over all sources, and the yearly programme panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_column, clean_text, flag_present, ordinal_map, zero_pad_code
from ..operators.aggregate import profile
from ..operators.factored import Joined, joined_means
from ..operators.relational import distinct_join, left_join
from ..operators.reshape import mean_pivot
from . import names as N


def section_results(evaluations: DataFrame) -> DataFrame:
    """Distinct students and mean scores per programme, school, grade, booklet and area."""
    return profile(
        evaluations,
        ["Programa", "nom_ie", "grado", "cuadernillo", "area_evaluacion"],
        F.count_distinct("id_estudiante").alias("cantidad_alumnos"),
        F.avg("suma_puntaje").alias("promedio_suma_puntaje"),
        F.avg("tot_preguntas").alias("promedio_tot_preguntas"),
        F.avg("porcentaje_promedio").alias("promedio_porcentaje"),
    )


def history_means(history: DataFrame) -> DataFrame:
    """Mean achievement level per school, site, year, area, subject and period."""
    levelled = history.withColumn("_level", ordinal_map("Nivel de logro", N.LEVELS))
    return profile(
        levelled,
        ["Nombre_IE", "Cod_Local", "AÑO", "Área", "Evaluación", "PERIODO"],
        F.avg("_level").alias("promedio_logro"),
    )


def exploratory_panel(
    register: DataFrame,
    buildings: DataFrame,
    classrooms: DataFrame,
    evaluations: DataFrame,
    history: DataFrame,
    master: DataFrame,
    *,
    digits: int | None = None,
) -> DataFrame:
    """History means with section results (by school name), site structure (by code) and the
    master table (by code); distinct rows. Master columns are named ``<column>_master`` where
    they collide. ``digits`` rounds the means.

    The inputs are deduplicated before each many-to-many join, so a site's buildings and
    classrooms multiply by their distinct descriptions only. All joins are on keys of the history
    means: the master table comes first, which hardly multiplies, and sections, which multiply by
    programme, grade, booklet and area, come last, so that their products are neither shuffled nor
    sorted nor looked up again. Means are rounded before rows multiply."""

    def coded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        return df.select(*[as_column(c) for c in columns]).withColumn(N.SITE, zero_pad_code(N.SITE))

    structure = distinct_join(
        coded(register, N.REGISTER_OLD),
        [(coded(buildings, N.BUILDINGS_OLD), N.SITE), (coded(classrooms, N.CLASSROOMS), N.SITE)],
    )
    means = history_means(history).withColumn("Cod_Local", zero_pad_code("Cod_Local")).distinct()
    sections = section_results(evaluations)
    if digits is not None:
        means, sections = (
            df.withColumns({c: F.round(as_column(c), digits) for c in df.columns if c.startswith("promedio_")})
            for df in (means, sections)
        )
    taken = {*means.columns, *sections.columns, *structure.columns}
    places = master.withColumn(N.SITE, zero_pad_code(N.SITE)).distinct()
    places = places.select(*[as_column(c).alias(f"{c}_master" if c in taken else c) for c in places.columns])
    panel = left_join(means, places, [("Cod_Local", f"{N.SITE}_master")])
    panel = left_join(panel, structure, [("Cod_Local", N.SITE)])
    panel = left_join(panel, sections, [("Nombre_IE", "nom_ie")])
    return panel.select(*[as_column(c) for df in (means, sections, structure, places) for c in df.columns])


def panel_means(
    register: DataFrame,
    buildings: DataFrame,
    classrooms: DataFrame,
    evaluations: DataFrame,
    history: DataFrame,
    master: DataFrame,
) -> DataFrame:
    """Rows and means of the exploratory panel per subject, programme and type of school, without making its rows."""

    def coded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        return df.select(*[as_column(c) for c in columns]).withColumn(N.SITE, zero_pad_code(N.SITE)).distinct()

    site = (N.SITE, N.SITE)
    rooms = [Joined(coded(buildings, N.BUILDINGS_OLD), site), Joined(coded(classrooms, N.CLASSROOMS), site)]
    structure = Joined(coded(register, N.REGISTER_OLD), ("Cod_Local", N.SITE), ["D_FORMA"], ["TALUMNO"], rooms)
    sections = Joined(section_results(evaluations), ("Nombre_IE", "nom_ie"), ["Programa"], ["promedio_suma_puntaje"])
    places = master.withColumn(N.SITE, zero_pad_code(N.SITE)).distinct()
    distances = Joined(places, ("Cod_Local", N.SITE), [], [N.DISTANCE])
    means = history_means(history).withColumn("Cod_Local", zero_pad_code("Cod_Local")).distinct()
    return joined_means(Joined(means, None, ["Evaluación"], ["promedio_logro"], [sections, structure, distances]))


def programme_panel(history: DataFrame, *, year: int | None = None) -> DataFrame:
    """Mean level per subject for every site, year and combination of programme flags."""
    flags = {c: N.PROGRAMME_NAMES.get(c, c) for c in N.PROGRAMMES_PANEL}
    prepared = history if year is None else history.where(as_column("AÑO") == year)
    prepared = prepared.select(
        as_column("Cod_Local"),
        as_column("AÑO"),
        *[flag_present(c).alias(name) for c, name in flags.items()],
        clean_text("Evaluación").alias("_subject"),
        ordinal_map("Nivel de logro", N.LEVELS).alias("_level"),
    )
    wide = mean_pivot(
        prepared, ["Cod_Local", "AÑO", *flags.values()], "_subject", "_level", N.SUBJECTS_PANEL
    )
    return wide.withColumn("Cod_Local", zero_pad_code("Cod_Local"))


def modelling_table(master: DataFrame, history: DataFrame, *, year: int) -> DataFrame:
    """The master table with the programme panel of one year."""
    coded = master.withColumn(N.SITE, zero_pad_code(N.SITE))
    return left_join(coded, programme_panel(history, year=year), [(N.SITE, "Cod_Local")])
