"""Student evaluation summary and its report tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_column
from ..operators.aggregate import describe_numeric, first_value, profile
from ..operators.relational import value_counts
from ..operators.reports import histogram, kernel_density, series_by_group, top_groups
from ..session import keep


def student_summary(evaluations: DataFrame, *, order: str) -> DataFrame:
    """Students, mean results and location per school, grade and programme."""
    return profile(
        evaluations,
        ["nom_ie", "grado", "Programa"],
        F.count("id_estudiante").alias("n_estudiantes"),
        F.avg("porcentaje_promedio").alias("porcentaje_promedio"),
        F.avg("suma_puntaje").alias("suma_puntaje"),
        first_value("region", order).alias("region"),
        first_value("ugel", order).alias("ugel"),
    )


@dataclass(frozen=True)
class StudentReports:
    """Report tables of a kept summary, each made when asked for."""

    summary: DataFrame

    def description(self) -> DataFrame:
        return describe_numeric(self.summary, ["n_estudiantes", "porcentaje_promedio", "suma_puntaje"])

    def histogram(self) -> DataFrame:
        return histogram(self.summary, "porcentaje_promedio")

    def density(self) -> DataFrame:
        return kernel_density(self.summary, "porcentaje_promedio")

    def best(self) -> DataFrame:
        return top_groups(
            self.summary, "porcentaje_promedio", size="n_estudiantes", ties=["nom_ie", "grado", "Programa"]
        )

    def by_grade(self) -> DataFrame:
        return series_by_group(self.summary, "nom_ie", "grado", size="n_estudiantes", mean="porcentaje_promedio")

    def release(self) -> None:
        self.summary.unpersist()


def student_reports(evaluations: DataFrame, *, order: str) -> StudentReports:
    """Reports of the summary, which is worked out once and kept until ``release``."""
    return StudentReports(keep(student_summary(evaluations, order=order)))


def programme_schools(history: DataFrame, programme: str = "QM", label: str = "SI") -> DataFrame:
    """Schools in a programme by number of history rows."""
    return value_counts(history.where(as_column(programme) == label), "Nombre_IE")
