"""Label-by-case helpers (PRJ-11..15, FEA-05, UDF-01).  All ``when`` chains, no UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from isotherm.functions.text import ColumnOrName, _c

# Season by calendar month for each hemisphere.
NORTH_SEASONS = {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
                 6: "Summer", 7: "Summer", 8: "Summer", 9: "Autumn", 10: "Autumn", 11: "Autumn"}
SOUTH_SEASONS = {12: "Summer", 1: "Summer", 2: "Summer", 3: "Autumn", 4: "Autumn", 5: "Autumn",
                 6: "Winter", 7: "Winter", 8: "Winter", 9: "Spring", 10: "Spring", 11: "Spring"}
# Latitude-zone edges (right-closed, lowest included) and labels.
ZONE_EDGES = [0.0, 23.5, 35.0, 55.0, 90.0]
ZONE_LABELS = ["Tropical", "Subtropical", "Temperate", "Polar"]
# Climatic-season edges on the climatic month (right-closed).
CLIMATIC_SEASON_EDGES = [0, 2, 5, 8, 11, 12]
CLIMATIC_SEASON_LABELS = ["Winter", "Spring", "Summer", "Autumn", "Winter"]
# Temperature classes, upper bounds exclusive.
TEMPERATURE_CLASS_BOUNDS = [0.0, 12.0, 22.0, 30.0]
TEMPERATURE_CLASS_LABELS = ["Very cold", "Cool", "Mild", "Warm", "Hot"]
TROPIC_LATITUDE = 23.5


def hemisphere(latitude: ColumnOrName) -> Column:
    return F.when(_c(latitude) >= 0, F.lit("Northern")).when(_c(latitude) < 0, F.lit("Southern"))


def _month_map(month: Column, mapping: dict[int, str]) -> Column:
    expr = None
    for m, label in mapping.items():
        expr = (F.when(month == m, F.lit(label)) if expr is None
                else expr.when(month == m, F.lit(label)))
    return expr


def meteorological_season(month: ColumnOrName, latitude: ColumnOrName) -> Column:
    m, lat = _c(month), _c(latitude)
    return F.when(lat >= 0, _month_map(m, NORTH_SEASONS)).when(lat < 0, _month_map(m, SOUTH_SEASONS))


def climatic_month(month: ColumnOrName, latitude: ColumnOrName) -> Column:
    """Southern hemisphere is shifted by six months: ``((m + 5) mod 12) + 1``."""
    m = _c(month)
    return F.when(_c(latitude) < 0, F.pmod(m + 5, F.lit(12)) + 1).otherwise(m)


def cut_right_closed(x: ColumnOrName, edges: Sequence[float], labels: Sequence[str],
                     include_lowest: bool = False) -> Column:
    """``pandas.cut`` with right-closed bins ``(e[i], e[i+1]]``; NULL outside."""
    v = _c(x)
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = ((v >= lo) if (include_lowest and i == 0) else (v > lo)) & (v <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def latitude_zone(abs_latitude: ColumnOrName) -> Column:
    return cut_right_closed(abs_latitude, ZONE_EDGES, ZONE_LABELS, include_lowest=True)


def climatic_season(climatic_month_col: ColumnOrName) -> Column:
    return cut_right_closed(climatic_month_col, CLIMATIC_SEASON_EDGES, CLIMATIC_SEASON_LABELS)


def temperature_class(value: ColumnOrName) -> Column:
    v = _c(value)
    expr = F.when(v < TEMPERATURE_CLASS_BOUNDS[0], F.lit(TEMPERATURE_CLASS_LABELS[0]))
    for bound, label in zip(TEMPERATURE_CLASS_BOUNDS[1:], TEMPERATURE_CLASS_LABELS[1:-1]):
        expr = expr.when(v < bound, F.lit(label))
    return expr.when(v.isNotNull(), F.lit(TEMPERATURE_CLASS_LABELS[-1]))


def outlier_side(value: ColumnOrName, lower_fence: ColumnOrName) -> Column:
    return F.when(_c(value) < _c(lower_fence), F.lit("Low")).otherwise(F.lit("High"))


def seasonal_review_flag(side: ColumnOrName, season: ColumnOrName, latitude: ColumnOrName) -> Column:
    outside_tropics = F.abs(_c(latitude)) >= TROPIC_LATITUDE
    s, se = _c(side), _c(season)
    return F.coalesce(outside_tropics & (((s == "Low") & (se == "Summer")) |
                                         ((s == "High") & (se == "Winter"))), F.lit(False))


def internal_assessment(coordinate_valid: ColumnOrName, review_flag: ColumnOrName) -> Column:
    return (F.when(~F.coalesce(_c(coordinate_valid), F.lit(False)), F.lit("Invalid coordinate"))
            .when(_c(review_flag), F.lit("Review seasonal context"))
            .otherwise(F.lit("Plausible internal evidence")))


def split_label_for_year(year: ColumnOrName, train_end: int, validation_end: int) -> Column:
    """``train`` up to ``train_end``, ``validation`` up to ``validation_end``, else ``test``."""
    y = _c(year)
    return (F.when(y <= train_end, F.lit("train"))
            .when(y <= validation_end, F.lit("validation"))
            .when(y.isNotNull(), F.lit("test")))
