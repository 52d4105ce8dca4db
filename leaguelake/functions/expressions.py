"""Column expressions shared by the models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(payload: str | Column, path: str, kind: str = "string") -> Column:
    """A typed value inside a payload; null when it is absent or of another type."""
    return F.try_variant_get(payload, f"$.{path}", kind)


def fields(payload: str | Column, spec: Mapping[str, tuple[str, str]]) -> list[Column]:
    return [field(payload, path, kind).alias(name) for name, (path, kind) in spec.items()]


def ratio(numerator: Column, denominator: Column, digits: int, scale: int = 1) -> Column:
    """scale * numerator / denominator in decimals, half away from zero; null for a zero denominator.

    The quotient keeps six digits (seven for a percentage) before it is rounded to `digits`.
    """
    kept = 6 if scale == 1 else 7
    exact = (numerator * F.lit(scale)).cast("decimal(20,0)") / F.nullif(denominator, F.lit(0)).cast("decimal(18,0)")
    return F.round(exact.cast(f"decimal(38,{kept})"), digits).cast("double")


def per_game(numerator: str, games: str) -> Column:
    return ratio(F.col(numerator), F.col(games), 2)


def percentage(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator, 1, scale=100)


def one_if(condition: Column) -> Column:
    """1 where the condition holds, else 0."""
    return F.when(condition, 1).otherwise(0)


def count_when(condition: Column) -> Column:
    return F.sum(one_if(condition))


def sum_when(condition: Column, value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(condition, column).otherwise(0))


def result_of(is_home: Column, winner: Column) -> Column:
    """WIN, DRAW or LOSS seen from one side; a counted match without a winner is a LOSS for both."""
    won = (is_home & (winner == "HOME_TEAM")) | (~is_home & (winner == "AWAY_TEAM"))
    return F.when(won, "WIN").when(winner == "DRAW", "DRAW").otherwise("LOSS")


def points_of(result: Column) -> Column:
    return F.when(result == "WIN", 3).when(result == "DRAW", 1).otherwise(0).cast("long")


def season_start_year(day: Column) -> Column:
    """Seasons roll over in July: 2026-06-30 belongs to 2025, 2026-07-01 to 2026."""
    return (F.year(day) - F.when(F.month(day) < 7, 1).otherwise(0)).cast("long")


def season_label(season: Column) -> Column:
    """'2023' -> '2023/24'."""
    following = (season.cast("long") + 1).cast("string")
    return F.concat(season, F.lit("/"), F.substring(following, 3, 100))


def form_initials(form: Column) -> Column:
    """['WIN','DRAW'] -> 'WD'; anything that is neither shows as L."""
    initial = lambda r: F.when(r == "WIN", "W").when(r == "DRAW", "D").otherwise("L")
    return F.array_join(F.transform(form, initial), "")


def signed(value: Column) -> Column:
    """Goal difference as shown in a table: +3, 0, -2."""
    return F.when(value > 0, F.concat(F.lit("+"), value.cast("string"))).otherwise(value.cast("string"))


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def row_key(*parts: Column) -> Column:
    """A stable identifier: the same row gets the same id on every run."""
    return F.sha2(F.to_json(F.struct(*[p.cast("string").alias(f"k{i}") for i, p in enumerate(parts)]),
                            {"ignoreNullFields": "false"}), 256)


def bounded_message(message: Column) -> Column:
    return F.substring(message, 1, 4000)
