"""Column profile of a table: counts, moments, extremes and quartiles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUARTILES = (0.25, 0.5, 0.75)


def column_info(table: DataFrame) -> DataFrame:
    """Position, name, type and number of known values of every column.

    NaN counts as unknown, like NULL.
    """
    fields = table.schema.fields
    counts = table.agg(*[F.count(_known(f)).alias(f"n{i}") for i, f in enumerate(fields)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"n{i}").alias("non_null"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _known(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(column, F.lit(None).cast(field.dataType))
    return column


def numeric_columns(table: DataFrame) -> list[str]:
    return [f.name for f in table.schema.fields if isinstance(f.dataType, T.NumericType)]


def _number(name: str) -> Column:
    return F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double"))


def _moments(names: Sequence[str]) -> list[Column]:
    out = []
    for i, name in enumerate(names):
        number = _number(name)
        out += [
            F.count(number).alias(f"n{i}"),
            F.avg(number).alias(f"mean{i}"),
            F.stddev_samp(number).alias(f"std{i}"),
            F.min(number).alias(f"min{i}"),
            F.max(number).alias(f"max{i}"),
        ]
    return out


def _quantile_name(fraction: float) -> str:
    return f"p{fraction * 100:g}".replace(".", "_")


def approximate_profile(
    table: DataFrame,
    columns: Sequence[str] | None = None,
    fractions: Sequence[float] = QUARTILES,
    accuracy: int = 10_000,
) -> DataFrame:
    """The profile in one scan; quartiles are data values within 1/accuracy in rank."""
    names = list(columns or numeric_columns(table))
    quantiles = [
        F.percentile_approx(_number(name), list(fractions), accuracy).alias(f"q{i}")
        for i, name in enumerate(names)
    ]
    stats = table.agg(*_moments(names), *quantiles)
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"n{i}").alias("non_null"),
            F.col(f"mean{i}").alias("mean"),
            F.col(f"std{i}").alias("std"),
            F.col(f"min{i}").alias("min"),
            *[F.get(f"q{i}", F.lit(j)).alias(_quantile_name(f)) for j, f in enumerate(fractions)],
            F.col(f"max{i}").alias("max"),
        )
        for i, name in enumerate(names)
    ]
    return stats.select(F.inline(F.array(*rows)))


def profile(
    table: DataFrame,
    columns: Sequence[str] | None = None,
    fractions: Sequence[float] = QUARTILES,
    accuracy: int = 10_000,
) -> DataFrame:
    """The profile with exact, linearly interpolated quantiles.

    A plain exact percentile keeps every distinct value of a column in one
    aggregation buffer. Here each wanted rank is narrowed down instead: bounded
    sketches propose cut points, an exact count around them tells in which
    piece the rank lies, and the piece is cut again until it is one repeated
    value. Only counts and cut points reach the driver; each round is two scans
    of the profiled columns. A piece shrinks by a factor in the order of
    ``accuracy`` per round whatever the distribution, and a cut point is a value
    of the piece, so every round ends nearer: a trillion rows need three rounds.
    """
    names = list(columns or numeric_columns(table))
    # The measures only, computed once for each scan.
    table = table.select(*(F.col(f"`{name}`") for name in dict.fromkeys(names)))
    # The first scan also sketches every column, around the wanted fractions.
    around = [min(max(f + d, 0.0), 1.0) for f in fractions for d in _offsets(accuracy)]
    stats = table.agg(
        *_moments(names),
        *[F.percentile_approx(_number(c), around, accuracy).alias(f"q{i}") for i, c in enumerate(names)],
    ).first()
    known = [i for i in range(len(names)) if stats[f"n{i}"]]
    whole = {i: Piece(i, stats[f"min{i}"], True, stats[f"max{i}"], True, 0, stats[f"n{i}"]) for i in known}
    wanted = {
        (i, rank): whole[i] for i in known for f in fractions for rank in _neighbours(f, whole[i].size)
    }
    cuts = {i: set(stats[f"q{i}"]) for i in known}
    values = _values_at(table, names, wanted, cuts, accuracy)

    rows = []
    for i, name in enumerate(names):
        quantiles = []
        for f in fractions:
            if i not in whole:
                quantiles.append(None)
                continue
            n = whole[i].size
            low, high = _neighbours(f, n)
            a, b = values[i, low], values[i, high]
            quantiles.append(a if a == b else a + (b - a) * (f * (n - 1) - low))
        moments = (stats[f"{m}{i}"] for m in ("n", "mean", "std", "min"))
        rows.append((name, *moments, *quantiles, stats[f"max{i}"]))
    schema = T.StructType(
        [T.StructField("column_name", T.StringType()), T.StructField("non_null", T.LongType())]
        + [
            T.StructField(c, T.DoubleType())
            for c in ("mean", "std", "min", *map(_quantile_name, fractions), "max")
        ]
    )
    return table.sparkSession.createDataFrame(rows, schema)


def _offsets(accuracy: int) -> tuple[float, float, float]:
    return -2 / accuracy, 0.0, 2 / accuracy


def _neighbours(fraction: float, n: int) -> tuple[int, int]:
    position = fraction * (n - 1)
    return math.floor(position), math.ceil(position)


@dataclass(frozen=True)
class Piece:
    """A value interval of one column with exactly known counts."""

    column: int
    low: float
    low_included: bool
    high: float
    high_included: bool
    below: int  # values smaller than every value in the piece
    size: int  # values in the piece

    def holds(self, rank: int) -> bool:
        return self.below <= rank < self.below + self.size

    def inside(self, number: Column) -> Column:
        """The number where it lies in the piece, else NULL."""
        above = number >= self.low if self.low_included else number > self.low
        under = number <= self.high if self.high_included else number < self.high
        return F.when(above & under, number)


def _values_at(
    table: DataFrame,
    names: Sequence[str],
    wanted: dict[tuple[int, int], Piece],
    cuts: dict[int, set[float]],
    accuracy: int,
) -> dict[tuple[int, int], float]:
    """The value at each wanted (column, rank), ranks counted from zero."""
    found: dict[tuple[int, int], float] = {}
    while wanted:
        pieces = _pieces_between(table, names, wanted, cuts)
        wanted = {
            (i, rank): next(p for p in pieces[i] if p.holds(rank)) for (i, rank) in wanted
        }
        found |= {key: p.low for key, p in wanted.items() if p.low == p.high}
        wanted = {key: p for key, p in wanted.items() if key not in found}
        cuts = _new_cuts(table, names, wanted, accuracy)
    return found


def _pieces_between(table, names, wanted, cuts) -> dict[int, list[Piece]]:
    """Each cut column as consecutive pieces, every cut point a piece of its own.

    The ends of the pieces known so far are cut points too, so what lies
    outside them keeps its exact count. One scan; one group per piece.
    """
    points: dict[int, list[float]] = {}
    for i, new in cuts.items():
        ends = {e for (j, _), p in wanted.items() if j == i for e in (p.low, p.high)}
        points[i] = sorted(new | ends)
    slots = []
    for i, values in points.items():
        number = _number(names[i])
        slot = F.when(number.isNull(), None)
        for k, value in enumerate(values):
            slot = slot.when(number < value, 2 * k).when(number == value, 2 * k + 1)
        slots.append(F.struct(F.lit(i).alias("column"), slot.otherwise(2 * len(values)).alias("slot")))
    counted = table.select(F.inline(F.array(*slots))).groupBy("column", "slot").count().collect()
    counts = {(r["column"], r["slot"]): r["count"] for r in counted}

    out = {}
    for i, values in points.items():
        out[i], below = [], 0
        bounds = [-math.inf, *values, math.inf]
        for slot in range(2 * len(values) + 1):
            size = counts.get((i, slot), 0)
            at_point = slot % 2
            low = bounds[slot // 2 + at_point]
            high = low if at_point else bounds[slot // 2 + 1]
            out[i].append(Piece(i, low, bool(at_point), high, bool(at_point), below, size))
            below += size
    return out


def _new_cuts(table, names, wanted, accuracy) -> dict[int, set[float]]:
    """New cut points inside the pieces that hold wanted ranks, around these."""
    pieces: dict[Piece, list[int]] = {}
    for (_, rank), piece in wanted.items():
        pieces.setdefault(piece, []).append(rank - piece.below)
    if not pieces:
        return {}
    columns = []
    for j, (piece, places) in enumerate(pieces.items()):
        shares = [at / max(1, piece.size - 1) + d for at in places for d in _offsets(accuracy)]
        inside = piece.inside(_number(names[piece.column]))
        sketch = F.percentile_approx(inside, [min(max(s, 0.0), 1.0) for s in shares], accuracy)
        columns.append(sketch.alias(f"v{j}"))
    result = table.agg(*columns).first()
    cuts: dict[int, set[float]] = {}
    for j, piece in enumerate(pieces):
        cuts.setdefault(piece.column, set()).update(result[f"v{j}"])
    return cuts
