"""Search-space parameters as Column expressions (HPO-1, HPO-2, HPO-3).

Draws are a pure function of (seed, trial number, parameter name): the first
13 hex digits of ``md5("seed:trial:param")`` divided by 2**52 give a uniform
``u`` in [0, 1). They never depend on partitioning (``rand(seed)`` does), so a
trial table is the same on 1 or 1000 executors, and the same text runs in
DuckDB for the oracle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = float(2 ** 52)
LOG_DIGITS = 9


def unit_draw(seed: int, trial_no: Column, param: str) -> Column:
    key = F.concat_ws(":", F.lit(str(seed)), trial_no.cast("string"), F.lit(param))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(TWO_POW_52)


def unit_draw_sql(seed: int, trial_no_sql: str, param: str) -> str:
    key = f"concat_ws(':', '{seed}', CAST({trial_no_sql} AS VARCHAR), '{param}')"
    return f"(CAST(('0x' || substr(md5({key}), 1, 13)) AS BIGINT) / {TWO_POW_52!r})"


@dataclass(frozen=True)
class Uniform:
    """Continuous value drawn uniformly from [min, max]."""
    min: float
    max: float
    kind: str = field(default="uniform", init=False)

    def __post_init__(self):
        if not self.min < self.max:
            raise ValueError(f"uniform needs min < max, got {self.min}, {self.max}")

    def from_unit(self, u: Column) -> Column:
        return F.lit(float(self.min)) + F.lit(float(self.max - self.min)) * u

    def from_unit_sql(self, u: str) -> str:
        return f"({float(self.min)!r} + {float(self.max - self.min)!r} * {u})"

    def grid_point(self, i: Column, points: int) -> Column:
        step = (float(self.max) - float(self.min)) / (points - 1)
        return F.lit(float(self.min)) + i.cast("double") * F.lit(step)

    def grid_point_sql(self, i: str, points: int) -> str:
        step = (float(self.max) - float(self.min)) / (points - 1)
        return f"({float(self.min)!r} + CAST({i} AS DOUBLE) * {step!r})"


@dataclass(frozen=True)
class LogUniform:
    """Continuous value whose logarithm is uniform on [ln min, ln max]; min > 0."""
    min: float
    max: float
    kind: str = field(default="loguniform", init=False)

    def __post_init__(self):
        if not 0 < self.min < self.max:
            raise ValueError(f"loguniform needs 0 < min < max, got {self.min}, {self.max}")

    @property
    def _lo(self) -> float:
        return math.log(self.min)

    @property
    def _span(self) -> float:
        return math.log(self.max) - math.log(self.min)

    def from_unit(self, u: Column) -> Column:
        return F.round(F.exp(F.lit(self._lo) + u * F.lit(self._span)), LOG_DIGITS)

    def from_unit_sql(self, u: str) -> str:
        return f"round(exp({self._lo!r} + {u} * {self._span!r}), {LOG_DIGITS})"

    def grid_point(self, i: Column, points: int) -> Column:
        step = self._span / (points - 1)
        return F.round(F.exp(F.lit(self._lo) + i.cast("double") * F.lit(step)), LOG_DIGITS)

    def grid_point_sql(self, i: str, points: int) -> str:
        step = self._span / (points - 1)
        return f"round(exp({self._lo!r} + CAST({i} AS DOUBLE) * {step!r}), {LOG_DIGITS})"


@dataclass(frozen=True)
class Choice:
    """Categorical value; like the reference, every value is carried as a string."""
    values: tuple
    kind: str = field(default="choice", init=False)

    def __post_init__(self):
        if not self.values:
            raise ValueError("choice needs at least one value")
        object.__setattr__(self, "values", tuple(str(v) for v in self.values))

    def _arr(self) -> Column:
        return F.array(*[F.lit(v) for v in self.values])

    def _arr_sql(self) -> str:
        return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in self.values) + "]"

    def from_unit(self, u: Column) -> Column:
        return F.element_at(self._arr(), (F.floor(u * len(self.values)) + 1).cast("int"))

    def from_unit_sql(self, u: str) -> str:
        return f"({self._arr_sql()})[CAST(floor({u} * {len(self.values)}) AS INTEGER) + 1]"

    def grid_point(self, i: Column, points: int | None = None) -> Column:
        return F.element_at(self._arr(), (i + 1).cast("int"))

    def grid_point_sql(self, i: str, points: int | None = None) -> str:
        return f"({self._arr_sql()})[CAST({i} AS INTEGER) + 1]"


def uniform(min: float, max: float) -> Uniform:  # noqa: A002 - mirrors the reference's names
    return Uniform(min, max)


def loguniform(min: float, max: float) -> LogUniform:  # noqa: A002
    return LogUniform(min, max)


def choice(values) -> Choice:
    return Choice(tuple(values))
