"""Preprocessing recipes: declared once, learned on training rows, applied anywhere.

Learning runs one aggregate per step that needs statistics; applying a fitted
recipe is a single projection without any shuffle.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from . import columns
from .factors import MAX_LEVELS, level_lists
from .profile import one_pass


def yeo_johnson(col: Column, lam: Column | float) -> Column:
    """Yeo-Johnson power transform with a fixed parameter."""
    x = col.cast("double")
    if isinstance(lam, Column):
        near0, near2 = F.abs(lam) < 1e-3, F.abs(lam - 2) < 1e-3
        upper = F.when(near0, F.log1p(x)).otherwise(F.try_divide(F.pow(x + 1, lam) - 1, lam))
        lower = F.when(near2, -F.log1p(-x)).otherwise(-F.try_divide(F.pow(1 - x, 2 - lam) - 1, 2 - lam))
    else:
        upper = F.log1p(x) if abs(lam) < 1e-3 else (F.pow(x + 1, F.lit(lam)) - 1) / F.lit(lam)
        lower = -F.log1p(-x) if abs(lam - 2) < 1e-3 else -(F.pow(1 - x, F.lit(2 - lam)) - 1) / F.lit(2 - lam)
    return F.when(x >= 0, upper).when(x < 0, lower)


def fit_yeo_johnson(
    df: DataFrame, names: Sequence[str], low: float = -5.0, high: float = 5.0, points: int = 21, rounds: int = 4
) -> dict[str, float]:
    """Parameter of each column that maximises the profile log-likelihood.

    Every round scores a grid of parameters for all columns in one aggregate
    and narrows the grid around the best point, so the data are read once per
    round however many columns there are. Constant columns keep 1 (no change).
    """
    spans = {n: (low, high) for n in names}
    best = {n: 1.0 for n in names}
    for _ in range(rounds if names else 0):
        grids = {n: [a + (b - a) * i / (points - 1) for i in range(points)] for n, (a, b) in spans.items()}
        stats: dict[str, Column] = {}
        for n in names:
            x = F.col(n).cast("double")
            stats[f"j_{n}"] = F.avg(F.signum(x) * F.log1p(F.abs(x)))
            for i, lam in enumerate(grids[n]):
                stats[f"v_{n}_{i}"] = F.var_pop(yeo_johnson(x, lam))
        row = one_pass(df, stats).first()
        for n in names:
            scores = []
            for i, lam in enumerate(grids[n]):
                v = row[f"v_{n}_{i}"]
                if v is not None and v > 0 and math.isfinite(v):
                    scores.append((-0.5 * math.log(v) + (lam - 1) * row[f"j_{n}"], lam))
            if scores:
                best[n] = max(scores)[1]
                step = (spans[n][1] - spans[n][0]) / (points - 1)
                spans[n] = (max(low, best[n] - step), min(high, best[n] + step))
    return best


def dummy_name(column: str, level: str) -> str:
    """``column_level`` with every character that a name cannot hold replaced."""
    return f"{column}_" + "".join(ch if ch.isalnum() else "_" for ch in level)


class Recipe:
    """Declared steps. ``ids`` take no part in any step unless named."""

    def __init__(self, outcome: str, ids: Sequence[str] = ()):
        self.outcome, self.ids = outcome, tuple(ids)
        self.steps: list[tuple[str, dict]] = []

    def _add(self, kind: str, **options) -> Recipe:
        out = Recipe(self.outcome, self.ids)
        out.steps = [*self.steps, (kind, options)]
        return out

    def predictors(self, df: DataFrame) -> list[str]:
        return columns.excluding(df, [self.outcome, *self.ids])

    # -- steps ---------------------------------------------------------------

    def drop_constant(self) -> Recipe:
        """Remove predictors with fewer than two distinct values."""
        return self._add("constant")

    def remove(self, *names: str) -> Recipe:
        return self._add("remove", names=list(names))

    def as_category(self, *names: str) -> Recipe:
        """Numbers that are codes become categories."""
        return self._add("category", names=list(names))

    def power_transform(self, names: Sequence[str], lambdas: dict[str, float] | None = None) -> Recipe:
        """Yeo-Johnson with fitted (or given) parameters."""
        return self._add("power", names=list(names), lambdas=lambdas)

    def center(self, *names: str) -> Recipe:
        return self._add("center", names=list(names))

    def scale(self, *names: str) -> Recipe:
        """Divide by the sample standard deviation."""
        return self._add("scale", names=list(names))

    def normalise(self, *names: str) -> Recipe:
        """Center and scale with one aggregate."""
        return self._add("normalise", names=list(names))

    def dummies(self, *names: str, outcome: bool = False) -> Recipe:
        """0/1 columns for every level but the first one."""
        return self._add("dummies", names=list(names), outcome=outcome)

    def date_parts(self, name: str, features: Sequence[str] = ("dow", "month")) -> Recipe:
        return self._add("date_parts", name=name, features=list(features))

    def holidays(self, name: str, holidays: Sequence[str] = dates.US_HOLIDAYS) -> Recipe:
        return self._add("holidays", name=name, holidays=list(holidays))

    def safe_names(self) -> Recipe:
        return self._add("safe_names")

    # -- learning ------------------------------------------------------------

    def fit(self, train: DataFrame) -> FittedRecipe:
        """Learn all steps on training rows, each on the result of the one before."""
        learned: list[tuple[str, dict]] = []
        current = train
        for kind, options in self.steps:
            learn = getattr(self, f"_learn_{kind}", None)
            state = learn(current, **options) if learn else dict(options)
            learned.append((kind, state))
            current = _apply(current, kind, state)
        return FittedRecipe(self.outcome, self.ids, learned)

    def _learn_constant(self, df):
        names = self.predictors(df)
        stats = {n: F.min(n) < F.max(n) for n in names}
        row = one_pass(df, stats).first()
        return {"names": [n for n in names if not row[n]]}

    def _numbers(self, df, names):
        """Named columns, or every numeric column that is not an identifier."""
        return list(names) or [c for c in columns.numeric(df) if c not in self.ids]

    def _learn_power(self, df, names, lambdas):
        return {"lambdas": dict(lambdas) if lambdas else fit_yeo_johnson(df, names)}

    def _learn_center(self, df, names):
        names = self._numbers(df, names)
        row = one_pass(df, {n: F.avg(F.col(n).cast("double")) for n in names}).first()
        return {"mean": {n: row[n] for n in names}}

    def _learn_scale(self, df, names):
        names = self._numbers(df, names)
        row = one_pass(df, {n: F.stddev_samp(F.col(n).cast("double")) for n in names}).first()
        return {"sd": {n: row[n] for n in names}}

    def _learn_normalise(self, df, names):
        names = self._numbers(df, names)
        stats = {f"m_{n}": F.avg(F.col(n).cast("double")) for n in names}
        stats |= {f"s_{n}": F.stddev_samp(F.col(n).cast("double")) for n in names}
        row = one_pass(df, stats).first()
        return {"mean": {n: row[f"m_{n}"] for n in names}, "sd": {n: row[f"s_{n}"] for n in names}}

    def _learn_dummies(self, df, names, outcome):
        if not names:
            names = [c for c in columns.textual(df) if c not in self.ids and (outcome or c != self.outcome)]
        return {"levels": level_lists(df, names, MAX_LEVELS)}


class FittedRecipe:
    """Learned steps; ``bake`` is a projection."""

    def __init__(self, outcome: str, ids: Sequence[str], steps: list[tuple[str, dict]]):
        self.outcome, self.ids, self.steps = outcome, tuple(ids), steps

    def bake(self, df: DataFrame) -> DataFrame:
        for kind, state in self.steps:
            df = _apply(df, kind, state)
        return df

    def predictors(self, baked: DataFrame) -> list[str]:
        """Numeric columns a model may use after baking."""
        gone = (self.outcome, *self.ids)
        own = [c for c in columns.numeric(baked) if c not in gone]
        return [c for c in own if not c.startswith(f"{self.outcome}_")]

    def learned(self, spark) -> DataFrame:
        """Everything that was learned, as rows ``(step, kind, statistic, column, value)``."""
        rows = []
        for i, (kind, state) in enumerate(self.steps, 1):
            for stat, content in state.items():
                if isinstance(content, dict):
                    rows += [(i, kind, stat, c, json.dumps(v)) for c, v in content.items()]
                elif isinstance(content, list):
                    rows += [(i, kind, stat, str(c), None) for c in content]
        return spark.createDataFrame(rows, "step int, kind string, statistic string, column string, value string")

    def to_json(self) -> str:
        return json.dumps({"outcome": self.outcome, "ids": list(self.ids), "steps": self.steps})

    @classmethod
    def from_json(cls, text: str) -> FittedRecipe:
        d = json.loads(text)
        return cls(d["outcome"], d["ids"], [(k, s) for k, s in d["steps"]])


def _apply(df: DataFrame, kind: str, state: dict) -> DataFrame:
    if kind in ("constant", "remove"):
        return df.drop(*state["names"])
    if kind == "category":
        return columns.over(df, state["names"], lambda c: c.cast("string"))
    if kind == "power":
        return df.withColumns({n: yeo_johnson(F.col(n), lam) for n, lam in state["lambdas"].items()})
    if kind in ("center", "scale", "normalise"):
        mean, sd = state.get("mean", {}), state.get("sd", {})
        out = {}
        for n in {**mean, **sd}:
            x = F.col(n).cast("double")
            x = x - F.lit(mean[n]) if mean.get(n) is not None else x
            out[n] = F.try_divide(x, F.lit(sd[n])) if sd.get(n) is not None else x
        return df.withColumns(out)
    if kind == "dummies":
        new = []
        for n, levels in state["levels"].items():
            known = F.col(n).cast("string").isin(levels) if levels else F.lit(False)
            for level in levels[1:]:
                hit = (F.col(n).cast("string") == level).cast("double")
                new.append(F.when(known, hit).alias(dummy_name(n, level)))
        return df.select(*columns.excluding(df, state["levels"]), *new)
    if kind == "date_parts":
        n = state["name"]
        made = {"dow": dates.weekday_label, "month": dates.month_label, "year": lambda c: F.year(c).cast("string")}
        return df.withColumns({f"{n}_{f}": made[f](F.col(n)) for f in state["features"]})
    if kind == "holidays":
        n = state["name"]
        flags = dates.holiday_flags(F.col(n), state["holidays"])
        return df.withColumns({f"{n}_{h}": c for h, c in flags.items()})
    if kind == "safe_names":
        return columns.safe_names(df)
    raise ValueError(f"unknown step {kind!r}")
