"""Local explanations: how single predictions depend on the features around one case.

For every case many perturbed rows are drawn from the distribution of the
training rows, scored by the model, weighted by nearness, and a small weighted
linear fit of the score on "same bin as the case" gives the feature weights.
Draws are functions of case, draw number and feature, so a repeated task draws
the same rows. Only one matrix of cross sums per case reaches the solver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import case_when, half_even
from ..functions.steps import how_many_reached
from ..sources.tables import hash_uniform
from .factors import level_lists
from .gram import cross_sums, ridge, unpack
from .quantiles import quantiles
from .reshape import widen

_CHUNK = 500  # perturbed rows made by one task from one input row


@dataclass
class Explainer:
    """Bins of numeric features (edges and shares) and shares of categorical levels."""

    edges: dict[str, list[float]]
    shares: dict[str, list[float]]
    levels: dict[str, list[str]]

    @property
    def features(self) -> list[str]:
        return [*self.edges, *self.levels]

    def bin_of(self, name: str, value: Column) -> Column:
        """Bin number from 0, missing for a missing value; a border belongs to the lower bin."""
        if name in self.levels:
            return F.array_position(F.array(*[F.lit(v) for v in self.levels[name]]), value.cast("string")).cast("int") - 1
        return F.when(value.isNotNull(), how_many_reached(self.edges[name][1:-1], value, strictly=True))

    def descriptions(self, name: str) -> list[str]:
        if name in self.levels:
            return [f"{name} = {v}" for v in self.levels[name]]
        e = self.edges[name]
        if len(e) <= 2:
            return [f"{name} <= {e[-1]:g}"]
        middle = [f"{a:g} < {name} <= {b:g}" for a, b in zip(e[1:-2], e[2:-1])]
        return [f"{name} <= {e[1]:g}", *middle, f"{e[-2]:g} < {name}"]


def explainer_table(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), n_bins: int = 4) -> DataFrame:
    """Bins ``(feature, bin, lower, upper, level, n, share)`` of the fitted explainer.

    Numeric features are cut at their quantiles, text features have one bin per level. Rows with a missing value
    belong to no bin and do not enter the shares.
    """
    x, counts = _fitted(train, numeric, categorical, n_bins)
    rows = []
    for name in x.features:
        size = len(x.shares[name])
        bounds = [(None, None)] * size if name in x.levels else list(zip(x.edges[name][:-1], x.edges[name][1:]))
        texts = x.levels.get(name, [None] * size)
        rows += [(name, i, *bounds[i], texts[i], counts.get((name, i), 0), x.shares[name][i]) for i in range(size)]
    kinds = "feature string, bin int, lower double, upper double, level string, n long, share double"
    return train.sparkSession.createDataFrame(rows, kinds)


def _fit_edges(train: DataFrame, numeric: Sequence[str], n_bins: int) -> dict[str, list[float]]:
    probs = [i / n_bins for i in range(n_bins + 1)]
    found = quantiles(train, list(numeric), probs).collect()  # features x bins numbers
    edges = {n: sorted({r["value"] for r in found if r["key"] == n}) for n in numeric}
    return {n: (v if len(v) > 1 else [v[0], v[0]]) for n, v in edges.items()}


def fit_explainer(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), n_bins: int = 4) -> Explainer:
    """Learn bins, bin shares, levels and level shares from the training rows."""
    return _fitted(train, numeric, categorical, n_bins)[0]


def _fitted(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], n_bins: int):
    """The explainer and the rows of its bins; missing values are in none."""
    out = Explainer(_fit_edges(train, numeric, n_bins), {}, level_lists(train, list(categorical)))
    cells = [
        F.struct(F.lit(n).alias("f"), out.bin_of(n, F.col(n)).alias("b")) for n in out.features
    ]
    counts = train.select(F.inline(F.array(*cells))).groupBy("f", "b").agg(F.count(F.lit(1)).alias("n"))
    found = {(r["f"], r["b"]): r["n"] for r in counts.collect()}  # features x bins numbers
    for name in out.features:
        size = len(out.levels[name]) if name in out.levels else len(out.edges[name]) - 1
        n = [found.get((name, b), 0) for b in range(size)]
        out.shares[name] = [v / max(sum(n), 1) for v in n]
    return out, found


def _draw_bin(shares: Sequence[float], u: Column) -> Column:
    return how_many_reached(np.cumsum(shares)[:-1].tolist(), u)


def perturb(cases: DataFrame, key: str, explainer: Explainer, n_permutations: int, seed: int) -> DataFrame:
    """Drawn rows around each case; draw 1 is the case itself.

    Features are replaced by drawn values, ``__z<i>`` tells whether the draw
    lies in the bin of the case. A missing value is a bin of its own that only
    the case itself has.
    """
    chunks = -(-n_permutations // _CHUNK)
    spread = cases.withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    spread = spread.repartition(F.col(key), F.col("__chunk"))
    last = F.least((F.col("__chunk") + 1) * _CHUNK, F.lit(n_permutations))
    drawn = spread.withColumn("__draw", F.explode(F.sequence(F.col("__chunk") * _CHUNK + 1, last)))
    original = F.col("__draw") == 1
    values = {}
    for i, name in enumerate(explainer.features):
        u = hash_uniform(F.col(key), F.col("__draw"), F.lit(2 * i), F.lit(seed))
        own = explainer.bin_of(name, F.col(name))
        bin_drawn = F.when(original, own).otherwise(_draw_bin(explainer.shares[name], u))
        values[f"__z{i}"] = bin_drawn.eqNullSafe(own).cast("double")
        if name in explainer.levels:
            new = F.get(F.array(*[F.lit(v) for v in explainer.levels[name]]), bin_drawn)
        else:
            edges = F.array(*[F.lit(float(e)) for e in explainer.edges[name]])
            v = hash_uniform(F.col(key), F.col("__draw"), F.lit(2 * i + 1), F.lit(seed))
            low, high = F.get(edges, bin_drawn), F.get(edges, bin_drawn + 1)
            new = low + v * (high - low)
        values[f"__v{i}"] = F.when(original, F.col(name)).otherwise(new)
    out = drawn.withColumns(values)
    renamed = {name: F.col(f"__v{i}") for i, name in enumerate(explainer.features)}
    return out.withColumns(renamed).drop(*[f"__v{i}" for i in range(len(renamed))])


EXPLANATION = (
    "case string, label string, label_prob double, model_r2 double, model_intercept double, model_prediction double, "
    "feature string, feature_value string, feature_weight double, feature_desc string, prediction double"
)


def explain(
    cases: DataFrame,
    key: str,
    explainer: Explainer,
    score: Callable[[DataFrame], DataFrame],
    n_features: int = 8,
    n_permutations: int = 5000,
    kernel_width: float = 0.5,
    labels: tuple[str, str] = ("No", "Yes"),
    penalty: float = 1e-3,
    seed: int = 17,
) -> DataFrame:
    """One row per case and chosen feature.

    ``score`` adds a column ``score`` (probability of the second label) and
    keeps all other columns. The more probable label of each case is explained.
    Nearness is ``exp(-(d / width)^2)`` where ``d`` is the share of features
    outside the bin of the case.
    """
    names = explainer.features
    no, yes = labels
    first = score(cases.select(key, *names)).select(key, *names, F.col("score").alias("__p"))
    first = first.withColumns(
        {
            "__label": F.when(F.col("__p") >= 0.5, yes).otherwise(no),
            "__prob": F.greatest("__p", 1 - F.col("__p")),
            "__bins": F.array(*[explainer.bin_of(n, F.col(n)) for n in names]),
            "__values": F.array(*[F.col(n).cast("string") for n in names]),
        }
    )
    drawn = score(perturb(first, key, explainer, n_permutations, seed))
    z = [f"__z{i}" for i in range(len(names))]
    inside = sum((F.col(c) for c in z[1:]), F.col(z[0])) / F.lit(float(len(z)))
    far = 1 - inside
    near = F.exp(-(far * far) / F.lit(float(kernel_width) ** 2))
    target = F.when(F.col("__label") == yes, F.col("score")).otherwise(1 - F.col("score"))
    sums = (
        drawn.select(key, *z, "__label", "__prob", "__bins", "__values", near.alias("__w"), target.alias("__y"))
        .groupBy(key)
        .agg(
            *cross_sums(z, "__y", F.col("__w")),
            *[F.first(c).alias(c) for c in ("__label", "__prob", "__bins", "__values")],
        )
        .withColumn("__case", F.col(key).cast("string"))
        .drop(key)
    )
    texts = [explainer.descriptions(n) for n in names]
    width = len(names) + 1

    def solve(batches):
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                xx, xy = unpack(r["xx"], width), np.asarray(r["xy"])
                beta, _ = ridge(xx, xy, r["yy"], penalty)
                chosen = sorted(np.argsort(-np.abs(beta[1:]), kind="stable")[:n_features])
                at = [0, *[i + 1 for i in chosen]]
                beta, r2 = ridge(xx[np.ix_(at, at)], xy[at], r["yy"], penalty)
                prediction = float(beta.sum())
                for weight, i in zip(beta[1:], chosen):
                    bin_at = r["__bins"][i]
                    if bin_at is None or bin_at != bin_at:
                        text = f"{names[i]} missing"
                    else:
                        text = texts[i][int(bin_at)] if 0 <= bin_at < len(texts[i]) else names[i]
                    rows.append(
                        (r["__case"], r["__label"], r["__prob"], r2, float(beta[0]), prediction, names[i],
                         r["__values"][i], float(weight), text, r["__prob"])
                    )
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in EXPLANATION.split(", ")])

    return sums.mapInPandas(solve, EXPLANATION)


def case_view(explanation: DataFrame, case: str) -> DataFrame:
    """Features of one case with the direction of their weight and the rounded fit."""
    return explanation.filter(F.col("case") == case).select(
        "feature_desc",
        "feature_weight",
        case_when([(F.col("feature_weight") > 0, "Supports")], "Contradicts").alias("direction"),
        "label",
        half_even(F.col("label_prob"), 2).alias("probability"),
        half_even(F.col("model_r2"), 2).alias("explanation_fit"),
    )


def heat_map(explanation: DataFrame) -> DataFrame:
    """Case x feature table in drawing order: features by name and value, cases by number."""
    number = F.col("case").try_cast("double")
    value = F.col("feature_value").try_cast("double")
    return explanation.select("case", "label", "feature", "feature_value", "feature_desc", "feature_weight").orderBy(
        "feature", value.asc_nulls_last(), "feature_value", number.asc_nulls_last(), "case"
    )


def heat_map_wide(explanation: DataFrame, cases: Sequence[str]) -> DataFrame:
    """One column per listed case."""
    return widen(explanation, ["feature_desc"], "case", "feature_weight", cases)
