"""Fitted models as column expressions, so that a prediction can stand inside a fold.

A linear model is an array of numbers. Trees are arrays of split features and thresholds in the
order of a complete binary tree: from place n the walk goes on to 2n + 1 or 2n + 2, so a
prediction is a fold over the depth.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TREES = "array<struct<f: array<int>, t: array<double>, v: array<double>>>"


@dataclass(frozen=True)
class LinearFit:
    """A fitted linear model."""

    coefficients: tuple[float, ...]
    intercept: float


@dataclass(frozen=True)
class Scorer:
    """``columns`` go beside each row; ``sql`` makes a prediction of an array of features."""

    columns: Mapping[str, Column]
    sql: Callable[[str], str]


def numbers(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")


def linear_scorer(name: str, size: int, values: Column) -> Scorer:
    """``values`` holds the intercept, then a coefficient for each of ``size`` features."""
    model = f"_model_{name}"

    def sql(features: str) -> str:
        terms = [f"{model}[{k + 1}] * {features}[{k}]" for k in range(size)]
        return " + ".join([f"{model}[0]", *terms])

    return Scorer({model: values}, sql)


def _walk(features: str, tree: str, depth: int) -> str:
    """SQL for the leaf that the features reach, counted in its level."""
    step = f"2 * n + if({features}[{tree}.f[n]] <= {tree}.t[n], 1, 2)"
    return f"aggregate(sequence(1, {depth}), 0, (n, k) -> {step}) - {2**depth - 1}"


def tree_scorer(name: str, trees: Sequence[tuple[float, list]], depth: int) -> Scorer:
    """``trees`` are pairs of a weight and the lines of a printed tree."""
    model = f"_model_{name}"
    made = [_complete(lines, depth, weight) for weight, lines in trees]
    held = F.from_json(F.lit(json.dumps(made)), _TREES)
    leaf = _walk("{f}", "tree", depth) if depth else "0"

    def sql(features: str) -> str:
        own = leaf.replace("{f}", features)
        return f"aggregate({model}, 0D, (total, tree) -> total + tree.v[{own}])"

    return Scorer({model: held}, sql)


# The lines of a printed tree.
_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")
_LEAF = re.compile(r"Predict: (\S+)")
_HEAD = re.compile(r"Tree \d+ \(weight (\S+)\):")


def _printed(model: Model) -> list[tuple[float, list[str]]]:
    """Weight and lines of every tree; a single tree has a weight of one."""
    found: list[tuple[float, list[str]]] = []
    lines = model.toDebugString.strip().splitlines()
    if not any(_HEAD.search(line) for line in lines):
        return [(1.0, [line.strip() for line in lines[1:]])]
    for line in lines[1:]:
        if head := _HEAD.search(line):
            found.append((float(head[1]), []))
        else:
            found[-1][1].append(line.strip())
    return found


def _complete(lines: list[str], depth: int, weight: float) -> dict:
    """A tree as a complete one of ``depth``: a leaf further up fills all places below it."""
    inner = 2**depth - 1
    feature, threshold, value = [0] * inner, [0.0] * inner, [0.0] * (inner + 1)
    rest = iter(lines)

    def fill(place: int, level: int) -> None:
        line = next(rest)
        if leaf := _LEAF.match(line):
            first = (place + 1) * 2 ** (depth - level) - 1 - inner
            value[first : first + 2 ** (depth - level)] = [weight * float(leaf[1])] * 2 ** (depth - level)
            return
        split = _SPLIT.match(line)
        if not split:
            raise ValueError(f"Not a split on a number: {line!r}")
        feature[place], threshold[place] = int(split[1]), float(split[2])
        fill(2 * place + 1, level + 1)
        if not next(rest).startswith("Else"):
            raise ValueError("A split without a second branch")
        fill(2 * place + 2, level + 1)

    fill(0, 0)
    return {"f": feature, "t": threshold, "v": value}


def scorer(name: str, model: Model | LinearFit) -> Scorer | None:
    """The model as an expression; None for a kind that has none here."""
    if hasattr(model, "coefficients") and hasattr(model, "intercept"):
        values = [float(v) for v in model.coefficients]
        return linear_scorer(name, len(values), numbers([float(model.intercept), *values]))
    if "Regression" in type(model).__name__ and hasattr(model, "toDebugString"):
        trees = _printed(model)
        if type(model).__name__ == "RandomForestRegressionModel":
            trees = [(w / len(trees), lines) for w, lines in trees]
        depth = max(t.depth for t in getattr(model, "trees", [model]))
        return tree_scorer(name, trees, depth)
    return None


# --- Least squares ----------------------------------------------------------------


def least_squares(
    matrix: DataFrame, features: Sequence[str], target: str, penalties: Mapping[str, float], by: str | None = None
) -> dict:
    """A ``LinearFit`` for each penalty, in one aggregate: ``{penalty name: fit}``, or
    with ``by`` a dictionary of those by its values.

    Means and covariances merge, so every task sends a few numbers for each value of ``by``. Rows with a
    missing feature teach nothing; values of ``by`` without rows are not in the result.
    ``penalty`` weighs the squares of the coefficients on features of unit variance, in units of the
    target's deviation.
    """
    names = [f"x{k}" for k in range(len(features))]
    rows = matrix.select(
        *([F.col(by).alias("_by")] if by else []),
        F.col(target).cast("double").alias("z"),
        *[F.expr(f).cast("double").alias(n) for f, n in zip(features, names, strict=True)],
    )
    known = rows.dropna(subset=["z", *names])
    every = [*names, "z"]
    means = [F.avg(c).alias(f"m_{c}") for c in every]
    products = [
        F.covar_pop(a, b).alias(f"c_{a}_{b}") for k, a in enumerate(every) for b in every[k:]
    ]
    total = F.count(F.lit(1)).alias("n")
    grouped = known.groupBy(*(["_by"] if by else []))
    found = {r["_by"] if by else None: r for r in grouped.agg(total, *means, *products).collect() if r["n"]}
    fits = {key: _solved(r, names, penalties) for key, r in found.items()}
    return fits if by else fits.get(None, {})


def _solved(r, names: Sequence[str], penalties: Mapping[str, float]) -> dict[str, LinearFit]:
    p = len(names)
    covariance = np.array(
        [[r[f"c_{names[min(i, j)]}_{names[max(i, j)]}"] for j in range(p)] for i in range(p)], float
    ).reshape(p, p)
    along = np.array([r[f"c_{n}_z"] for n in names], float)
    mean = np.array([r[f"m_{n}"] for n in names], float)
    # On features of unit variance; a constant one has no effect.
    scale = np.sqrt(np.maximum(np.diag(covariance), 0))
    used = scale > 1e-12 * np.maximum(np.abs(mean), 1e-300)
    deviation = np.sqrt(max(r["c_z_z"], 0))
    out = {}
    for name, penalty in penalties.items():
        beta = np.zeros(p)
        if used.any() and deviation > 0:
            unit = covariance[np.ix_(used, used)] / np.outer(scale[used], scale[used])
            ridge = unit + penalty / deviation * np.eye(used.sum())
            beta[used] = np.linalg.lstsq(ridge, along[used] / scale[used], rcond=1e-12)[0] / scale[used]
        out[name] = LinearFit(tuple(beta.tolist()), float(r["m_z"] - beta @ mean))
    return out
