"""Whitening of embeddings over their distinct vectors.

Vectors are put on a grid of integers, so that equal ones can be grouped exactly. Each distinct
vector is fitted once, with a weight of one or its number of rows: sums, then the products of
centred vectors, task by task as matrix products that Spark adds up. The driver sees one matrix
of the vectors' size. Each distinct vector is whitened once and joined back to its rows; a
vector that holds more than a thousandth of them is broadcast, at most a thousand of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandpanel.sources.checkpoints import written

SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this (in grid steps) are put at it: doubles are whole up to here.
FARTHEST = 1 << 52
COMPONENTS = 16
#: A vector of more rows than one in HEAVY is joined by broadcast: there are at most so many.
HEAVY = 1000
#: Eigenvalues below this share of the largest are rounding: such components are not whitened.
NOTHING = 1e-12
#: Vectors that are multiplied at once.
AT_ONCE = 4096

_LOW = 1 << 26


class Model(NamedTuple):
    """The fit of the vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray  # a unit eigenvector in each column, by falling eigenvalue
    explained: np.ndarray


def usable(vector: Column) -> Column:
    """Not null, and without entries that are null, infinite or not a number."""
    bad = F.exists(
        vector,
        lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")),
    )
    return vector.isNotNull() & ~bad


def on_grid(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """``floor(scale * c) + shift`` of every entry, as a double first and then a long."""

    def step(c: Column) -> Column:
        wide = F.least(F.greatest(c.cast("double") * scale, F.lit(-float(FARTHEST))), F.lit(float(FARTHEST)))
        return F.floor(wide).cast("long") + shift

    return F.transform(vector, step)


def distinct_vectors(rows: DataFrame, x: str = "x") -> DataFrame:
    """``x, copies``: equal vectors once, added up in each task before they are shuffled."""
    return rows.groupBy(F.col(x).alias("x")).agg(F.count(F.lit(1)).alias("copies"))


def _matrices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """The vectors of a batch as matrices, one for each length of at least 1, and their rows."""
    for batch in batches:
        for lo in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(lo, AT_ONCE)
            vectors = part.column(column)
            size = np.diff(vectors.offsets.to_numpy())
            for d in np.unique(size[size > 0]).tolist():
                some = part if (size == d).all() else part.filter(pa.array(size == d))
                flat = some.column(column).flatten().to_numpy(zero_copy_only=False)
                yield flat.reshape(-1, d), some


def _weight(part: pa.RecordBatch, weights: str) -> np.ndarray:
    copies = part.column("copies").to_numpy()
    return copies if weights == "count" else np.ones_like(copies)


def _sums(vectors: DataFrame, weights: str) -> dict[int, tuple[int, list[int]]]:
    """Total weight and exact sums of every entry, by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for x, part in _matrices(batches, "x"):
            w = _weight(part, weights)
            high, low = np.divmod(x, _LOW)  # so that no sum of a batch overflows
            add = [int(a) * _LOW + int(b) for a, b in zip(w @ high, w @ low, strict=True)]
            n, total = found.get(x.shape[1], (0, [0] * x.shape[1]))
            found[x.shape[1]] = (n + int(w.sum()), [a + b for a, b in zip(total, add, strict=True)])
        for d, (n, total) in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d] * (d + 1), pa.int32()),
                    pa.array(range(d + 1), pa.int32()),
                    pa.array([Decimal(v) for v in (*total, n)], pa.decimal128(38, 0)),
                ],
                ["dim", "place", "total"],
            )

    partial = vectors.mapInArrow(run, "dim int, place int, total decimal(38,0)")
    rows = partial.groupBy("dim", "place").agg(F.sum("total").cast("decimal(38,0)").alias("total")).collect()
    out: dict[int, dict[int, int]] = {}
    for r in rows:
        out.setdefault(r["dim"], {})[r["place"]] = int(r["total"])
    return {d: (v[d], [v[k] for k in range(d)]) for d, v in out.items()}


def _covariances(
    vectors: DataFrame, centres: dict[int, np.ndarray], weights: str, total: dict[int, int], column: str = "x"
) -> dict[int, np.ndarray]:
    """Covariance of the vectors by length (that of ``column``), each centred before it is multiplied."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for x, part in _matrices(batches, column):
            centred = x - shared.value[x.shape[1]]
            product = (centred * _weight(part, weights)[:, None]).T @ centred
            found[x.shape[1]] = found.get(x.shape[1], 0) + product
        for d, product in found.items():
            row, place = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(row), d, np.int32)),
                    pa.array(row.astype(np.int32)),
                    pa.array(place.astype(np.int32)),
                    pa.array(product[row, place]),
                ],
                ["dim", "row", "place", "product"],
            )

    partial = vectors.select(column, "copies").mapInArrow(run, "dim int, row int, place int, product double")
    summed = partial.groupBy("dim", "row", "place").agg(F.sum("product").alias("product")).toArrow()
    out = {d: np.zeros((d, d)) for d in centres}
    for batch in summed.to_batches():
        dim, row, place, product = (c.to_numpy() for c in batch.columns)
        for d in np.unique(dim).tolist():
            at = dim == d
            out[d][row[at], place[at]] = out[d][place[at], row[at]] = product[at] / total[d]
    return out


def fit(vectors: DataFrame, weights: str = "one", components: int = COMPONENTS) -> dict[int, Model]:
    """Models by length of the distinct ``vectors`` (``x``, ``copies``), each vector weighing one
    or, with ``weights`` "count", its number of rows."""
    if weights not in ("one", "count"):
        raise ValueError("weights must be 'one' or 'count'")
    sums = _sums(vectors, weights)
    centres = {d: np.array([s / n for s in total]) for d, (n, total) in sums.items()}
    covariance = _covariances(vectors, centres, weights, {d: n for d, (n, _) in sums.items()})
    models = {}
    for d, (n, total) in sums.items():
        values, axes = np.linalg.eigh(covariance[d])
        values, axes = np.maximum(values[::-1][:components], 0), axes[:, ::-1][:, :components]
        sign = np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
        trace = covariance[d].trace()
        models[d] = Model(n, total, values, axes * sign, values / trace if trace > 0 else values * 0)
    return models


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """``x - sums / n``, and the exact sum of the squares of ``n * x - sums``, None beyond a long."""
    far = max(int(np.abs(x).max()) * n, *map(abs, sums)) * 2
    if far < 1 << 62:
        off = x * n - np.array(sums, np.int64)
        if int(np.abs(off).max()) ** 2 * x.shape[1] < 1 << 63:
            return off / n, (off * off).sum(1).tolist()
    exact = [[int(v) * n - s for v, s in zip(row, sums, strict=True)] for row in x]
    squares = [sum(v * v for v in row) for row in exact]
    return np.array([[v / n for v in row] for row in exact]), [s if s < 1 << 63 else None for s in squares]


def whitened(vectors: DataFrame, models: dict[int, Model]) -> DataFrame:
    """``x, copies, deviation, whitened``: every distinct vector once.

    ``whitened`` is null in components without variance. Vectors of no entry are left out.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, part in _matrices(batches, "x"):
            m = shared.value[x.shape[1]]
            centred, deviation = _deviations(x, m.n, m.sums)
            some = m.values > max(m.values[0], 0) * NOTHING
            out = np.full((len(x), len(m.values)), np.nan)
            out[:, some] = centred @ (m.axes[:, some] / np.sqrt(m.values[some]))
            flat = pa.array(out.ravel(), mask=np.isnan(out).ravel())
            offsets = np.arange(len(x) + 1, dtype=np.int32) * out.shape[1]
            yield pa.RecordBatch.from_arrays(
                [part.column("x"), part.column("copies"), pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
                ["x", "copies", "deviation", "whitened"],
            )

    kind = "x array<long>, copies long, deviation long, whitened array<double>"
    return vectors.select("x", "copies").mapInArrow(run, kind)


def identity_error(white: DataFrame, models: dict[int, Model], weights: str = "one") -> float:
    """The largest entry of the whitened vectors' covariance less the identity, in absolute value.

    Components without variance do not count; 0 if there are no others.
    """
    # By the length of x: several lengths may have the same number of components.
    worst = 0.0
    for d, m in models.items():
        k = int((m.values > max(m.values[0], 0) * NOTHING).sum())
        if not k:
            continue
        own = white.where(F.size("x") == d).select(F.slice("whitened", 1, k).alias("w"), "copies")
        w = F.col("copies").cast("double") if weights == "count" else F.lit(1.0)
        means = own.agg(*[(F.sum(F.col("w")[j] * w) / F.sum(w)).alias(f"m{j}") for j in range(k)]).first()
        found = _covariances(own, {k: np.array(list(means))}, weights, {k: m.n}, "w")[k]
        worst = max(worst, float(np.abs(found - np.eye(k)).max()))
    return worst


def whiten(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", weights: str = "one",
    components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """``vec_id, n, deviation, whitened, explained, identity_error`` for every usable row.

    Rows whose vector is null or holds null or non-finite entries are dropped; repeated rows
    and null ids stay. Vectors of different lengths are fitted apart, each among those of its
    length; those of no entry are dropped, as they have no component. ``whitened`` and ``explained`` are arrays by falling
    eigenvalue; components without variance (one distinct vector has no other) are null and explain 0. ``n`` is the
    fit's total weight, ``deviation`` the sum of squares of ``n * x`` less the sums, null if it
    passes a long. Entries of more than 2 ** 52 grid steps are put there. Other columns are not read.
    """
    rows = df.where(usable(F.col(vector)) & (F.size(vector) > 0)).select(
        F.col(vec_id).alias("vec_id"), on_grid(F.col(vector), scale, shift).alias("x")
    )
    vectors = written(distinct_vectors(rows), "vectors")
    models = fit(vectors, weights, components)
    white = written(whitened(vectors, models), "whitened")
    error = identity_error(white, models, weights)
    total = vectors.agg(F.sum("copies")).first()[0] or 0
    heavy = F.col("copies") > max(total // HEAVY, 1)
    most = F.broadcast(white.where(heavy))  # fewer than HEAVY
    common = rows.join(most, "x")
    rare = rows.join(most.select("x"), "x", "left_anti").join(white.where(~heavy), "x")
    lengths = {d: (m.n, [float(v) for v in m.explained]) for d, m in models.items()}
    told = F.create_map(
        *[
            c
            for d, (n, e) in lengths.items()
            for c in (F.lit(d), F.struct(F.lit(n).cast("long").alias("n"), F.array(*map(F.lit, e)).alias("explained")))
        ]
    ) if lengths else F.lit(None).cast("map<int,struct<n:bigint,explained:array<double>>>")
    fitted = F.element_at(told, F.size("x"))
    return common.unionByName(rare.select(*common.columns)).select(
        "vec_id", fitted["n"].alias("n"), "deviation", "whitened", fitted["explained"].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
