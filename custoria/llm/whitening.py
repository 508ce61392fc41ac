"""Whitening of embeddings from each distinct vector once.

Entries become whole numbers on a grid; rows with the same grid vector are one group, and the group's
count (or one) is its weight in the fit. Each task centres its groups and multiplies them into one
weighted Gram matrix; only these matrices, as large as the dimension, are added up. Vectors are centred at whole
numbers next to the mean, so the products are exact, and what is left of the mean is taken off exactly as well.
Each group is then projected and scaled once, and every row looks its group up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custoria.llm.common import rows_of
from custoria.session import materialize

#: Doubles hold whole numbers up to this one exactly.
EXACT = 1 << 53
#: Entries of the vectors that are worked on at a time.
BATCH = 1 << 17
ADDED = ["component", "n", "deviation", "whitened", "explained", "identity_error"]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _batches(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, BATCH // dim)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def sums(groups: DataFrame, centre: list[int], dim: int, products: bool) -> list[list[int]]:
    """Sum of ``weight * y`` with y = x - centre over groups (x, weight) and, with ``products``, below it that of
    ``weight * y y'``, as whole numbers of any size. Every task sends at most ``dim`` + 1 rows; Spark adds them up.
    """

    def part(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        y = x - np.array(centre, np.int64)
        most = int(np.abs(y).max(initial=0))
        exact = most * max(most, 1) * int(w.sum()) < EXACT
        left = y.astype(float) * w[:, None] if exact else y.astype(object) * w.astype(object)[:, None]
        rows = [left.sum(0)[None], *([left.T @ (y.astype(float) if exact else y.astype(object))] if products else [])]
        return np.vstack(rows).astype(np.int64 if exact else object).astype(object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((dim + 1 if products else 1, dim), object)
        for batch in _batches(batches, dim):
            held = held + part(_matrix(batch.column("x"), dim), batch.column("weight").to_numpy(zero_copy_only=False))
        # in digits of 30 bits, whose sums over any number of tasks fit a long
        rows = {"place": [], "digit": [], "numbers": []}
        for place, left in enumerate(held):
            digit = 0
            while any(left):
                last = all(-(1 << 31) < v < 1 << 31 for v in left)
                rows["place"].append(place)
                rows["digit"].append(digit)
                rows["numbers"].append([int(v) if last else int(v) & ((1 << 30) - 1) for v in left])
                left, digit = ([] if last else left >> 30), digit + 1
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("place", pa.int32()), ("digit", pa.int32()), ("numbers", pa.list_(pa.int64()))]))

    sent = groups.select("x", "weight").mapInArrow(run, "place int, digit int, numbers array<long>")
    sent = sent.select("place", "digit", F.posexplode("numbers").alias("at", "number")).groupBy("place", "digit", "at").agg(F.sum("number").alias("number"))
    found = [[0] * dim for _ in range(dim + 1 if products else 1)]
    for row in sent.collect():  # dim * (dim + 1) numbers of a few digits
        found[row["place"]][row["at"]] += row["number"] << (30 * row["digit"])
    return found


def fit(groups: DataFrame, dim: int, components: int) -> dict:
    """Number n, sums S, the leading unit eigenvectors (rows) of the covariance, their eigenvalues and shares of its trace.

    Eigenvalues that can't be told from zero come as 0. An eigenvector's largest entry is positive.
    """
    n = int(groups.agg(F.sum("weight")).first()[0])
    s = sums(groups, [0] * dim, dim, False)[0]
    t, *gram = sums(groups, [v // n for v in s], dim, True)
    # n * n * covariance is a whole number: nothing cancels
    v = np.array([[(n * gram[i][j] - t[i] * t[j]) / (n * n) for j in range(dim)] for i in range(dim)], float)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(values, kind="stable")[::-1][:components]
    trace = float(np.trace(v))
    values, vectors = values[order], vectors[:, order].T
    values = np.where(values > dim * np.finfo(float).eps * max(trace, 0.0), values, 0.0)
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)])
    return {"n": n, "s": s, "vectors": vectors * signs[:, None], "values": values, "explained": values / trace if trace > 0 else values}


def whiten(df: DataFrame, column: str = "embedding", components: int = 8, scale: int = 1024, offset: int = 100_000, weights: str = "counts") -> DataFrame:
    """One row per remaining row of ``df`` and component, with the columns of ``df`` and

    * ``component``, numbered from 1 by falling eigenvalue; there are at most ``components`` and the dimension;
    * ``n``, the weight of the fit: the number of rows (``weights="counts"``) or of distinct vectors (``"ones"``);
    * ``deviation``, the sum over dimensions of (n * x - S)**2, null where it exceeds a long;
    * ``whitened``, the centred vector on the component over the root of its eigenvalue; null where that is zero;
    * ``explained``, the eigenvalue's share of the trace, and ``identity_error``, the largest difference of the covariance
      of ``whitened`` (over components with variance) from the identity.

    An entry c counts as the whole number floor(scale * c) + offset. Rows are left out where the vector is
    null, empty, holds null, NaN or infinite entries or some that exceed 2**52 on the grid, or has another length than most
    (of lengths equally frequent the largest counts). Where no row is left, the result is empty. Repeated rows each come
    back. Columns of the new names are replaced.
    """
    if weights not in ("counts", "ones"):
        raise ValueError(weights)
    base = df.drop(*ADDED)
    named = rows_of(base, column)
    grid = F.transform(named["text"], lambda c: F.floor(c.cast("double") * scale))
    usable = F.forall(named["text"], lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < F.lit(float(1 << 52))))
    usable = F.coalesce(usable, F.lit(False)) & (F.size(named["text"]) > 0)
    # filters may move, so the grid itself is only worked out for usable rows
    x = F.when(usable, F.transform(grid, lambda c: c.cast("long") + offset))
    kept = named.where(usable).select("row", F.col("text").alias("vector"), x.alias("x"))
    size = kept.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    dim = size["size"] if size else 1
    kept = kept.where(F.size("x") == dim)
    groups = materialize(kept.groupBy("x").agg((F.count(F.lit(1)) if weights == "counts" else F.lit(1).cast("long")).alias("weight")))
    fields = [T.StructField("x", T.ArrayType(T.LongType())), T.StructField("deviation", T.LongType()), T.StructField("z", T.ArrayType(T.DoubleType())), T.StructField("weight", T.LongType())]
    fitted = fit(groups, dim, components) if size else {"n": 0, "s": [0] * dim, "vectors": np.zeros((1, dim)), "values": np.zeros(1), "explained": np.zeros(1)}
    n, s, values = fitted["n"], fitted["s"], fitted["values"]
    axes = np.divide(fitted["vectors"], np.sqrt(values)[:, None], where=values[:, None] > 0, out=np.zeros_like(fitted["vectors"]))
    empty = [i for i, v in enumerate(values) if not v > 0]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, dim):
            x = _matrix(batch.column("x"), dim)
            most = int(max(x.max(initial=0), -x.min(initial=0))) * n + max(map(abs, s))
            if dim * most * most < 1 << 62:
                d = x * n - np.array(s, np.int64)
                deviation = (d * d).sum(1).tolist()
            else:
                d = x.astype(object) * n - np.array(s, object)
                deviation = [v if v < 1 << 63 else None for v in (d * d).sum(1)]
            z = (d.astype(float) / n) @ axes.T
            out = [[None if i in empty else v for i, v in enumerate(row)] for row in z.tolist()] if empty else z.tolist()
            yield pa.RecordBatch.from_arrays([batch.column("x"), pa.array(deviation, pa.int64()), pa.array(out, pa.list_(pa.float64())), batch.column("weight")], names=["x", "deviation", "z", "weight"])

    white = materialize(groups.mapInArrow(project, T.StructType(fields)))
    live = [i for i in range(len(values)) if i not in empty]
    error = _identity_error(white, live, n) if live else 0.0
    parts = F.arrays_zip(F.array(*map(F.lit, range(1, len(values) + 1))).alias("component"), F.col("z").alias("whitened"), F.array(*map(F.lit, fitted["explained"].tolist())).alias("explained"))
    found = kept.join(white.select("x", "deviation", parts.alias("parts")), "x").select("row", "vector", "deviation", F.explode("parts").alias("part"))
    columns = [(F.col("vector") if c == column else F.col("row")[c]).alias(c) for c in base.columns]
    added = [F.col("part.component"), F.lit(n).cast("long").alias("n"), "deviation", F.col("part.whitened"), F.col("part.explained"), F.lit(error).alias("identity_error")]
    return found.select(*columns, *added)


def _identity_error(white: DataFrame, live: list[int], n: int) -> float:
    """Largest entry of the weighted covariance of the whitened groups less the identity, centred before it is multiplied."""
    z, w = F.col("z"), F.col("weight")
    mean = white.agg(*[(F.sum(z[i] * w) / n).alias(str(i)) for i in live]).first()
    pairs = [(i, j) for i in live for j in live if j <= i]
    sums = white.agg(*[F.sum((z[i] - mean[str(i)]) * (z[j] - mean[str(j)]) * w) / n for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(sums, pairs))

