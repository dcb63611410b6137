"""Embedding whitening by digit-slice matrix products.

Components become integers x = floor(scale * c). All statistics are of the fit list, each distinct x vector once, and exact:

1. A first pass adds up the fit list: n and the sums S. A second multiplies y = n*x - S, which is centred and still integral. y is
   cut into limbs of ``LIMB`` bits, the limbs of a block of rows are laid side by side, and one float64 BLAS product gives the products
   of all pairs of limbs. With at most ``BLOCK`` rows no sum reaches 2**53, so every product is exact.
2. A task recombines its limb products into big integers and passes them on as digits in base 2**30, one row per matrix entry.
   Spark adds the digits up, before the shuffle and after, and the driver reads d*(d+1)/2 sums whatever the table's size.
3. The covariance, the sums divided by n**3 with one rounding, is decomposed on the driver; eigenvectors have their largest entry positive.
4. Every row of the table is projected: (n*x - S)/n on the component, over the root of its eigenvalue.

The driver holds some d*d numbers, d being the length of the vectors; nothing on it or in a task grows with the rows.

Defined cases: vectors that are null, empty, hold null or non-finite entries, or are not of the commonest length of the table (of equally common
ones, the greatest) give no rows; an entry beyond the range of a long counts as its end; rows without id and rows that repeat one are returned as often as they occur; a component
whose eigenvalue is zero to double precision (as with one distinct vector) has a null ``whitened``, ``explained`` zero and no part in ``identity_error``, which is null if there is no other;
with fewer dimensions than components there are as many components as dimensions; ``deviation`` is null beyond 38 digits. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.workspace import Workspace

LIMB, BLOCK = 20, 4096  # 2 * LIMB + log2(BLOCK) is under 53
DIGIT = 30


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Float64 matrices l with y = sum of l[k] * 2**(LIMB * k); all but the last are not negative. y holds longs or Python integers."""
    out, rest = [], y
    while True:
        if np.all((rest >= -(1 << LIMB - 1)) & (rest < 1 << LIMB - 1)):
            return [*out, rest.astype(np.float64)]
        out.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
        rest = rest >> LIMB


def gram(y: np.ndarray) -> np.ndarray:
    """The exact product of y transposed and y, as Python integers."""
    d = y.shape[1]
    total = np.zeros((d, d), dtype=object)
    rows = int(min(BLOCK, max(1, (1 << 25) // (8 * d))))
    for at in range(0, len(y), rows):
        parts = limbs(y[at : at + rows])
        side = np.concatenate(parts, axis=1)
        product = (side.T @ side).astype(np.int64)
        for i in range(len(parts)):
            for j in range(len(parts)):
                total += product[i * d : (i + 1) * d, j * d : (j + 1) * d].astype(object) << (LIMB * (i + j))
    return total


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S: longs where all fit, else Python integers."""
    reach = n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max((abs(s) for s in sums), default=0)
    if reach < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _digits(v: int) -> list[int]:
    """Digits in base 2**DIGIT, lowest first; all have the sign of v."""
    out, rest = [], abs(v)
    while rest:
        out.append((rest & ((1 << DIGIT) - 1)) * (1 if v > 0 else -1))
        rest >>= DIGIT
    return out


def _summed(parts: DataFrame) -> dict[int, int]:
    """The sum by place of the integers that parts(place, k, digit) holds in digits."""
    rows = parts.groupBy("place", "k").agg(F.sum("digit").alias("digit")).collect()  # bounded by the dimensions and the digits of a long's square
    out: dict[int, int] = {}
    for r in rows:
        out[r.place] = out.get(r.place, 0) + (r.digit << (DIGIT * r.k))
    return out


def _emitted(values: list[int]) -> pa.RecordBatch:
    rows = [(place, k, digit) for place, v in enumerate(values) for k, digit in enumerate(_digits(v))]
    held = np.array(rows, np.int64).reshape(-1, 3)
    return pa.RecordBatch.from_arrays([pa.array(held[:, c]) for c in range(3)], ["place", "k", "digit"])


def _matrices(batches: Iterator[pa.RecordBatch], column: str, d: int) -> Iterator[np.ndarray]:
    """The vectors of a column, some thousands of rows at a time."""
    rows = max(1, (1 << 25) // (8 * d))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows).column(batch.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


@dataclass
class Whitening:
    """A fitted transform: n, the sums S, and the components (rows) with their eigenvalues and shares of the variance."""

    d: int
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: list[float]
    explained: list[float]
    scale: int = 256

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer vectors; NaN for components without variance."""
        y = centred(x, self.n, self.sums)
        shifted = (y / self.n).astype(np.float64)
        roots = np.array([np.sqrt(e) if e > 0 else np.nan for e in self.values])
        return shifted @ self.vectors.T / roots

    def deviations(self, x: np.ndarray) -> list[int]:
        y = centred(x, self.n, self.sums)
        if y.dtype == object or self.d * int(np.abs(y).max(initial=0)) ** 2 >= 1 << 63:
            y = y.astype(object)
        return (y * y).sum(1).tolist()


def integers(vectors: DataFrame, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    own = vectors.select(vectors[id_column].alias("vec_id"), vectors[vector_column].cast("array<double>").alias("v"))
    usable = own.where(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    lengths = usable.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).head()
    d = lengths["size"] if lengths else 0
    return usable.where(F.size("v") == d).select("vec_id", F.transform("v", lambda c: F.floor(c * float(scale))).alias("x"))


def decompose(matrix: list[list[int]], n: int, components: int) -> tuple[np.ndarray, list[float], list[float]]:
    """(vectors, eigenvalues, explained) of the covariance matrix / n**3, largest first."""
    d, by = len(matrix), n**3
    values, vectors = np.linalg.eigh(np.array([[v / by for v in row] for row in matrix], np.float64).reshape(d, d))
    top = np.argsort(values)[::-1][:components]
    trace = sum(matrix[i][i] for i in range(d)) / by if d else 0.0
    kept = [float(values[i]) if values[i] > d * np.finfo(float).eps * values[top[0]] else 0.0 for i in top]
    turned = [vectors[:, i] * (1 if vectors[np.abs(vectors[:, i]).argmax(), i] > 0 else -1) for i in top]
    return np.array(turned).reshape(-1, d), kept, [e / trace if trace else 0.0 for e in kept]


def fit(fitted: DataFrame, components: int = 4, scale: int = 256) -> Whitening | None:
    """The transform of a fit list (x); nothing if it is empty. The list is read twice and should be saved."""
    size = fitted.select(F.size("x").alias("d")).head()
    if size is None:
        return None
    d, n = size.d, fitted.count()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * d
        for x in _matrices(batches, "x", d):
            wide = x if np.abs(x.astype(np.float64)).max(initial=0) * len(x) < 2.0**62 else x.astype(object)
            sums = [s + int(v) for s, v in zip(sums, wide.sum(0), strict=True)]
        yield _emitted(sums)

    found = _summed(fitted.select("x").mapInArrow(total, "place long, k long, digit long"))
    sums = [found.get(k, 0) for k in range(d)]

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((d, d), dtype=object)
        for x in _matrices(batches, "x", d):
            own += gram(centred(x, n, sums))
        yield _emitted([own[i, j] for i in range(d) for j in range(i, d)])

    found = _summed(fitted.select("x").mapInArrow(product, "place long, k long, digit long"))
    matrix = [[0] * d for _ in range(d)]
    for place, (i, j) in enumerate((i, j) for i in range(d) for j in range(i, d)):
        matrix[i][j] = matrix[j][i] = found.get(place, 0)
    return Whitening(d, n, sums, *decompose(matrix, n, min(components, d)), scale)


def transform(rows: DataFrame, net: Whitening) -> DataFrame:
    """(vec_id, deviation, w) of rows(vec_id, x); w holds the whitened coordinates, null for components without variance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in _matrices(iter([batch.select(["x"])]), "x", net.d):
                w, k = net.project(x), len(net.values)
                flat = pa.array(w.reshape(-1), mask=np.isnan(w.reshape(-1)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * k + 1, k, dtype=np.int32)), flat)
                ids = batch.column(batch.schema.get_field_index("vec_id")).slice(at, len(x))
                at += len(x)
                yield pa.RecordBatch.from_arrays([ids, pa.array([str(v) for v in net.deviations(x)]), lists], ["vec_id", "deviation", "w"])

    id_type = rows.schema["vec_id"].dataType.simpleString()
    out = rows.select("vec_id", "x").mapInArrow(run, f"vec_id {id_type}, deviation string, w array<double>")
    return out.withColumn("deviation", F.expr("try_cast(deviation AS decimal(38, 0))"))


def identity_error(whitened: DataFrame, net: Whitening) -> float | None:
    """The largest absolute entry of the covariance of w over the fit list, minus the identity; components without variance aside."""
    live = [k for k, e in enumerate(net.values) if e > 0]
    if not live:
        return None
    covers = [F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i in live for j in live if i <= j]
    row = whitened.agg(*covers).head()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i in live for j in live if i <= j)


def whiten(vectors: DataFrame, *, components: int = 4, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Per row that takes part and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    ws = Workspace(vectors.sparkSession, "whitening")
    rows = integers(vectors, scale, id_column, vector_column)
    fitted = ws.save(rows.groupBy("x").agg(F.count("*").alias("rows")), "fit")
    net = fit(fitted, components, scale)
    if net is None:
        kinds = {"component": "int", "n": "long", "deviation": "decimal(38,0)", "whitened": "double", "explained": "double", "identity_error": "double"}
        return rows.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()]).limit(0)
    error = identity_error(transform(fitted.select(F.lit(0).alias("vec_id"), "x"), net), net)
    told = F.array(*[F.lit(e) for e in net.explained])
    out = transform(rows, net).select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(net.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        told[F.col("at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )

