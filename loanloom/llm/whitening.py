"""Whitening of embeddings by the covariance of their distinct vectors, weighted by multiplicity.

Entries become integers, identical vectors one row with the number of its copies. Sums are
exact; the covariance adds one weighted product of centred matrices per task; its leading
eigenvectors whiten every distinct vector once, and the rows join the results back.

Rows whose vector is null or has null or non-finite entries are left out, as are those with
an entry of 2**62 / 1024 or more, which has no long. Vectors of another length are fitted and whitened apart, by
the rows of that length. Components without variance (under 1e-12 of all variance) do not
exist: equal vectors, a single one and vectors without entries have fewer or no output
rows. Null and repeated ids are rows like others. `deviation` is null where it exceeds a
long; `deviation_exact` holds it then, as text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.session import ship_package, stored

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Components with less of the whole variance are rounding.
LEAST_SHARE = 1e-12
#: Vectors with more than one part in so many of all rows are hot: fewer than this many are.
HOT_PARTS = 1_000
#: Entries of vectors that array code holds at a time.
PIECE = 1 << 19
_LONG = 1 << 63


@dataclass(frozen=True)
class Moments:
    """Rows and exact sums of the vectors of one length."""

    n: int
    sums: tuple[int, ...]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: 64-bit where that holds them, else Python integers."""
        largest = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if largest < _LONG else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def squared(self, deviations: np.ndarray) -> list[int]:
        """The sum of squares of each row, exact."""
        largest = int(np.abs(deviations).max(initial=0))
        if largest * largest * deviations.shape[1] < _LONG:
            deviations = deviations.astype(np.int64)
        else:
            deviations = deviations.astype(object)
        return [int(s) for s in (deviations * deviations).sum(axis=1)] if deviations.shape[1] else [0] * len(deviations)

    def centred(self, deviations: np.ndarray) -> np.ndarray:
        """x minus the mean: the exact difference, rounded once."""
        return np.asarray(deviations / self.n, np.float64)


def integers(rows: DataFrame, vector_col: str) -> DataFrame:
    """The rows that take part, with the integer vector `x` and 128 bits of it."""
    doubles = F.transform(vector_col, lambda c: c.cast("double"))
    # a null or NaN comparison is not true, so such entries fail as well
    usable = F.forall("_c", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) * SCALE < float(2**62)), F.lit(False)))
    rows = rows.withColumn("_c", doubles).filter(F.col("_c").isNotNull() & usable)
    x = F.transform("_c", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return rows.withColumn("x", x).drop("_c").withColumns({"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit(1), F.reverse("x"))})


def _pieces(batches):
    """(x, batch) for slices of the batches whose vectors are of one length, as matrices."""
    for batch in batches:
        lists = batch["x"]
        sizes = lists.value_lengths().to_numpy()
        for d in np.unique(sizes):
            own = batch.filter(pa.array(sizes == d))
            step = max(1, PIECE // max(1, int(d)))
            for at in range(0, own.num_rows, step):
                part = own.slice(at, step)
                yield part["x"].flatten().to_numpy().reshape(part.num_rows, int(d)), part


def moments(distinct: DataFrame) -> dict[int, Moments]:
    """Rows and sums for every length of vectors: as many numbers as the lengths sum up to."""

    def run(batches):
        for x, part in _pieces(batches):
            copies = part["copies"].to_numpy()
            largest = int(np.abs(x).max(initial=0)) * int(copies.sum())
            kind = np.int64 if largest < _LONG else object
            sums = [int(s) for s in (x.astype(kind) * copies.astype(kind)[:, None]).sum(axis=0)]
            rows = (x.shape[1], -1, int(copies.sum())), *((x.shape[1], i, s) for i, s in enumerate(sums))
            d, i, total = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int32()), pa.array(i, pa.int32()), pa.array(map(str, total), pa.string())], ["d", "i", "total"])

    parts = distinct.select("x", "copies").mapInArrow(run, "d int, i int, total string")
    totals = parts.groupBy("d", "i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("d", "i").collect()
    found: dict[int, list[int]] = {}
    for r in totals:
        found.setdefault(r.d, []).append(int(r.total))
    return {d: Moments(n, tuple(sums)) for d, (n, *sums) in found.items()}


def covariances(distinct: DataFrame, known: dict[int, Moments]) -> dict[int, np.ndarray]:
    """The covariance for every length: one matrix a task, rows of matrices added in Spark."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for x, part in _pieces(batches):
            d, own = x.shape[1], known[x.shape[1]]
            centred = own.centred(own.deviations(x))
            product = (centred * part["copies"].to_numpy().astype(np.float64)[:, None]).T @ centred
            sums[d] = sums[d] + product if d in sums else product
        for d, matrix in sums.items():
            if d:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([r.tobytes() for r in matrix], pa.binary())], ["d", "i", "row"]
                )

    def add(rows: pa.Table) -> pa.Table:
        whole = np.sum([np.frombuffer(r, np.float64) for r in rows["row"].to_pylist()], axis=0)
        return pa.table({"d": rows["d"][:1], "i": rows["i"][:1], "row": pa.array([whole.tobytes()], pa.binary())})

    shape = "d int, i int, row binary"
    parts = distinct.select("x", "copies").mapInArrow(run, shape).groupBy("d", "i").applyInArrow(add, shape)
    found = {d: np.zeros((d, d)) for d in known}
    for r in parts.toLocalIterator():
        found[r.d][r.i] = np.frombuffer(r.row, np.float64) / known[r.d].n
    return found


def leading(covariance: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, unit eigenvectors (columns) and shares of all variance, largest first."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    whole = float(np.trace(covariance))
    order = order[values[order] > LEAST_SHARE * whole] if whole > 0 else order[:0]
    return values[order], vectors[:, order], values[order] / (whole or 1.0)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error and deviation_exact.

    The models of all lengths are on the driver and in the tasks: a few vectors for each length,
    whatever the number of rows.
    """
    spark = rows.sparkSession
    ship_package(spark)
    rows = integers(rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("_v")), "_v").drop("_v")
    distinct = stored(rows.groupBy("x", "h1", "h2").agg(F.count(F.lit(1)).alias("copies")), "distinct")
    known = moments(distinct)
    models = {d: leading(v, components) for d, v in covariances(distinct, known).items()}
    lasting = {d: (known[d], vectors / np.sqrt(values)) for d, (values, vectors, _) in models.items()}

    def run(batches):
        for x, part in _pieces(batches):
            own, project = lasting[x.shape[1]]
            deviations = own.deviations(x)
            white = own.centred(deviations) @ project if project.shape[1] else np.zeros((len(x), 0))
            squares = own.squared(deviations)
            fits = pa.array([s if s < _LONG else None for s in squares], pa.int64())
            offsets = pa.array(np.arange(len(x) + 1) * white.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(white).reshape(-1)))
            size = pa.array(np.full(len(x), x.shape[1]), pa.int32())
            columns = [part["h1"], part["h2"], part["copies"], size, fits, pa.array(map(str, squares), pa.string()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "copies", "d", "deviation", "deviation_exact", "white"])

    shape = "k1 long, k2 long, copies long, d int, deviation long, deviation_exact string, white array<double>"
    white = stored(distinct.mapInArrow(run, shape), "whitened")
    errors = identity_errors(white, {d: m.n for d, m in known.items()}, components)
    per_length = [
        F.struct(F.lit(d).alias("d"), F.lit(known[d].n).cast("long").alias("n"), F.lit(errors.get(d, 0.0)).alias("identity_error"), F.array(*[F.lit(float(s)) for s in shares]).cast("array<double>").alias("explained"))
        for d, (_, _, shares) in models.items()
        if len(shares)
    ]
    if not per_length:
        per_length = [F.struct(F.lit(-1).alias("d"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("identity_error"), F.array().cast("array<double>").alias("explained"))]
    # rows of vectors with very many copies meet a short broadcast list, all others a shuffle
    total = sum(m.n for m in known.values())
    hot = F.col("copies") * HOT_PARTS > total  # fewer than HOT_PARTS vectors
    results = white.drop("copies")
    same = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
    listed = F.broadcast(white.filter(hot).select(F.col("k1").alias("_1"), F.col("k2").alias("_2")))
    listed_too = (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2"))
    keyed = rows.select("vec_id", "h1", "h2")
    spread = keyed.join(listed, listed_too, "left_semi").join(F.broadcast(white.filter(hot).drop("copies")), same)
    others = keyed.join(listed, listed_too, "left_anti").join(results, same)
    joined = spread.unionByName(others).withColumn("of", F.filter(F.array(*per_length), lambda m: m["d"] == F.col("d"))[0])
    single = joined.select("vec_id", "of", "deviation", "deviation_exact", F.posexplode("white").alias("at", "whitened"))
    return single.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.col("of.n").alias("n"),
        "deviation",
        "whitened",
        F.get("of.explained", "at").alias("explained"),
        F.col("of.identity_error").alias("identity_error"),
        "deviation_exact",
    )


def identity_errors(white: DataFrame, n: dict[int, int], components: int = COMPONENTS) -> dict[int, float]:
    """For every length the largest entry of the whitened rows' covariance minus the identity."""
    at = [F.get("white", F.lit(i)) for i in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    sums = [F.sum(F.col("copies") * at[i] * at[j]).alias(f"s{i}_{j}") for i, j in pairs]
    means = [F.sum(F.col("copies") * at[i]).alias(f"m{i}") for i in range(components)]
    out = {}
    for r in white.groupBy("d").agg(*sums, *means).collect():
        entries = [r[f"s{i}_{j}"] / n[r.d] - r[f"m{i}"] * r[f"m{j}"] / n[r.d] ** 2 - (i == j) for i, j in pairs if r[f"s{i}_{j}"] is not None]
        out[r.d] = max(map(abs, entries), default=0.0)
    return out
