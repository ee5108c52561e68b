"""Approximate nearest neighbours by learned partitions.

On a bounded sample a graph of nearest neighbours is cut into balanced parts: spectral
bisection at the median, then moves to the part of most neighbours as long as sizes allow. A
small network learns to tell the part from the vector, and then puts every vector of the table
into one part. A query goes to its most probable parts, as many as give the wanted recall on
queries from the sample, and is compared with all vectors there by exact cosines.

Equal vectors are searched once and stand for each other: of their ids only the smallest
can be among the nearest, as ties go to smaller ids, so a vector that fills a third of the table is
no hot part. Parts are split into chunks of bounded size, and the queries for each into lots.
The number of parts, at most SAMPLE / PER_PART, does not grow with the table; chunks do.

Null vectors, and vectors that are empty, zero or hold null or non-finite components, take no
part. Vectors of each length are a search of their own, one length after the other; few of a
length are one part. In the parts searched, ties are exact, however many vectors tie. Rows without an
id cannot be answers or queries; rows with equal ids count as one candidate each. An
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.session import sampled, ship_package, stored

#: Vectors that parts are learned on, neighbours in their graph, vectors of the sample for a part.
SAMPLE, NEIGHBOURS, PER_PART = 8_000, 10, 250
#: Units of the hidden layer, passes and rate of learning.
HIDDEN, PASSES, RATE = 128, 40, 2e-3
#: Share of true neighbours that queries of the sample must find, and the number of such queries.
RECALL, TRIALS = 0.95, 1_000
#: Vectors and queries of a chunk.
CHUNK, QUERIES = 20_000, 4_000
#: What a product of unit vectors can be off by, and more; pairs whose cosine is computed at once.
ROUNDING, PAIRS = 1e-9, 50_000


@dataclass
class Router:
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def logits(self, unit: np.ndarray) -> np.ndarray:
        return np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def units(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / scale
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def neighbour_graph(unit: np.ndarray, k: int) -> np.ndarray:
    """The k nearest of every vector, in blocks."""
    out = np.empty((len(unit), k), np.int64)
    for a in range(0, len(unit), 1000):
        near = unit[a : a + 1000] @ unit.T
        near[np.arange(len(near)), a + np.arange(len(near))] = -np.inf
        out[a : a + 1000] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 3) -> np.ndarray:
    """A part for each node of the graph; sizes differ by a tenth at most."""
    n, k = graph.shape
    u, v = np.repeat(np.arange(n), k), graph.reshape(-1)
    u, v = np.r_[u, v], np.r_[v, u]
    random = np.random.default_rng(seed)
    part = np.zeros(n, np.int64)

    def bisect(nodes: np.ndarray, first: int, many: int) -> None:
        if many == 1:
            part[nodes] = first
            return
        place = np.full(n, -1)
        place[nodes] = np.arange(len(nodes))
        inside = (place[u] >= 0) & (place[v] >= 0)
        a, b = place[u[inside]], place[v[inside]]
        degree = np.maximum(np.bincount(a, minlength=len(nodes)), 1)
        x = random.normal(size=len(nodes))
        for _ in range(60):  # towards the second eigenvector of the random walk
            x = 0.5 * (x + np.bincount(a, x[b], len(nodes)) / degree)
            x -= (x * degree).sum() / degree.sum()
            x /= np.abs(x).max() + 1e-300
        left = many // 2
        order = np.argsort(x, kind="stable")
        cut = len(nodes) * left // many
        bisect(nodes[order[:cut]], first, left)
        bisect(nodes[order[cut:]], first + left, many - left)

    bisect(np.arange(n), 0, parts)
    sizes, most, least = np.bincount(part, minlength=parts), int(1.05 * n / parts) + 1, int(0.95 * n / parts)
    for _ in range(5):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (u, part[v]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        for x in np.argsort(-gain)[: int((gain > 0).sum())]:
            if sizes[best[x]] < most and sizes[part[x]] > least:
                sizes[part[x]] -= 1
                sizes[best[x]] += 1
                part[x] = best[x]
    return part


def learn(unit: np.ndarray, part: np.ndarray, parts: int, seed: int = 7) -> Router:
    """One hidden layer, fitted to the parts by Adam."""
    random = np.random.default_rng(seed)
    n, d = unit.shape
    p = [random.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), random.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    p[0] *= np.sqrt(d)  # components of unit vectors are small
    m, s, t = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p], 0
    for _ in range(PASSES):
        order = random.permutation(n)
        for a in range(0, n, 256):
            rows = order[a : a + 256]
            x = unit[rows]
            hidden = np.maximum(x @ p[0] + p[1], 0)
            logit = hidden @ p[2] + p[3]
            logit -= logit.max(axis=1, keepdims=True)
            error = np.exp(logit)
            error /= error.sum(axis=1, keepdims=True)
            error[np.arange(len(rows)), part[rows]] -= 1
            error /= len(rows)
            back = (error @ p[2].T) * (hidden > 0)
            t += 1
            for i, g in enumerate((x.T @ back, back.sum(0), hidden.T @ error, error.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.999 * s[i] + 0.001 * g * g
                p[i] = p[i] - RATE * (m[i] / (1 - 0.9**t)) / (np.sqrt(s[i] / (1 - 0.999**t)) + 1e-8)
    return Router(*p)


def probes_needed(router: Router, unit: np.ndarray, graph: np.ndarray, k: int, recall: float) -> int:
    """Parts to visit so that queries from the sample find the wanted share of their nearest."""
    logits = router.logits(unit)
    part = logits.argmax(axis=1)
    asked = np.linspace(0, len(unit) - 1, min(TRIALS, len(unit))).astype(int)
    near = np.take_along_axis(-(unit[asked][:, None, :] * unit[graph[asked]]).sum(2), np.arange(graph.shape[1])[None], 1).argsort(axis=1)[:, :k]
    targets = part[np.take_along_axis(graph[asked], near, 1)]
    rank = np.argsort(np.argsort(-logits[asked], axis=1), axis=1)
    needed = np.take_along_axis(rank, targets, 1)
    for probes in range(1, logits.shape[1] + 1):
        if (needed < probes).mean() >= recall:
            return probes
    return logits.shape[1]


def fit(vectors: np.ndarray, k: int, per_part: int = PER_PART, recall: float = RECALL) -> tuple[Router, int]:
    """A router and the number of parts that a query visits."""
    unit = units(vectors)
    parts = max(1, len(unit) // per_part)
    if parts == 1:
        d = unit.shape[1]
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1
    graph = neighbour_graph(unit, min(max(NEIGHBOURS, k), len(unit) - 1))
    router = learn(unit, balanced_parts(graph, parts), parts)
    return router, probes_needed(router, unit, graph, k, recall)


def _finite(vector: str) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def search(rows: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", chunk: int = CHUNK, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found of rows with ids divisible by `every`."""
    spark = rows.sparkSession
    ship_package(spark)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & _finite("vector"))
    rows = stored(rows.withColumn("key", F.struct(F.xxhash64("vector"), F.hash("vector"))), "vectors")
    # of equal vectors the k + 1 smallest ids; tasks keep no more of each before the shuffle
    smallest = rows.withColumn("_n", F.row_number().over(Window.partitionBy("key").orderBy("id"))).filter(F.col("_n") <= k + 1)
    distinct = smallest.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector"))
    distinct = stored(distinct, "distinct-vectors")
    out = "query_id long, rank int, vec_id long, score double"
    found = spark.createDataFrame([], out)
    # a number for each length that occurs
    for (d,) in distinct.select(F.size("vector").alias("d")).distinct().orderBy("d").collect():
        same = F.size("vector") == d
        found = found.unionByName(_search_length(rows.filter(same), distinct.filter(same), k, every, chunk, recall))
    return found


def _best(near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of all entries that can be among the k largest of their row, rounding allowed for."""
    many = min(k, near.shape[1])
    cut = np.partition(near, near.shape[1] - many, axis=1)[:, near.shape[1] - many]
    return np.nonzero(near >= cut[:, None] - ROUNDING)


def _search_length(rows: DataFrame, distinct: DataFrame, k: int, every: int, chunk: int, recall: float) -> DataFrame:
    """The search among vectors of one length."""
    taken = sampled(distinct.select("vector"), SAMPLE, "vector").orderBy("vector").toArrow()
    router, probes = fit(_matrix(taken["vector"]), k, recall=recall)

    def route(many):
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    logits = router.logits(units(_matrix(batch["vector"])))
                    first = np.argsort(-logits, axis=1, kind="stable")[:, :many].astype(np.int32)
                    yield batch.append_column("parts", pa.FixedSizeListArray.from_arrays(pa.array(first.reshape(-1)), first.shape[1]).cast(pa.list_(pa.int32())))

        return run

    shape = "key struct<col1:bigint,col2:int>, ids array<bigint>, vector array<double>, parts array<int>"
    index = distinct.mapInArrow(route(1), shape).select("ids", "vector", F.element_at("parts", 1).alias("part"))
    index = stored(index, "index")
    queries = rows.filter(F.col("id") % every == 0)
    asked = queries.groupBy("key").agg(F.first("vector").alias("vector"), F.min("id").alias("any")).withColumn("ids", F.array("any"))
    asked = asked.select("key", "ids", "vector").mapInArrow(route(probes), shape)
    asked = stored(asked.select("key", "vector", F.explode("parts").alias("part")), "asked")
    # one row for each part: how many chunks its vectors make, and how many lots its queries
    loads = asked.groupBy(F.col("part").alias("_asked")).agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("lots"))
    sizes = index.groupBy(F.col("part").alias("_part")).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    parts = stored(sizes.join(loads, F.col("_part") == F.col("_asked")).drop("_asked"), "parts")
    asked = asked.join(F.broadcast(parts), F.col("part") == F.col("_part"))
    asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    asked = asked.withColumn("lot", F.pmod(F.xxhash64("key"), F.col("lots")).cast("int"))
    index = index.join(F.broadcast(parts), F.col("part") == F.col("_part"))
    index = index.withColumn("chunk", F.pmod(F.xxhash64("vector"), F.col("chunks")).cast("int"))
    index = index.withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
    place = ["part", "chunk", "lot"]

    def compare(left, right):
        empty = pa.table({"hi": pa.array([], pa.int64()), "lo": pa.array([], pa.int32()), "ids": pa.array([], pa.list_(pa.int64())), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return empty
        a, b = _matrix(left["vector"]), _matrix(right["vector"])
        unit_a, unit_b = units(a), units(b)
        q, c = _best(unit_a @ unit_b.T, k + 1)
        norm_a, norm_b = (np.sqrt((x * x).sum(axis=1)) for x in (a, b))
        exact = np.empty(len(q))
        for at in range(0, len(q), PAIRS):
            some = slice(at, at + PAIRS)
            exact[some] = (a[q[some]] * b[c[some]]).sum(axis=1) / (norm_a[q[some]] * norm_b[c[some]])
        # no more than the k + 1 nearest vectors, ties by smallest id, can hold the k + 1 nearest rows
        lists = right["ids"].combine_chunks()
        least = lists.flatten().to_numpy()[lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]]
        order = np.lexsort((least[c], -exact, q))
        place = np.arange(len(q)) - np.searchsorted(q, q)[order]
        kept = order[place <= k]
        q, c, exact = q[kept], c[kept], exact[kept]
        keys = left["key"].combine_chunks()
        hi, lo = (keys.field(i).take(pa.array(q)) for i in (0, 1))
        return pa.table({"hi": hi, "lo": lo, "ids": lists.take(pa.array(c)), "score": pa.array(exact)})

    found = (
        asked.select(*place, "key", "vector")
        .groupBy(*place)
        .cogroup(index.select(*place, "ids", "vector").groupBy(*place))
        .applyInArrow(compare, "hi long, lo int, ids array<long>, score double")
    )
    found = found.select("hi", "lo", "score", F.explode("ids").alias("vec_id"))
    nearest = Window.partitionBy("hi", "lo").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("_n", F.row_number().over(nearest)).filter(F.col("_n") <= k + 1)
    answers = found.groupBy("hi", "lo").agg(F.collect_list(F.struct("score", "vec_id")).alias("found"))
    # every query drops its own row from the answers of its vector
    asking = queries.select(F.col("id").alias("query_id"), F.col("key.*")).toDF("query_id", "_hi", "_lo")
    joined = asking.join(answers, (F.col("_hi") == F.col("hi")) & (F.col("_lo") == F.col("lo")))
    others = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    ordered = F.array_sort(F.transform(others, lambda x: F.struct((-x["score"]).alias("less"), x["vec_id"].alias("vec_id"), x["score"].alias("score"))))
    top = joined.select("query_id", F.posexplode(F.slice(ordered, 1, k)).alias("at", "x"))
    return top.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
