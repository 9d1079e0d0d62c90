"""Nearest neighbours by randomly rotated one-bit codes.

Every vector is taken relative to the nearest of a few centroids, rotated by a random orthogonal matrix and
kept as the signs of its coordinates, with two scalars: its distance to the centroid and the inner product of its
direction with its code. From these the inner product with a query is estimated without bias, with an error
bound that shrinks with the square root of the dimension. A vector is reranked on its original
components only if the bound lets it be among the nearest found so far.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomlake.llm.common import batched, read, staged

#: Vectors sampled to fit the centroids, centroids, and the bound in deviations of the estimate (infinite: everything is reranked, the search is exact).
SAMPLE_ROWS, CENTROIDS, DEVIATIONS = 4_096, 16, 3.5
#: Bits that a query's turned coordinates are rounded to, so that the inner product with a code is a sum of counts of common bits.
QUERY_BITS = 6
#: Queries that meet all vectors in one pass, and vectors compared with them at once.
QUERY_BLOCK, VECTOR_BLOCK = 2_048, 1_024
NEAREST = 10


def usable(v: Column) -> Column:
    """Neither null nor zero, no null and no non-finite component."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


class Codebook:
    """Centroids and rotation: a fixed size."""

    def __init__(self, sample: np.ndarray, centroids: int = CENTROIDS, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.dimension = sample.shape[1]
        self.rotation = np.linalg.qr(rng.standard_normal((self.dimension, self.dimension)))[0]
        c = sample[rng.permutation(len(sample))[:centroids]]
        for _ in range(10):
            near = self._squares(sample, c).argmin(1)
            c = np.stack([sample[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
        self.centroids = c

    @staticmethod
    def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(centroid, packed signs, distance to the centroid, inner product of direction and code) of each row."""
        near = self._squares(x, self.centroids).argmin(1)
        rest = x - self.centroids[near]
        norm = np.linalg.norm(rest, axis=1)
        turned = rest @ self.rotation / np.maximum(norm, 1e-30)[:, None]
        return near, np.packbits(turned > 0, axis=1), norm, np.abs(turned).sum(1) / math.sqrt(self.dimension)


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of packed bits as 64-bit words."""
    return np.ascontiguousarray(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8)))).view(np.uint64)


class PackedQueries:
    """Queries turned and rounded to QUERY_BITS bits, as one packed plane of bits for each bit."""

    def __init__(self, queries: np.ndarray, book: Codebook):
        turned = queries @ book.rotation
        self.low = turned.min(axis=1)
        self.step = np.maximum(turned.max(axis=1) - self.low, 1e-30) / ((1 << QUERY_BITS) - 1)
        whole = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        self.planes = [_words(np.packbits((whole >> b & 1).astype(np.uint8), axis=1)) for b in range(QUERY_BITS)]
        self.total = self.low * book.dimension + self.step * whole.sum(axis=1)
        #: What rounding can change of an inner product with a code of signs, at most.
        self.slack = self.step / 2 * book.dimension

    def signs_product(self, codes: np.ndarray) -> np.ndarray:
        """code, query: inner products of the codes' signs with the rounded queries, from counts of common bits."""
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        common = np.zeros((len(codes), len(self.low)))
        for b, plane in enumerate(self.planes):
            for w in range(codes.shape[1]):
                common += np.bitwise_count(codes[:, w][:, None] & plane[:, w][None]).astype(np.int64) << b
        # signs are 2 * bit - 1
        return 2 * (self.low * ones[:, None] + self.step * common) - self.total


def _nearest_in(batches, book: Codebook, ids: np.ndarray, queries: np.ndarray, k: int, deviations: float):
    """Yield (query number, vec_id, squared distance) arrays: the k nearest of all batches for each query."""
    d, root = book.dimension, math.sqrt(book.dimension)
    packed = PackedQueries(queries, book)
    to_centre = np.maximum(Codebook._squares(queries, book.centroids), 0).T  # centroid, query
    centre_turned = book.centroids @ book.rotation
    best_q, best_id, best_d = np.array([], np.int64), np.array([], np.int64), np.array([])
    reach = np.full(len(queries), np.inf)
    for batch in batches:
        all_ids = batch.column("vec_id").to_numpy()
        near = batch.column("centroid").to_numpy()
        codes = np.stack([np.frombuffer(x, np.uint8) for x in batch.column("code").to_pylist()]) if len(all_ids) else np.zeros((0, 1), np.uint8)
        norm, fit = batch.column("norm").to_numpy(), np.maximum(batch.column("fit").to_numpy(), 1e-6)
        vectors = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(all_ids), -1)
        for at in range(0, len(all_ids), VECTOR_BLOCK):
            part = slice(at, at + VECTOR_BLOCK)
            signs = np.unpackbits(codes[part], axis=1, count=d).astype(np.float32) * 2 - 1
            own = (signs * centre_turned[near[part]]).sum(1)  # once a vector, not once a pair
            inner = ((packed.signs_product(_words(codes[part])) - own[:, None]) / root + packed.slack / root) / fit[part][:, None]
            centre = to_centre[near[part]]
            spread = np.sqrt(np.maximum(1 - fit[part] ** 2, 0)) / fit[part] * min(deviations, 1e9) / math.sqrt(max(d - 1, 1))
            n = norm[part][:, None]
            lowest = n * n + centre - 2 * n * (inner + spread[:, None] * np.sqrt(centre)) if math.isfinite(deviations) else np.zeros(inner.shape)
            i, q = np.nonzero(lowest <= reach * (1 + 1e-5) + 1e-9 if math.isfinite(deviations) else lowest == 0)
            i += at
            keep = all_ids[i] != ids[q]
            i, q = i[keep], q[keep]
            total = np.zeros(len(i))
            for c in range(d):  # one component after another: the sum's order is fixed
                gap = vectors[i, c] - queries[q, c]
                total += gap * gap
            best_q, best_id, best_d = np.concatenate((best_q, q)), np.concatenate((best_id, all_ids[i])), np.concatenate((best_d, total))
            order = np.lexsort((best_id, best_d, best_q))
            best_q, best_id, best_d = best_q[order], best_id[order], best_d[order]
            first = np.searchsorted(best_q, np.arange(len(queries)))
            rank = np.arange(len(best_q)) - first[best_q]
            top = rank < k
            full = rank == k - 1
            reach[best_q[full]] = best_d[full]
            best_q, best_id, best_d = best_q[top], best_id[top], best_d[top]
    yield best_q, best_id, best_d


def build_index(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, Codebook | None]:
    """Index of every usable row, written to the shared folder, and its codebook (None: no usable row).

    The codebook is fitted on the SAMPLE_ROWS rows of the least hash of the id; vectors of another length than
    most of the sample take no part, like those that are null, zero or not finite.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).alias("embedding")).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    sample = [r[0] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("embedding").collect()]
    if not sample:
        return rows, None
    lengths = sorted(map(len, sample))
    length = max(set(lengths), key=lambda n: (lengths.count(n), -n))
    book = Codebook(np.array([x for x in sample if len(x) == length], np.float64))

    def encode(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            near, code, norm, fit = book.encode(x) if batch.num_rows else (np.zeros(0, int), [], np.zeros(0), np.zeros(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(near.astype(np.int32)), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(norm), pa.array(fit), batch.column(1)],
                ["vec_id", "centroid", "code", "norm", "fit", "embedding"])

    kind = rows.schema["embedding"].dataType.simpleString()
    index = batched(rows).where(F.size("embedding") == length).mapInArrow(encode, f"vec_id bigint, centroid int, code binary, norm double, fit double, embedding {kind}")
    return staged(index, "one-bit-index"), book


def search(index: DataFrame, book: Codebook | None, queries: Column, k: int = NEAREST, deviations: float = DEVIATIONS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of the index, by Euclidean distance, of each indexed row for which ``queries`` holds.

    A query's own row is no candidate; fewer candidates than k are all returned; ties go to the smaller id. Of rows
    with one id the query is the one of the smallest vector. Queries meet all rows in blocks of QUERY_BLOCK
    (as expected by their hash), one pass over the index a block; the driver holds one block at a time. Each task keeps k rows a query.
    A vector is left out only if the error bound of ``deviations`` puts it beyond the k nearest so far: by chance, so recall is measured. An infinite
    bound reranks every vector: then the result is exact.
    """
    empty = index.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if book is None:
        return empty
    chosen = index.where(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    blocks = math.ceil(chosen.count() / QUERY_BLOCK)
    found = None
    for b in range(blocks):
        rows = chosen.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").collect()
        if not rows:
            continue
        shared = index.sparkSession.sparkContext.broadcast((np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64)))

        def nearest(batches, shared=shared):
            ids, vectors = shared.value
            for q, i, total in _nearest_in(batches, book, ids, vectors, k, deviations):
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(i), pa.array(np.sqrt(total))], ["query_id", "vec_id", "score"])

        part = index.mapInArrow(nearest, "query_id bigint, vec_id bigint, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return empty
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, book = build_index(read(spark, sf_dir, "embeddings"))
    return search(index, book, F.col("vec_id") % 100 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, v.vec_id, sqrt(list_reduce(list_transform(range(1, len(v.e) + 1), lambda i: (v.e[i] - q.e[i]) * (v.e[i] - q.e[i])), lambda a, b: a + b)) AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d) WHERE rank <= 10
"""
