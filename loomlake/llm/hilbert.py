"""Sharding along a Hilbert curve over document metadata.

Each metadata dimension is quantised at its own quantiles, so that cells hold about equally many rows; a
row's cell has an index on the Hilbert curve; rows are sorted by it and the sorted sequence is cut into runs of
equal numbers of rows. Neighbours on the curve are neighbours in every dimension, so a shard
covers a narrow range of each and a reader can skip shards by their minima and maxima.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlake.llm.common import read, staged
from loomlake.operators.edges import text_cells, text_edges

SHARDS = 16
#: Bits a dimension is quantised to, and the dimensions of the query.
BITS = 5
DIMENSIONS = ("size", "lang", "source")
#: Relative error of the quantiles; only the shape of cells depends on it.
QUANTILE_ERROR = 0.002


def hilbert_index(cells: list[np.ndarray], bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points with coordinates below 2 ** bits, for any number of dimensions.

    The coordinates are turned into the curve's transposed index by undoing, from the highest bit down, the
    swaps and reflections that each level of the curve applies to the levels below, then Gray-decoded.
    """
    x = [np.asarray(c, np.int64).copy() for c in cells]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            reflect = (x[i] & bit) != 0
            swap = np.where(reflect, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(reflect, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where(x[n - 1] & (1 << level), turn ^ ((1 << level) - 1), turn)
    x = [c ^ turn for c in x]
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for c in x:
            index = index << 1 | (c >> level & 1)
    return index


def with_hilbert(df: DataFrame, dimensions: list[str], bits: int = BITS, name: str = "hilbert") -> DataFrame:
    """``df`` with each row's index on the curve over ``dimensions``, quantised at their quantiles over all rows: numbers at sketches, texts at whole values. Null: the lowest cell."""
    texts = {d: text_edges(df, d, 1 << bits, lambda counts: staged(counts, "shard-values")) for d in dimensions if isinstance(df.schema[d].dataType, T.StringType)}
    numbers = [d for d in dimensions if d not in texts]
    edges = dict(texts)
    if numbers:
        own = df.select(*[F.col(f"`{d}`").cast("double").alias(f"_{i}") for i, d in enumerate(numbers)])
        cuts = own.approxQuantile(own.columns, [i / (1 << bits) for i in range(1, 1 << bits)], QUANTILE_ERROR)
        edges |= {d: np.unique(np.array(c, float)) for d, c in zip(numbers, cuts, strict=True)}

    @F.pandas_udf("bigint")
    def curve(*columns: pd.Series) -> pd.Series:
        cells = [np.maximum(text_cells(x, edges[d]), 0) if d in texts else np.where(np.isnan(c := x.to_numpy(float)), 0, np.searchsorted(edges[d], c, "right")) for d, x in zip(dimensions, columns, strict=True)]
        return pd.Series(hilbert_index(cells, bits))

    return df.withColumn(name, curve(*[F.col(f"`{d}`") if d in texts else F.col(f"`{d}`").cast("double") for d in dimensions]))


def shard_documents(docs: DataFrame, shards: int = SHARDS, dimensions: tuple[str, ...] = DIMENSIONS, id_column: str = "doc_id", text_column: str = "text", bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, law, hilbert, shard, slot, grown_shard): every row's shard and gapless place in it.

    size: UTF-8 bytes of the text (null: none) plus 1; it may be named as a dimension beside columns of ``docs``. Law
    ``rows``: shards are runs of the order by curve index whose counts are at most one apart; rows of one
    cell are ordered by a hash of the id, then id, CRC and size, so a cell with a third of all rows is spread over tasks
    and shards like any other, and repeated rows stand beside each other. grown_shard is null: the law has no stable growth.

    Only the narrow columns are sorted, once, by sampled ranges; a row's rank is its place in its range plus
    the sizes of the ranges before, of which the driver sees one number a range. The sorted table is written to the shared
    folder first, so that a lost executor cannot make ranges differ between the count and the use.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    kept = [d for d in dimensions if d != "size"]
    narrow = docs.select(
        F.col(id_column).alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), *[F.col(d).alias(f"_{d}") for d in kept])
    narrow = staged(narrow, "shard-narrow")
    indexed = with_hilbert(narrow, ["size" if d == "size" else f"_{d}" for d in dimensions], bits)
    order = ["hilbert", F.xxhash64("doc_id"), "doc_id", "text_crc32", "size"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = indexed.select("doc_id", "size", "text_crc32", "hilbert").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # range in the high bits, place in it below bit 33
    ordered = staged(ordered.withColumn("_range", F.shiftright(place, 33).cast("int")).withColumn("_place", place.bitwiseAND(F.lit((1 << 33) - 1))), "shard-order")
    counts = {r["_range"]: r["n"] for r in ordered.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    total, before, starts = sum(counts.values()), 0, []
    for r in range(max(counts, default=-1) + 1):
        starts.append(before)
        before += counts.get(r, 0)
    offsets = docs.sparkSession.createDataFrame(list(enumerate(starts)), "_range int, _start bigint")
    small, extra = divmod(total, shards)  # the first ``extra`` shards have one row more
    edge = extra * (small + 1)
    with_rank = ordered.join(offsets, "_range").withColumn("_rank", F.col("_start") + F.col("_place"))
    late = F.expr(f"(_rank - {edge}) div {max(small, 1)}")
    early = F.expr(f"_rank div {small + 1}")
    found = F.when(F.col("_rank") < edge, early).otherwise(late + extra).cast("int")
    start = F.when(F.col("_shard") < extra, F.col("_shard") * F.lit(small + 1)).otherwise(F.lit(edge) + (F.col("_shard") - extra) * F.lit(small))
    return with_rank.withColumn("_shard", found).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "hilbert", F.col("_shard").alias("shard"), (F.col("_rank") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def manifest(sharded: DataFrame, docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, id_column: str = "doc_id") -> DataFrame:
    """One row a shard: rows, bytes and the least and greatest value of each dimension, for pruning. Ids are taken as unique."""
    kept = [d for d in dimensions if d != "size"]
    both = sharded.join(docs.select(F.col(id_column).alias("doc_id"), *kept), "doc_id", "left")
    bounds = [f(d).alias(f"{name}_{d}") for d in dimensions for name, f in (("min", F.min), ("max", F.max))]
    return both.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *bounds)


def op3_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"))
