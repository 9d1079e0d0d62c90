"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed in cells of source, language and topic. The cells' weights are raked: scaled to each marginal's
targets in turn, until all agree. A document is then drawn as often as brings its cell's expected tokens to its raked
share of the token budget: cells that have less than their share are repeated, so the sample meets the targets.

Topics, where no column gives them, are clusters of documents by the words they use: k-means over all documents' vectors of
hashed words, which are written once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.llm.common import batched, free_prefix, read, remembered, staged, works_for

MARGINS = ("source", "lang", "topic")
#: Exponent of a marginal's own shares that makes its targets where none are given: 1 keeps the shares, 0 evens them out.
TEMPERATURE = 0.5
#: Share of all tokens that the sample is to have; rounds of raking at most; relative deviation from all targets that ends them.
BUDGET, ROUNDS, TOLERANCE = 0.7, 25, 1e-4
#: Cells that are raked on the driver at most; more are raked by joins, with the same results.
LOCAL_CELLS = 100_000
#: Topics, dimensions of a document's vector, rounds of k-means over all documents, bytes of a word that counts for the topic at least, first centroids' candidates.
TOPICS, DIMENSIONS, LLOYD_ROUNDS, CONTENT_BYTES, CANDIDATES = 12, 64, 6, 4, 256
NO_TOPIC = "none"
SEED = 7
_MEMO: dict[bytes, int] = remembered("mixing", {})
MEMO_WORDS = 200_000


def profile(text: str | None) -> tuple[int, np.ndarray]:
    """Tokens (words between ASCII white space) of the whole text, and the unit vector of its longer words, hashed with signs; zero if it has none."""
    works_for("mixing")
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(_MEMO) > MEMO_WORDS:
        _MEMO.clear()
    get, places = _MEMO.get, []
    for w in words:
        at = get(w)
        if at is None:
            at = _MEMO[w] = xxhash.xxh64_intdigest(w, SEED) % (2 * DIMENSIONS) if len(w) >= CONTENT_BYTES else 2 * DIMENSIONS
        places.append(at)
    n = np.bincount(places, minlength=2 * DIMENSIONS + 1) if places else np.zeros(2 * DIMENSIONS + 1)
    v = (n[:DIMENSIONS] - n[DIMENSIONS : 2 * DIMENSIONS]).astype(np.float32)
    v = np.sign(v) * np.sqrt(np.abs(v))
    return len(words), v / max(float(np.linalg.norm(v)), 1e-12)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroid of the largest cosine; -1 for a zero vector or without centroids."""
    if not len(centroids):
        return np.full(len(vectors), -1)
    return np.where(vectors.any(axis=1), (vectors @ centroids.T).argmax(axis=1), -1)


def learn_topics(vectors: DataFrame, key: str, topics: int = TOPICS) -> np.ndarray:
    """Unit centroids of ``vectors`` (key, vector binary), by spherical k-means over all rows. Each round is a narrow pass and a sum of topics * DIMENSIONS numbers.

    It starts from rows far from each other among the CANDIDATES of the least hashed keys. Fewer distinct rows give fewer topics.
    """
    first = vectors.where(F.col("vector") != F.lit(bytes(4 * DIMENSIONS))).orderBy(F.xxhash64(key), key).limit(CANDIDATES).collect()
    if not first:
        return np.zeros((0, DIMENSIONS), np.float32)
    found = np.array([np.frombuffer(r["vector"], np.float32) for r in first])
    chosen = [0]
    while len(chosen) < min(topics, len(found)) and (found @ found[chosen].T).max(1).min() < 0.999:
        chosen.append(int((found @ found[chosen].T).max(1).argmin()))
    centroids = found[chosen]
    for _ in range(LLOYD_ROUNDS):
        shared = vectors.sparkSession.sparkContext.broadcast(centroids)

        def sums(batches, shared=shared):
            total = np.zeros((len(shared.value), DIMENSIONS))
            for batch in batches:
                if batch.num_rows:
                    x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float32).reshape(-1, DIMENSIONS)
                    at = nearest(x, shared.value)
                    np.add.at(total, at[at >= 0], x[at >= 0])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "total"])

        own = np.zeros(centroids.size)
        for r in vectors.select("vector").mapInArrow(sums, "place bigint, total double").groupBy("place").agg(F.sum("total").alias("total")).collect():
            own[r["place"]] = r["total"]
        own = own.reshape(centroids.shape)
        norm = np.linalg.norm(own, axis=1, keepdims=True)
        centroids = np.where(norm > 0, own / np.maximum(norm, 1e-12), centroids).round(6).astype(np.float32)
    return centroids


def _profiled(texts: pd.Series) -> pd.DataFrame:
    own = [profile(x) for x in texts]
    return pd.DataFrame({"tokens": [n for n, _ in own], "vector": [v.astype(np.float32).tobytes() for _, v in own]})


def _named(at: np.ndarray) -> list[str]:
    return [f"topic{x}" if x >= 0 else NO_TOPIC for x in at]


def marked(docs: DataFrame, centroids: np.ndarray | None = None, text_column: str = "text", topic: Column | None = None, tokens: Column | None = None, prefix: str = "_") -> DataFrame:
    """``docs`` with _source, _lang, _topic (null: ``<null>``) and _tokens beside its columns: given, or of the whole text by ``profile`` and the nearest centroid."""
    shared = docs.sparkSession.sparkContext.broadcast(centroids if centroids is not None else np.zeros((0, DIMENSIONS), np.float32))

    @F.pandas_udf("tokens bigint, topic string")
    def read_text(texts: pd.Series) -> pd.DataFrame:
        own = [profile(x) for x in texts]
        at = nearest(np.array([v for _, v in own], np.float32).reshape(-1, DIMENSIONS), shared.value)
        return pd.DataFrame({"tokens": [n for n, _ in own], "topic": _named(at)})

    seen = f"{prefix}seen"
    rows = docs.withColumn(seen, read_text(F.col(text_column))) if topic is None or tokens is None else docs
    own = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic if topic is not None else F.col(f"`{seen}`.topic")}
    count = tokens.cast("long") if tokens is not None else F.col(f"`{seen}`.tokens")
    return rows.withColumns({f"{prefix}{n}": F.coalesce(c.cast("string"), F.lit("<null>")) for n, c in own.items()} | {f"{prefix}tokens": F.coalesce(count, F.lit(0))}).drop(seen)


def _targets(cells: DataFrame, margin: str, given: dict[str, float] | None) -> DataFrame:
    """(margin, target), summing to 1: the given weights of the values there are (others: 0), or tempered shares."""
    own = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("tokens"))
    if given is None:
        weight = F.pow("tokens", F.lit(TEMPERATURE))
    else:
        weight = F.coalesce(F.create_map(*[F.lit(x) for kv in given.items() for x in kv])[F.col(margin)].cast("double"), F.lit(0.0)) if given else F.lit(0.0)
    own = own.select(margin, F.when(F.col("tokens") > 0, weight).otherwise(F.lit(0.0)).alias("weight"))
    total = own.agg(F.sum("weight").alias("total"))
    total = total.first()["total"] or 1.0
    return own.select(margin, (F.col("weight") / F.lit(float(total))).alias("target"))


def rake(cells: DataFrame, targets: dict[str, dict[str, float] | None], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (margins, tokens) with ``share``: the raked share of all tokens, with the targets' marginals.

    Up to LOCAL_CELLS cells are raked on the driver; more by joins on the cluster, each round written to the shared folder. Targets that no weights
    of the cells can meet are approached as far as the rounds allow.
    """
    margins = list(targets)
    wanted = {m: _targets(cells, m, given) for m, given in targets.items()}
    if cells.count() <= LOCAL_CELLS:
        return _rake_here(cells, wanted, rounds, tolerance)
    wanted = {m: staged(t, f"mix-target-{m}") for m, t in wanted.items()}
    raked = cells.withColumn("share", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for i, m in enumerate(margins):
            sums = raked.groupBy(m).agg(F.sum("share").alias("_now")).join(wanted[m], m)
            factor = sums.select(m, F.when(F.col("_now") > 0, F.col("target") / F.col("_now")).otherwise(F.lit(0.0)).alias("_factor"))
            raked = raked.join(factor, m).withColumn("share", F.col("share") * F.col("_factor"))
            raked = raked.withColumn("_off", F.greatest(F.col("_off"), F.abs(F.col("_factor") - 1)) if i else F.abs(F.col("_factor") - 1)).drop("_factor")
        raked = staged(raked, "mix-cells")
        off = raked.where("share > 0").agg(F.max("_off")).first()[0]
        raked = raked.drop("_off")
        if off is None or off <= tolerance:
            break
    return raked.select(*cells.columns, "share")


def _rake_here(cells: DataFrame, wanted: dict[str, DataFrame], rounds: int, tolerance: float) -> DataFrame:
    own = cells.toPandas()
    share = own["tokens"].to_numpy(float)
    goals = {m: own[m].map(t.toPandas().set_index(m)["target"]).to_numpy(float) for m, t in wanted.items()}
    places = {m: np.unique(own[m].to_numpy(str), return_inverse=True)[1] for m in wanted}
    for _ in range(rounds if len(own) else 0):
        off = np.zeros(len(own))
        for m, at in places.items():
            now = np.bincount(at, share)[at]
            factor = np.divide(goals[m], now, out=np.zeros(len(own)), where=now > 0)
            share = share * factor
            off = np.maximum(off, np.abs(factor - 1))
        if not (share > 0).any() or off[share > 0].max() <= tolerance:
            break
    rows = [(*r, float(x)) for r, x in zip(own.itertuples(index=False, name=None), share, strict=True)]
    return cells.sparkSession.createDataFrame(rows, cells.withColumn("share", F.lit(0.0)).schema)


def probabilities(raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Cells with ``probability``, the expected copies of each document: k * share / tokens, with the k that makes the expected tokens ``budget`` of all.

    Over 1 where a cell has fewer tokens than its share of the budget: capped, the sample would miss the targets. 1 in cells without tokens.
    """
    row = raked.agg(F.sum("tokens").alias("tokens"), F.sum("share").alias("share")).first()
    k = budget * row["tokens"] / row["share"] if row["share"] else 0.0
    return raked.withColumn("probability", F.when(F.col("tokens") > 0, F.lit(float(k)) * F.col("share") / F.col("tokens")).otherwise(F.lit(1.0)))


def marginals(kept: DataFrame, prefix: str = "_") -> DataFrame:
    """(margin, value, share): the shares of tokens that rows of ``mix`` have by source, lang and topic, to hold against the targets."""
    total = float(kept.agg(F.sum(f"{prefix}tokens")).first()[0] or 1)
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("margin"), F.col(f"{prefix}{m}").alias("value")) for m in MARGINS]))
    return kept.select(each.alias("at"), F.col(f"{prefix}tokens").alias("n")).groupBy("at").agg(F.sum("n").alias("n")).select("at.margin", "at.value", (F.col("n") / F.lit(total)).alias("share"))


def mix(docs: DataFrame, targets: dict[str, dict[str, float] | None] | None = None, budget: float = BUDGET, id_column: str = "doc_id", text_column: str = "text", topic: Column | None = None, tokens: Column | None = None, seed: int = SEED) -> DataFrame:
    """The sampled rows of ``docs``, all columns, with _source, _lang, _topic, _tokens and _probability (more underscores where ``docs`` has such a column).

    ``targets`` maps source, lang and topic to target weights by value, or to None for tempered shares. ``topic`` and ``tokens`` may
    be columns of ``docs``; else topics are learned from all texts and tokens are words. Nulls are
    a value of their own (``<null>``). A row is given as often as the whole part of its cell's probability (the expected copies, which can be over 1)
    says, and once more if a hash of its id and the seed, as a number in [0, 1), is below the fraction: the same for repeated rows, after a
    retry and at any partitioning. The targets are met but for the chance of the draw, by tokens. Rows without
    tokens (null or empty texts) in cells without any tokens are kept; an empty table gives no rows. Texts are read twice, in narrow
    passes, and don't move. Cells are joined by a broadcast only where Spark's measure of their size allows it.
    """
    docs = batched(docs)
    p = free_prefix(docs, [*MARGINS, "tokens", "probability", "copy", "seen"])
    names = [F.coalesce(F.col(m).cast("string"), F.lit("<null>")).alias(m) for m in ("source", "lang")]
    centroids = None
    if topic is None:
        seen = docs.select(*names, F.col(id_column).alias("id"), F.pandas_udf(_profiled, "tokens bigint, vector binary")(F.col(text_column)).alias("own"), *([tokens.cast("long").alias("given")] if tokens is not None else []))
        seen = staged(seen.select("source", "lang", "id", "own.vector", (F.col("given") if tokens is not None else F.col("own.tokens")).alias("tokens")), "mix-profiles")
        centroids = learn_topics(seen, "id")

        @F.pandas_udf("string")
        def cluster(vectors: pd.Series) -> pd.Series:
            return pd.Series(_named(nearest(np.frombuffer(b"".join(vectors), np.float32).reshape(-1, DIMENSIONS), centroids)))

        own = seen.select("source", "lang", cluster("vector").alias("topic"), "tokens")
    else:
        own = marked(docs, None, text_column, topic, tokens, p).select(*[F.col(f"{p}{m}").alias(m) for m in MARGINS], F.col(f"{p}tokens").alias("tokens"))
    cells = staged(own.groupBy(*MARGINS).agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")), "mix-cells")
    rows = marked(docs, centroids, text_column, topic, tokens, p)
    chosen = {m: (targets or {}).get(m) for m in MARGINS}
    found = staged(probabilities(rake(cells, chosen), budget).select(*[F.col(m).alias(f"{p}{m}") for m in MARGINS], F.col("probability").alias(f"{p}probability")), "mix-probability")
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(id_column)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    whole = F.floor(f"{p}probability")
    copies = (whole + (draw < F.col(f"{p}probability") - whole).cast("int")).cast("int")
    drawn = rows.join(found, [f"{p}{m}" for m in MARGINS]).where(copies > 0)
    return drawn.withColumn(f"{p}copy", F.explode(F.sequence(F.lit(1), copies))).select(*docs.columns, *[f"{p}{m}" for m in MARGINS], f"{p}tokens", f"{p}probability")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, topic, tokens and probability (the expected copies) of each drawn copy of a document."""
    kept = mix(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", *[F.col(f"_{m}").alias(m) for m in MARGINS], F.col("_tokens").alias("tokens"), F.col("_probability").alias("probability"))
