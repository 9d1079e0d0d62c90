"""Language identification by nearest centroid.

A text is a unit vector of TF-IDF weights of letter trigrams (hashed bytes, word borders as spaces). Each
language has several centroids, found by spherical k-means on a bounded sample of labelled rows; document
frequencies come from all labelled rows. A text gets the language of the centroid with the largest
cosine, and is rejected where its distance is beyond the reach of texts of its length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomlake.llm.common import batched, doc_crc, read, staged, works_for

#: Buckets of hashed trigrams, centroids a language and of all languages about, labelled rows sampled for k-means: of all languages together, and of one at least.
BUCKETS, CENTROIDS, ALL_CENTROIDS, SAMPLE_ROWS, LEAST_ROWS = 8192, 4, 2_000, 2_000, 8
#: A text is rejected when its distance exceeds the sample's mean at its length by so many deviations.
REJECT_DEVIATIONS = 8.0
#: Least deviation that is used: small samples of very like texts must not reject everything else.
LEAST_DEVIATION = 0.03
UNKNOWN = "und"
_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))
_CHUNK = 1 << 22


def trigram_counts(text: str) -> np.ndarray:
    """Counts of the whole text's hashed trigrams: lower-cased, every byte that is no letter is a space, a window counts if its middle or both its ends are letters."""
    works_for("langid")
    data = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass").translate(_LETTERS), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data) - 2, _CHUNK):
        x = data[at : at + _CHUNK + 2].astype(np.uint32)
        a, b, c = x[:-2], x[1:-1], x[2:]
        keep = (b != 32) | ((a != 32) & (c != 32))
        hashed = (a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + c * np.uint32(0xC2B2AE3D)) >> np.uint32(19)
        counts += np.bincount(hashed[keep], minlength=BUCKETS)
    return counts


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Model:
    """A fixed number of small arrays, whatever the input's size."""

    languages: list[str]
    weights: np.ndarray  # of each bucket
    centroids: np.ndarray  # unit rows
    owner: np.ndarray  # language of each centroid
    mean: np.ndarray  # distance of sampled texts to their nearest centroid, by length class
    deviation: np.ndarray

    def vector(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts) * self.weights
        return (v / max(np.linalg.norm(v), 1e-12)).astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected)."""
        if not has_letter(text) or not len(self.languages):
            return UNKNOWN, 0.0, True
        counts = trigram_counts(text)
        cosines = self.centroids @ self.vector(counts)
        best, size = int(cosines.argmax()), length_class(counts)
        cosine = float(min(1.0, max(0.0, cosines[best])))
        return self.languages[self.owner[best]], cosine, 1 - cosine > self.mean[size] + REJECT_DEVIATIONS * self.deviation[size]


def length_class(counts: np.ndarray) -> int:
    return min(31, int(counts.sum()).bit_length())


def _k_means(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids: farthest-first start, then spherical k-means."""
    chosen = [int((vectors @ vectors.mean(0)).argmax())]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int((vectors @ vectors[chosen].T).max(1).argmin()))
    centroids = vectors[chosen]
    for _ in range(rounds):
        nearest = (vectors @ centroids.T).argmax(1)
        sums = np.stack([vectors[nearest == i].sum(0) if (nearest == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids.astype(np.float32)


def fit(labelled: DataFrame, text_column: str = "text", label_column: str = "lang", key: Column | None = None) -> Model:
    """Learn from rows with a text that has a letter and a label; ``key`` (default: the text) draws the sample.

    Document frequencies are summed in a shuffle over all rows. Each language gives its SAMPLE_ROWS / languages (LEAST_ROWS at
    least) rows of the least hashes of the key, all it has if fewer: no language is left out. Rows of one language and key
    are one. The model has 32 KB a centroid; where there are over ALL_CENTROIDS / CENTROIDS languages, each has fewer. Rows with a null or
    unlettered text or a null label take no part. No labelled rows: a model that answers ``und``.
    """
    rows = batched(labelled).select(F.col(text_column).alias("text"), F.col(label_column).alias("lang"), (key if key is not None else F.xxhash64(text_column)).alias("key")).where(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def frequencies(batches):
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for x in batch.column(0):
                if has_letter(text := x.as_py()):
                    total[:-1] += trigram_counts(text) > 0
                    total[-1] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    found = rows.select("text").mapInArrow(frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(BUCKETS + 1)
    for r in found:
        df[r["bucket"]] = r["n"]
    weights = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    hashed = rows.select("lang", F.shiftrightunsigned(F.xxhash64("key"), 1).alias("h"), "text")
    lettered = F.col("text").rlike(r"\p{L}")
    distinct = staged(hashed.where(lettered).select("lang", "h").distinct(), "langid-draw")
    sizes = {r["lang"]: r["count"] for r in distinct.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages or not df[-1]:
        return Model([], weights, np.zeros((0, BUCKETS), np.float32), np.zeros(0, int), np.zeros(32), np.ones(32))
    own = max(LEAST_ROWS, SAMPLE_ROWS // len(languages))
    # eight times as many as needed by their hash, so that no task sorts more of a language; then the least of them
    few = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(min((1 << 63) - 1, (1 << 63) * 8 * own // sizes[lang])))])[F.col("lang")]
    drawn = distinct.where(F.col("h") <= few).withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("n") <= own)
    last = {r["lang"]: r["h"] for r in drawn.groupBy("lang").agg(F.max("h").alias("h")).collect()}
    until = F.create_map(*[x for lang in last for x in (F.lit(lang), F.lit(last[lang]))])[F.col("lang")] if last else F.lit(None).cast("bigint")
    sampled = hashed.where(lettered & (F.col("h") <= until)).dropDuplicates(["lang", "h"])

    def counted(batches):
        for batch in batches:
            pairs = [(lang, np.flatnonzero(c), c) for lang, x in zip(batch.column(1).to_pylist(), batch.column(0), strict=True) if has_letter(text := x.as_py()) for c in [trigram_counts(text)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1].astype(np.int32) for p in pairs], pa.list_(pa.int32())), pa.array([p[2][p[1]].astype(np.int32) for p in pairs], pa.list_(pa.int32()))], ["lang", "buckets", "counts"])

    sample = sampled.select("text", "lang").mapInArrow(counted, "lang string, buckets array<int>, counts array<int>").toPandas()
    sample = sample.iloc[sorted(range(len(sample)), key=lambda i: (sample["lang"][i], list(sample["buckets"][i]), list(sample["counts"][i])))]
    model = Model(languages, weights, np.zeros((0, BUCKETS), np.float32), np.zeros(0, int), np.zeros(32), np.ones(32))
    centroids, owner, classes, distances = [], [], [], []
    for k, lang in enumerate(languages):
        own = sample[sample["lang"] == lang]
        vectors = np.zeros((len(own), BUCKETS), np.float32)
        for i, (at, n) in enumerate(zip(own["buckets"], own["counts"], strict=True)):
            counts = np.zeros(BUCKETS, np.int64)
            counts[at] = n
            vectors[i] = model.vector(counts)
            classes.append(length_class(counts))
        if len(own):
            centroids.append(_k_means(vectors, max(1, min(CENTROIDS, ALL_CENTROIDS // len(languages)))))
            owner += [k] * len(centroids[-1])
            distances.append(1 - (vectors @ centroids[-1].T).max(1))
    if not owner:
        return model
    model.centroids, model.owner = np.concatenate(centroids), np.array(owner)
    _reach(model, np.array(classes), np.concatenate(distances))
    return model


def _reach(model: Model, classes: np.ndarray, distances: np.ndarray) -> None:
    """Mean and deviation of the distance by length class; a class of few sampled texts takes its neighbours' as well."""
    for c in range(32):
        wide = next((w for w in range(32) if (abs(classes - c) <= w).sum() >= 20), 32)
        near = distances[abs(classes - c) <= wide]
        model.mean[c], model.deviation[c] = near.mean(), max(LEAST_DEVIATION, near.std())


def identify(docs: DataFrame, model: Model, id_columns: tuple[str, ...] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """(id columns, lang_pred, score, rejected) of every whole text: a narrow map, rows stay as they come.

    lang_pred: the nearest centroid's language, ``und`` (score 0, rejected) for a text that is null or has no
    letter. score: that cosine. rejected: too far from every centroid for a text of its length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: BUCKETS * (CENTROIDS * languages + 1) numbers

    def run(batches):
        own = shared.value
        for batch in batches:
            found = [own.predict(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            pred, score, rejected = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], [*id_columns, "lang_pred", "score", "rejected"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in id_columns)
    return batched(docs).select(*id_columns, F.col(text_column).alias("_text")).mapInArrow(run, f"{kinds}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text isn't rejected: it has a letter and is near a centroid for its length."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def near(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: not shared.value.predict(x)[2]).astype(bool)

    return batched(docs).where(near(F.col(text_column)))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", F.pmod(doc_crc(F.col("doc_id")), F.lit(3)) == 1)
    model = fit(docs.where(~F.col("held_out")), key=F.xxhash64("doc_id"))
    return identify(docs, model, ("doc_id", "held_out"))
