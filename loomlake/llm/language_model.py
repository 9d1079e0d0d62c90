"""Language-model scores by deleted interpolation of words, word pairs and word triples.

P(word | two words before) mixes the maximum-likelihood estimates count(triple) / count(pair before) and
count(pair) / count(word before) with a smoothed unigram estimate. All counts are of all training documents. The
mixing weights depend on how often the context was seen (a bucket for each power of two) and are learned by
expectation-maximisation on counts from which the token itself is deleted.

Every word, pair and triple is a 62-bit hash that carries its order. Documents are read in chunks of about CHUNK tokens; a chunk
sends each of its distinct hashes once, with its training count, to the task that adds up a range of hashes, and gets the sums
back in the same order. So a word with a third of all tokens is one number of each chunk. The chunk's tokens then
have their counts side by side, of which weights and scores are narrow maps.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.llm.common import batched, doc_crc, read, remembered, staged, works_for

ORDERS = 3
#: Added to each unigram count.
ADDED = 0.1
#: Tokens of a chunk, about (a longer document is one chunk), and bytes of text whose hashes one task adds up, about.
CHUNK, RANGE_BYTES = 1_000_000, 4 << 20
#: Cells to a doubling of an estimate's ratio, in the histogram that the weights are learned from; rounds of learning.
STEPS, ROUNDS = 2, 200
#: Least weight of the unigrams, so that no probability is zero.
LEAST = 1e-6
#: Buckets of contexts: by the count of the pair before; if there is none, LOWER + by the count of the word before.
LOWER, BUCKETS = 64, 128
#: Place of a ratio of one in the histogram; 0 stands for a ratio of zero.
MIDDLE = 1 << 9
_END = xxhash.xxh64_intdigest(b" end ")
_MEMO: dict[bytes, int] = remembered("language_model", {})
MEMO_WORDS = 400_000


def _hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the text's words and the end."""
    works_for("language_model")
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    get, out = _MEMO.get, []
    if len(_MEMO) > MEMO_WORDS:
        _MEMO.clear()
    for w in words:
        h = get(w)
        if h is None:
            h = _MEMO[w] = xxhash.xxh64_intdigest(w)
        out.append(h)
    out.append(_END)
    return np.array(out, np.uint64)


@dataclass
class Chunk:
    """Some whole documents."""

    number: int
    ids: pa.Array
    train: np.ndarray
    sizes: np.ndarray
    word: np.ndarray


def _chunks(batches):
    """batches: doc_id, text, train. Numbers follow the task and the order of its rows."""
    ids, train, words, size, number = [], [], [], 0, TaskContext.get().partitionId() << 32

    def chunk() -> Chunk:
        return Chunk(number, pa.concat_arrays(ids), np.array(train, bool), np.array([len(w) for w in words], np.int64), np.concatenate(words))

    for batch in batches:
        begin = 0
        for at, (x, t) in enumerate(zip(batch.column(1), batch.column(2).to_pylist(), strict=True)):
            train.append(t)
            words.append(_hashes(x.as_py()))
            size += len(words[-1])
            if size >= CHUNK:
                ids.append(batch.column(0).slice(begin, at + 1 - begin))
                yield chunk()
                ids, train, words, size, number, begin = [], [], [], 0, number + 1, at + 1
        if begin < batch.num_rows:
            ids.append(batch.column(0).slice(begin))
    if words:
        yield chunk()


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ a >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def _keys(word: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Keys of all tokens' words, then of their pairs, then of their triples; the two low bits are the order. Before a document there are end tokens."""
    starts = np.cumsum(sizes) - sizes
    end, keys, gram, before = np.uint64(_END), [], word, word
    for order in range(1, ORDERS + 1):
        if order > 1:
            before = np.concatenate(([end], before[:-1]))
            before[starts] = end
            gram = _mixed(before, gram)
        keys.append(gram & ~np.uint64(3) | np.uint64(order))
    return np.concatenate(keys)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, compressed: high bytes are mostly zero."""
    return pa.compress(np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<i8").ravel()


def _sorted_packed(x: np.ndarray) -> bytes:
    """Ascending unsigned numbers by their differences."""
    return _packed(np.diff(x, prepend=np.uint64(0)).view(np.int64))


def _sorted_unpacked(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpacked(data, n).view(np.uint64), dtype=np.uint64)


def counted(tokens: DataFrame) -> DataFrame:
    """A written row for each chunk: doc_ids, train, sizes; counts, its tokens' training counts as words, pairs and triples; types, of which the sum over all rows is the number of distinct training tokens.

    ``tokens`` (doc_id, text, train) is read twice. Chunks are known by their place in it, so its rows must come in the same
    order again, as rows read from files do; a chunk whose hashes don't agree fails.
    """
    kind = tokens.schema["doc_id"].dataType.simpleString()
    size = tokens.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(1, math.ceil(size / RANGE_BYTES))

    def ask(batches):
        for chunk in _chunks(batches):
            key, n = np.unique(_keys(chunk.word, chunk.sizes), return_inverse=True)
            n = np.bincount(n, np.tile(np.repeat(chunk.train, chunk.sizes), ORDERS), len(key)).astype(np.int64)
            of = ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            cuts = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of))
            parts = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(of[cuts[:-1]]), pa.array(np.full(len(parts), chunk.number)), pa.array(np.diff(cuts)), pa.array([_sorted_packed(key[p]) for p in parts], pa.binary()), pa.array([_packed(n[p]) for p in parts], pa.binary())],
                ["of", "chunk", "n", "keys", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_numpy()
        keys = [_sorted_unpacked(x.as_py(), n) for x, n in zip(table.column("keys"), sizes, strict=True)]
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        total = np.bincount(at, np.concatenate([_unpacked(x.as_py(), n) for x, n in zip(table.column("counts"), sizes, strict=True)]), len(key)).astype(np.int64)
        types = np.zeros(len(sizes), np.int64)
        types[0] = ((key & np.uint64(3) == 1) & (total > 0)).sum()
        ends = np.cumsum(sizes)
        counts = [_packed(total[at[e - n : e]]) for e, n in zip(ends, sizes, strict=True)]
        return pa.table([table.column("chunk"), table.column("of"), table.column("n"), pa.array(counts, pa.binary()), pa.array(types)], names=["chunk", "of", "n", "counts", "types"])

    def home(batches):
        """Documents and tokens of each chunk: words by their place in the chunk's own list, most frequent first."""
        for chunk in _chunks(batches):
            word, at, n = np.unique(chunk.word, return_inverse=True, return_counts=True)
            rank = np.empty(len(word), np.int64)
            rank[np.argsort(-n, kind="stable")] = np.arange(len(word))
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk.number]), pa.array([-1]), pa.array([len(word)]), pa.array([_sorted_packed(word)], pa.binary()), pa.array([_packed(rank)], pa.binary()), pa.array([_packed(rank[at])], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(chunk.ids)], pa.int32()), chunk.ids), pa.array([chunk.train.tolist()], pa.list_(pa.bool_())), pa.array([chunk.sizes], pa.list_(pa.int64()))],
                ["chunk", "of", "n", "words", "ranks", "tokens", "doc_ids", "train", "sizes"])

    def gathered(table: pa.Table) -> pa.Table:
        table = table.sort_by("of")
        own, parts = table.slice(0, 1), table.slice(1)
        sizes, n = own.column("sizes")[0].values.to_numpy(), own.column("n")[0].as_py()
        word = np.empty(n, np.uint64)
        word[_unpacked(own.column("ranks")[0].as_py(), n)] = _sorted_unpacked(own.column("words")[0].as_py(), n)
        word = word[_unpacked(own.column("tokens")[0].as_py(), int(sizes.sum()))]
        key, at = np.unique(_keys(word, sizes), return_inverse=True)
        sums = np.concatenate([_unpacked(x.as_py(), m) for x, m in zip(parts.column("counts"), parts.column("n").to_pylist(), strict=True)])
        if own.column("of")[0].as_py() != -1 or len(sums) != len(key):
            raise RuntimeError("the documents came in another order when they were read again")
        counts = pa.array([_packed(x) for x in np.split(sums[at], ORDERS)], pa.binary())
        return pa.table([own.column("doc_ids"), own.column("train"), own.column("sizes"), pa.ListArray.from_arrays(pa.array([0, ORDERS], pa.int32()), counts), pa.array([sum(parts.column("types").to_pylist())], pa.int64())], names=["doc_ids", "train", "sizes", "counts", "types"])

    asked = tokens.mapInArrow(ask, "of bigint, chunk bigint, n bigint, keys binary, counts binary")
    # written, so that the questions' shuffle is gone before the answers' begins
    answers = staged(asked.groupBy("of").applyInArrow(answer, "chunk bigint, of bigint, n bigint, counts binary, types bigint"), "lm-answers")
    homes = tokens.mapInArrow(home, f"chunk bigint, of bigint, n bigint, words binary, ranks binary, tokens binary, doc_ids array<{kind}>, train array<boolean>, sizes array<bigint>")
    both = homes.unionByName(answers, allowMissingColumns=True)
    return staged(both.groupBy("chunk").applyInArrow(gathered, f"doc_ids array<{kind}>, train array<boolean>, sizes array<bigint>, counts array<binary>, types bigint"), "lm-counts")


@dataclass
class Model:
    """A fixed size, whatever the corpus: the counts are with the tokens."""

    tokens: int
    types: int
    documents: int
    weights: np.ndarray | None = None  # bucket, order

    def unigram(self, count: np.ndarray, deleted: int = 0) -> np.ndarray:
        return (count - deleted + ADDED) / (self.tokens - deleted + ADDED * (self.types + 1))

    def contexts(self, counts: list[np.ndarray], sizes: np.ndarray) -> list[np.ndarray]:
        """How often the word before and the pair before were seen: their counts at the token before; before a document, the number of documents."""
        starts = np.cumsum(sizes) - sizes
        before = [np.concatenate(([0], c[:-1])) for c in counts[:-1]]
        for x in before:
            x[starts] = self.documents
        return before

    def mixed(self, counts: list[np.ndarray], before: list[np.ndarray]) -> np.ndarray:
        weight = self.weights[bucket(before)]
        return sum(weight[:, k] * counts[k] / np.maximum(before[k - 1], 1) for k in range(1, ORDERS)) + weight[:, 0] * self.unigram(counts[0])


def bucket(before: list[np.ndarray]) -> np.ndarray:
    """1 + floor(log2) of the pair's count; LOWER + that of the word's count (0: none) if the pair wasn't seen."""
    word, pair = (np.frexp(x.astype(float))[1] for x in before)
    return np.where(pair > 0, pair, LOWER + word)


def _rows(batches):
    """(doc_ids, train, sizes, counts by order) of each chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, train, sizes, counts = (batch.column(c)[i].values for c in range(4))
            sizes = sizes.to_numpy()
            yield ids, train.to_numpy(zero_copy_only=False).astype(bool), sizes, [_unpacked(x.as_py(), int(sizes.sum())) for x in counts]


def gather(counts: DataFrame) -> Model:
    """Totals of ``counted``'s rows, and the weights learned from a histogram of all training tokens.

    A cell is a bucket and the two deleted estimates' ratios to the deleted unigram estimate, in half-doublings; it has
    its tokens and their mean ratios, which the weights are learned from. Cells are at most BUCKETS times the
    square of the doublings that counts allow, and thousands in practice.
    """
    documents = F.size(F.filter("train", lambda x: x))
    tokens = F.aggregate(F.arrays_zip("train", "sizes"), F.lit(0).cast("long"), lambda n, x: n + F.when(x["train"], x["sizes"]).otherwise(F.lit(0).cast("long")))
    row = counts.agg(F.sum(tokens), F.sum("types"), F.sum(documents)).first()
    model = Model(int(row[0] or 0), int(row[1] or 0), int(row[2] or 0))

    def cells(batches):
        for _, train, sizes, own in _rows(batches):
            keep = np.repeat(train, sizes)
            before = [x[keep] - 1 for x in model.contexts(own, sizes)]
            own = [x[keep] for x in own]
            base = model.unigram(own[0], 1)
            ratios = [(own[k] - 1) / np.maximum(before[k - 1], 1) / base for k in range(1, ORDERS)]
            cell = bucket(before).astype(np.int64)
            for r in ratios:
                step = np.where(r > 0, MIDDLE + np.rint(np.log2(np.maximum(r, 1e-300)) * STEPS), 0).astype(np.int64)
                cell = cell << 10 | step
            cell, at = np.unique(cell, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.bincount(at, minlength=len(cell))), *[pa.array(np.bincount(at, r, len(cell))) for r in ratios]], ["cell", "n", "r2", "r3"])

    columns = ("doc_ids", "train", "sizes", "counts")
    found = counts.select(*columns).mapInArrow(cells, "cell bigint, n bigint, r2 double, r3 double").groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "r2", "r3")]).toPandas().sort_values("cell")
    n = found["n"].to_numpy(float)
    model.weights = learn(found["cell"].to_numpy(np.int64) >> 20, n, np.stack([np.ones(len(n)), found["r2"] / n, found["r3"] / n], axis=1) if len(n) else np.ones((0, ORDERS)))
    return model


def learn(of: np.ndarray, n: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Weights by bucket of cells of ``n`` tokens, by expectation-maximisation; a bucket without tokens takes the one's below, the lowest of each kind the unigrams alone."""
    weights = np.full((BUCKETS, ORDERS), 1.0 / ORDERS)
    total = np.bincount(of, n, BUCKETS)
    for _ in range(ROUNDS):
        part = weights[of] * ratios
        part *= (n / part.sum(1))[:, None] if len(n) else 1.0
        sums = np.stack([np.bincount(of, part[:, k], BUCKETS) for k in range(ORDERS)], axis=1)
        weights = np.where(total[:, None] > 0, sums / np.maximum(total, 1)[:, None], weights)
    for b in range(BUCKETS):
        if b in (0, LOWER):
            weights[b] = np.eye(ORDERS)[0]
        elif total[b] == 0:
            weights[b] = weights[b - 1]
        else:
            weights[b, 0] = max(weights[b, 0], LEAST)
            weights[b] /= weights[b].sum()
    return weights


def score(counts: DataFrame, model: Model) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, base_score, score) of each document in ``counted``'s rows: a narrow map."""
    kind = counts.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for ids, train, sizes, own in _rows(batches):
            starts = np.cumsum(sizes) - sizes
            base = np.log10(model.unigram(own[0]))
            mixed = np.log10(model.mixed(own, model.contexts(own, sizes)))
            known, base, mixed = (np.add.reduceat(x, starts) for x in ((own[0] > 0).astype(np.int64), base, mixed))
            yield pa.RecordBatch.from_arrays([ids, pa.array(train), pa.array(sizes), pa.array(known), pa.array(base), pa.array(mixed)], ["doc_id", "train", "n_tokens", "n_known", "base_score", "score"])

    return counts.select("doc_ids", "train", "sizes", "counts").mapInArrow(run, f"doc_id {kind}, train boolean, n_tokens bigint, n_known bigint, base_score double, score double")


def score_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every whole text.

    Learns from rows whose CRC-32 of the id as text is not 0 modulo 10 (null: the empty text's). Tokens: A-Z lower-cased words
    between ASCII white space, then one end token; null and empty texts have the end token alone. base_score: log10 probability
    by the unigrams; score: by the mixed model. Ids are of any type; equal rows each give a row and count each; other columns are not
    read; an empty table gives no rows, and without training rows the unigram estimate is even. A very long text is a chunk of
    its own, in one task's memory. ``docs`` is to be read from files (see ``counted``).
    """
    crc = F.pmod(doc_crc(F.col(id_column)), F.lit(10))
    tokens = batched(docs).select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), (crc != 0).alias("train"))
    counts = counted(tokens)
    model = gather(counts)
    return score(counts, model).select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))
