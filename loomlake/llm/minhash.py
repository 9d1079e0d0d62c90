"""One-permutation MinHash fingerprints with DataFrame functions only.

Each word shingle is hashed once; the hash's high bits name its bin and each bin keeps its least
hash. An empty bin borrows the value of a bin drawn by a fixed random sequence (optimal
densification), so equal sets agree in all bins and a bin of two sets agrees with the probability of their
Jaccard similarity. Each bin keeps its low-order bits only; likeness is corrected for the
agreement that so few bits have by chance.

All of a document's work is inside its row: an array of shingle hashes is sorted once, and the bins'
minima are its places where the bin changes (a sentinel for each bin makes all bins present).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomlake.llm.common import read

SHINGLE_WORDS = 5
#: 2 ** BIN_BITS bins, each with LOW_BITS bits.
BIN_BITS, LOW_BITS = 7, 8
BINS = 1 << BIN_BITS
SHIFT = 63 - BIN_BITS
#: Draws of a donor before the exact choice among all full bins is made, which has the same distribution.
DRAWS = 8
#: Rows of a range of ids, about; cuts that are sampled; ranges at most.
RANGE_ROWS, CUTS, MAX_RANGES = 1_000, 1_024, 1 << 20


def _draw(of: int, attempt: int) -> int:
    """The bin from which bin ``of`` borrows at its so-manieth attempt."""
    return int.from_bytes(hashlib.blake2b(f"{of} {attempt}".encode(), digest_size=8).digest(), "big") % BINS


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingle_hashes(text: Column, words_per_shingle: int = SHINGLE_WORDS) -> Column:
    """Array of even 63-bit hashes of the text's word shingles; a text of fewer words is one shingle, also an empty one."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def grams(h: Column) -> Column:
        n = F.size(h) - F.lit(words_per_shingle - 1)
        many = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(*[F.get(h, i + F.lit(k - 1)) for k in range(words_per_shingle)]))
        return many

    return F.transform(_let(hashed, grams), lambda x: F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(~1)))


def bin_minima(hashes: Column) -> Column:
    """Array of BINS values: each bin's least hash; an empty bin has its (odd) sentinel."""
    sentinels = F.array(*[F.lit(((i + 1) << SHIFT) - 1) for i in range(BINS)])
    ordered = F.sort_array(F.concat(hashes, sentinels))
    return _let(ordered, lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, SHIFT) != F.shiftright(F.get(s, i - 1), SHIFT))))


def densified(minima: Column) -> Column:
    """Empty bins (odd values) borrow from full ones."""
    draws = [F.array(*[F.lit(_draw(i, a)) for i in range(BINS)]) for a in range(DRAWS)]

    def full(x: Column) -> Column:
        return F.when(x.bitwiseAND(F.lit(1)) == 0, x)

    def fill(m: Column) -> Column:
        def borrow(x: Column, i: Column) -> Column:
            least = F.array_min(F.transform(F.filter(m, lambda y: y.bitwiseAND(F.lit(1)) == 0), lambda y: F.struct(F.xxhash64(F.shiftright(y, SHIFT), i).alias("order"), y.alias("value"))))
            return F.coalesce(full(x), *[full(F.get(m, F.get(d, i))) for d in draws], least["value"])

        return F.transform(m, borrow)

    return _let(minima, fill)


def packed(values: Column) -> Column:
    """Hex string of the bins' low-order bits."""
    digits = LOW_BITS // 4
    return F.array_join(F.transform(values, lambda x: F.lpad(F.hex(F.shiftright(x, 1).bitwiseAND(F.lit((1 << LOW_BITS) - 1))), digits, "0")), "")


def fingerprint(text: Column, words_per_shingle: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text: BINS * LOW_BITS bits in hex. Null counts as empty; an empty text has one (empty) shingle."""
    return F.lower(packed(densified(bin_minima(shingle_hashes(text, words_per_shingle)))))


def likeness(a: Column, b: Column) -> Column:
    """Estimate of the Jaccard similarity from two fingerprints, 0 to 1, corrected for chance agreement of LOW_BITS bits; null if one is null."""
    digits = LOW_BITS // 4
    same = F.aggregate(F.sequence(F.lit(1), F.lit(BINS * digits), F.lit(digits)), F.lit(0), lambda n, i: n + (F.substring(a, i, F.lit(digits)) == F.substring(b, i, F.lit(digits))).cast("int"))
    chance = 1.0 / (1 << LOW_BITS)
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - F.lit(chance)) / F.lit(1.0 - chance)))


def with_fingerprint(docs: DataFrame, text_column: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint beside its columns (a column of that name is replaced). A narrow, native map."""
    return docs.withColumn(name, fingerprint(F.col(text_column)))


def _ranges(id_column: str, cuts: list[int], parts: int) -> Column:
    """Range of an id, 0 for the largest: between sampled cuts, each cut again into ``parts`` of equal width. Null: ``parts`` more behind the last, by the hash ``_hash``."""
    key, n = F.col(id_column).cast("long"), len(cuts)
    nulls = F.lit((n + 1) * parts).cast("long") + F.pmod("_hash", F.lit(parts))
    if not cuts:
        return F.when(key.isNull(), nulls).otherwise(F.lit(0).cast("long"))
    edges = F.array(*[F.lit(x).cast("long") for x in cuts])
    above = F.size(F.filter(edges, lambda x: x > key))  # cuts above the id: 0 for the largest
    low, high = F.get(edges, F.lit(n - 1) - above), F.get(edges, F.lit(n) - above)
    width = high.cast("double") - low.cast("double")
    inner = F.when((above > 0) & (above < n), F.least(F.floor((high.cast("double") - key.cast("double")) / width * parts), F.lit(parts - 1))).otherwise(F.lit(0))
    return F.when(key.isNull(), nulls).otherwise(above.cast("long") * parts + F.greatest(inner, F.lit(0)))


def with_next(docs: DataFrame, columns: list[str], id_column: str = "doc_id", by: str | None = None) -> DataFrame:
    """(id, columns, next_* of columns): each row beside the next row by descending id; after the last comes the first.

    Ids (whole numbers) are cut into ranges at sampled quantiles; rows move once, to their range, and the first row
    of each range is also sent to the range before it, so that a window inside a range sees every row's
    successor. Rows of one id are ordered by a hash of the column ``by`` (None: of all ``columns``), then by ``columns``; null ids come last, in ranges by
    that hash. All rows of one id share a range. The firsts are broadcast: a row for each range, and ranges are at most 2 * MAX_RANGES.
    """
    rows = docs.count()
    n = min(CUTS, max(1, rows // RANGE_ROWS))
    parts = min(MAX_RANGES // CUTS, max(1, rows // (n * RANGE_ROWS)))
    cuts = docs.select(id_column).where(F.col(id_column).isNotNull()).approxQuantile(id_column, [i / n for i in range(n + 1)], 0.1 / n) if n > 1 else []
    own = docs.select(id_column, *columns).withColumns({"_hash": F.xxhash64(*([by] if by else columns)), "_down": F.bitwise_not(F.col(id_column).cast("long"))})
    ranged = own.withColumn("_range", _ranges(id_column, sorted({min(int(x), (1 << 63) - 1) for x in cuts}), parts))
    firsts = ranged.groupBy("_range").agg(F.min(F.struct("_down", "_hash")).alias("_first"))
    order = Window.orderBy("_range")  # over one row a range
    before = F.coalesce(F.lag("_range").over(order), F.max("_range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = firsts.select(F.col("_range").alias("_of"), F.col("_first._down").alias("_d"), F.col("_first._hash").alias("_h"), before.alias("_before"))
    same = (F.col("_range") == F.col("_of")) & F.col("_down").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h"))
    both = ranged.join(F.broadcast(firsts), same, "left")
    places = F.array_compact(F.array(F.struct(F.col("_range").alias("at"), F.lit(0).alias("guest")), F.when(F.col("_before").isNotNull(), F.struct(F.col("_before").alias("at"), F.lit(1).alias("guest")))))
    moved = both.select(id_column, *columns, "_down", "_hash", F.explode(places).alias("_place")).select(id_column, *columns, "_down", "_hash", "_place.at", "_place.guest")
    inside = Window.partitionBy("at").orderBy("guest", F.col("_down").asc_nulls_last(), "_hash", *columns)
    return moved.select(id_column, *columns, "guest", *[F.lead(c).over(inside).alias(f"next_{c}") for c in columns]).where("guest = 0").drop("guest")


def edited_likeness(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they and the next document's are.

    Edited text: the last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document by descending id (after the last: the first). Null texts count as empty; repeated rows each give
    a row; a lone row is its own next. Equal texts have equal fingerprints, and those a likeness of 1.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    # by the text alone, so that the ranges are found without fingerprints
    pairs = with_next(with_fingerprint(texts), ["text", "fingerprint"], by="text")
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    edited = pairs.select("doc_id", chars.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint", F.concat(F.substring("text", F.lit(1), chars - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    edited = edited.select("doc_id", "n_chars", "fingerprint", "next_fingerprint", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("edited")).alias("edited_fingerprint"))
    return edited.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(read(spark, sf_dir, "documents"))
