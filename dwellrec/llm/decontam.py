"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is found in a document when at least ``threshold`` of its distinct
five-word shingles occur there (containment, so the document may be of any
length). Items are partitioned by their number of shingles. Each partition has
its own sketch size k, the k smallest hashes of an item (bottom-k MinHash):
with u the largest size of the partition, k = ⌊(1-threshold)·u⌋ + 1. A document
that holds the share ``threshold`` of an item of n shingles misses at most
m = ⌊(1-threshold)·n⌋ of them, hence at least min(k, n) - m >= 1 of its sketch:
that count is the candidate test, and it loses no pair. Items larger than a document could
hold are pruned by size.

Documents are read once: a vectorised pass hashes every shingle of the whole
text and keeps those that a bit filter of the item shingles lets through, with
their text. The sketch join on these gives candidates, and candidates are
verified by the exact containment of shingle texts. Nothing is broadcast but
the filter: ``FILTER_SLOTS`` bits an item shingle, ``MAX_FILTER_BITS`` at most
(a fuller filter lets more through, and loses nothing).

Words are runs of letters and digits, lower-cased. An item of fewer than five
words is one shingle of all its words; documents are searched for shingles of
those lengths too, where items have them, so a short item is found wherever
its words stand in a row. Defined results: null, empty or wordless texts match
nothing; rows alike in id and text are one document; rows with equal id and
different texts are separate documents (the best containment is reported); equal items
are reported each; empty tables give an empty result; other columns are
ignored by ``contaminated`` and carried by ``drop_contaminated``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrec.llm.common import as_text, fresh, quoted
from dwellrec.session import materialize

WIDTH = 5
THRESHOLD = 0.8
FILTER_SLOTS = 32
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 20, 1 << 28
_WORD = re.compile(r"[^\W_]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_CACHE_WORDS = 1 << 18


class _WordHashes(dict):
    """word → 64-bit hash, emptied when it grows over a bound."""

    def __missing__(self, word):
        if len(self) >= _CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_codes(words: list[str], cache: dict) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_codes(h: np.ndarray, width: int) -> np.ndarray:
    """64-bit code of every shingle of ``width`` words, in order, from the words' codes."""
    if len(h) < width:
        return np.empty(0, dtype=np.uint64)
    n = len(h) - width + 1
    code = np.full(n, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        code = code * _MULT + h[i:i + n]
    code ^= code >> np.uint64(33)
    code *= _MIX
    return code ^ (code >> np.uint64(29))


def _shingle_text(words: list[str], at: int, width: int) -> str:
    return " ".join(words[at:at + width])


def item_shingles(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct shingles of every item: (item, shingle, code, width, n, rank); width
    is their number of words, rank the 0-based order of the code within the item
    (a bottom-k sketch is rank < k)."""
    t = as_text(text)
    src = items.select(F.struct(quoted(item_id).alias("id"), F.xxhash64(t).alias("tk")).alias("item"),
                       t.alias("t"))
    schema = "item struct<id: {}, tk: bigint>, shingle string, code long, width int, n int, rank int".format(
        src.schema["item"].dataType["id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordHashes()
        for b in batches:
            at, text_out, code_out, width_out, n_out, rank_out = [], [], [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                words = words_of(t)
                width = min(WIDTH, len(words))
                codes = shingle_codes(word_codes(words, cache), width) if words else np.empty(0, np.uint64)
                found = {_shingle_text(words, j, width): c for j, c in enumerate(codes.tolist())}
                for r, (s, c) in enumerate(sorted(found.items(), key=lambda x: (x[1], x[0]))):
                    at.append(i)
                    text_out.append(s)
                    code_out.append(c)
                    width_out.append(width)
                    n_out.append(len(found))
                    rank_out.append(r)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array(text_out, pa.string()),
                 pa.array(np.array(code_out, dtype=np.uint64).view(np.int64), pa.int64()),
                 pa.array(width_out, pa.int32()), pa.array(n_out, pa.int32()), pa.array(rank_out, pa.int32())],
                names=["item", "shingle", "code", "width", "n", "rank"])

    return src.distinct().mapInArrow(run, schema)


def size_partition(n, threshold: float = THRESHOLD):
    """(misses allowed, sketch size) columns for an item of ``n`` shingles; the
    partition's largest size is the next power of two."""
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double"))))
    slack = F.lit(1.0 - threshold + 1e-9)
    return (F.floor(slack * n).cast("int"),
            F.least(n, (F.floor(slack * upper) + 1).cast("int")))


def filter_bits(n: int) -> int:
    """Size of the filter for ``n`` shingles, a power of two."""
    return min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, 1 << (n * FILTER_SLOTS - 1).bit_length()))


def shingle_filter(codes: DataFrame, bits: int | None = None) -> np.ndarray:
    """Bit filter of the codes; at most bits/64 words reach the driver."""
    bits = bits or filter_bits(codes.count())
    slot = f"shiftrightunsigned(code, {65 - bits.bit_length()})"
    words = codes.groupBy(F.expr(f"shiftright({slot}, 6)").alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({slot} & 63 as int))")).alias("m"))
    out = np.zeros(bits // 64, dtype=np.int64)
    for r in words.toLocalIterator():
        out[r["w"]] = r["m"]
    return out.view(np.uint64)


def shingle_hits(docs: DataFrame, bitmap: np.ndarray, doc_id: str = "doc_id",
                 text: str = "text", widths: tuple[int, ...] = (WIDTH,)) -> DataFrame:
    """(doc, n_doc, shingle): the distinct shingles of ``widths`` words of every
    text that pass the filter; doc is struct(id, tk) with tk a hash of the text,
    n_doc the number of its shingles of five words (1 for a shorter text)."""
    spark = docs.sparkSession
    t = as_text(text)
    src = docs.select(F.struct(quoted(doc_id).alias("id"), F.xxhash64(t).alias("tk")).alias("doc"),
                      t.alias("t"))
    schema = "doc struct<id: {}, tk: bigint>, n_doc int, shingle string".format(
        src.schema["doc"].dataType["id"].dataType.simpleString())
    shift = np.uint64(64 - (len(bitmap) * 64).bit_length() + 1)
    shared = spark.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, bits = _WordHashes(), shared.value
        for b in batches:
            at, sizes, found = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                words = words_of(t)
                h, texts = word_codes(words, cache), set()
                for width in widths:
                    codes = shingle_codes(h, width)
                    slot = codes >> shift
                    hit = (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)
                    texts.update(_shingle_text(words, j, width) for j in np.flatnonzero(hit).tolist())
                if texts:
                    n = max(1, len(np.unique(shingle_codes(h, WIDTH))))
                    at += [i] * len(texts)
                    sizes += [n] * len(texts)
                    found += texts
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array(sizes, pa.int32()),
                 pa.array(found, pa.string())], names=["doc", "n_doc", "shingle"])

    return src.mapInArrow(run, schema)


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
            doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text") -> DataFrame:
    """(doc, item, n, matched): verified pairs, n the item's shingles and
    matched those found in the document."""
    grams = materialize(item_shingles(items, item_id, item_text), "item-shingles")
    widths = tuple(sorted(r[0] for r in grams.select("width").distinct().collect()))   # five at most
    hits = materialize(shingle_hits(docs, shingle_filter(grams.select("code")), doc_id, text, widths)
                       .distinct(), "shingle-hits")
    misses, k = size_partition(F.col("n"), threshold)
    sketch = (grams.withColumn("misses", misses).withColumn("k", k).where("rank < k")
              .select("item", "shingle", "n", (F.col("k") - F.col("misses")).alias("need")))
    pairs = (hits.join(sketch, "shingle")
             .where(F.col("n_doc") >= F.col("n") - F.floor(F.lit(1 - threshold + 1e-9) * F.col("n")))
             .groupBy("doc", "item").agg(F.count("*").alias("seen"), F.first("need").alias("need"))
             .where("seen >= need").select("doc", "item"))
    pairs = materialize(pairs, "containment-candidates")
    exact = (hits.join(grams.select("item", "shingle", "n"), "shingle")
             .join(pairs, ["doc", "item"])
             .groupBy("doc", "item").agg(F.first("n").alias("n"), F.count("*").alias("matched")))
    return exact.where(F.col("matched") >= F.lit(threshold - 1e-9) * F.col("n"))


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                 doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, item_shingles, matched, containment), one row per pair."""
    m = matches(docs, items, threshold, doc_id, text, item_id, item_text)
    best = m.groupBy("doc.id", "item.id").agg(
        F.max(F.struct((F.col("matched") / F.col("n")).alias("c"), "matched", "n")).alias("b"))
    return best.toDF("doc_id", "item_id", "b").select(
        "doc_id", "item_id", F.col("b.n").alias("item_shingles"), F.col("b.matched").cast("int").alias("matched"),
        F.col("b.c").alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                      doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``docs`` (all columns) without the rows that contain an item."""
    bad = materialize(matches(docs, items, threshold, doc_id, text, **kw)
                      .select("doc").distinct(), "contaminated")
    i, k = fresh(docs, "_bad_id"), fresh(docs, "_bad_tk")
    bad = bad.select(F.col("doc.id").alias(i), F.col("doc.tk").alias(k))
    return docs.join(bad, quoted(doc_id).eqNullSafe(F.col(i))
                     & (F.xxhash64(as_text(text)) == F.col(k)), "left_anti")
