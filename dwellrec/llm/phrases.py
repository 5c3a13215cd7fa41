"""Phrase collocation mining by sorted count streams.

Phrases of 2 to 5 words that occur at least ``min_count`` times are scored
against their parts (n·a / (l·r), the least over all cuts) and the best of each
language are returned.

1. Tokens. Texts are cut into pieces and words once; each block of texts of one
   language is written as its word list and an array of word numbers.
2. Counts. Words first, then pairs, then phrases of 3 to 5 words. Every part of a
   frequent phrase is as frequent as the phrase, so a phrase is only counted where
   its parts (words, then pairs) pass a bit filter of the frequent ones. The
   filter has no false negatives, and what passes it wrongly falls to
   ``min_count``. A block's phrases are counted by sorting exact word numbers; they
   travel packed, a row per block and share of the phrases, and only a share's
   frequent phrases become rows.
3. Streams. The frequent phrases of all lengths are kept as one stream in suffix
   order (last word first) and one in prefix order. In such an order a phrase
   follows its own beginnings, so one pass in lockstep over the merged lengths
   gives every phrase the counts of all its beginnings (prefix order: left
   parts) or endings (suffix order: right parts). A phrase whose count equals
   that of its beginning or ending without one word covers it: these are the
   extension counts. Beginnings that lie in an earlier range of the sort (at
   most 4 a range) are looked up and joined back.
4. Results of both orders meet in prefix order; scores use unbounded integers.

The filter has ``FILTER_SLOTS`` bits an entry up to ``MAX_FILTER_BITS``; with more
entries the code space is cut in segments and the blocks are read once a segment.
A phrase covered by a longer one is covered by one of one word more with the same
count, so the two neighbouring lengths decide. Defined results: null texts are
empty; null languages are ``und`` (and join a language of that name); rows alike
in any column count each; no frequent phrase gives no rows; other columns are
ignored. Words may hold any character but the separators.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellrec.llm.common import as_text, partitions, quoted, wide_rows
from dwellrec.session import materialize

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
BLOCK_WORDS = 1 << 18
SHARE_WORDS = 1 << 20
STREAM_ROWS = 1 << 18          # rows a range of a sorted stream should hold
FILTER_SLOTS = 16
MAX_FILTER_BITS = 1 << 30
_PIECES = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
_MULT, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)


def tokens(text: bytes) -> list[bytes]:
    """Words of a text in order, with b"." between pieces."""
    return text.lower().translate(_PIECES).replace(b".", b" . ").split()


def token_blocks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, n, words, ids): blocks of the texts of one language. ``words`` are
    joined by \\n, ``ids`` are int32 word numbers with -1 between pieces, n counts
    the words in it."""
    src = docs.select(F.coalesce(quoted(lang).cast("string"), F.lit("und")).alias("lang"),
                      as_text(text).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict = {}

        def close(lang):
            vocab, parts, _ = open_.pop(lang)
            ids = np.concatenate(parts).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), pa.array([int((ids > 0).sum())], pa.int64()),
                 pa.array([b"\n".join(list(vocab)[1:])], pa.binary()),
                 pa.array([(ids - 1).astype("<i4").tobytes()], pa.binary())], names=["lang", "n", "words", "ids"])

        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1)):
                if lang not in open_:
                    vocab = defaultdict(count().__next__)
                    vocab[b"."]
                    open_[lang] = [vocab, [], 0]
                held = open_[lang]
                found = tokens(t.as_py())
                found.append(b".")
                held[1].append(np.fromiter(map(held[0].__getitem__, found), dtype=np.int32, count=len(found)))
                held[2] += len(found)
                if held[2] >= BLOCK_WORDS:
                    yield close(lang)
            # languages without bound do not pile up open blocks
            if sum(h[2] for h in open_.values()) > 4 * BLOCK_WORDS:
                for lang in list(open_):
                    yield close(lang)
        for lang in list(open_):
            yield close(lang)

    return src.mapInArrow(run, "lang string, n long, words binary, ids binary")


def _mixed(code: np.ndarray) -> np.ndarray:
    code = (code ^ (code >> np.uint64(33))) * _MIX
    return code ^ (code >> np.uint64(29))


def _word_codes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))


def _pair_codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(a * _MULT + b)


def phrase_codes(frequent: DataFrame, n: int) -> DataFrame:
    """(code) of the frequent phrases (lang, phrase) of ``n`` (1 or 2) words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, rows = b.column(0).to_pylist(), b.column(1).to_pylist()
            codes = [_word_codes(g, p.split(b" ")) for g, p in zip(langs, rows)]
            codes = np.array(codes, dtype=np.uint64).reshape(len(rows), n)
            out = codes[:, 0] if n == 1 else _pair_codes(codes[:, 0], codes[:, 1])
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], names=["code"])

    return frequent.select("lang", F.col("phrase").cast("binary")).mapInArrow(run, "code long")


def bit_filters(frequent: DataFrame, n: int) -> list[np.ndarray]:
    """One bit filter for each segment of the code space (one up to
    ``MAX_FILTER_BITS`` / ``FILTER_SLOTS`` phrases)."""
    entries = frequent.count()
    segments = max(1, -(-entries * FILTER_SLOTS // MAX_FILTER_BITS))
    bits = min(MAX_FILTER_BITS, 1 << max(16, (entries * FILTER_SLOTS // segments).bit_length()))
    codes = phrase_codes(frequent, n)
    slot = F.expr(f"shiftrightunsigned(code, {65 - bits.bit_length()})")
    segment = F.expr(f"cast((code & 65535) % {segments} as int)")
    words = codes.groupBy(segment.alias("s"), F.shiftright(slot, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(code, {65 - bits.bit_length()}) & 63 as int))"))
        .alias("m"))
    out = [np.zeros(bits // 64, dtype=np.int64) for _ in range(segments)]
    for r in words.toLocalIterator():
        out[r["s"]][r["w"]] = r["m"]
    return [x.view(np.uint64) for x in out]


def _passes(codes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    slot = codes >> np.uint64(65 - (len(bitmap) * 64).bit_length())
    return (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _counted(lang: str, words: list[bytes], codes: np.ndarray, ids: np.ndarray, at: np.ndarray, n: int,
             shares: int) -> pa.RecordBatch:
    """(lang, share, phrases, counts) of the phrases of ``n`` words that start at
    ``at``, a row per share: equal ones meet by sorting exact numbers, a word at a
    time, so that neighbours begin alike."""
    key = ids[at].astype(np.int64)
    for j in range(1, n):
        key = key * len(words) + ids[at + j]
        if j < n - 1:
            key = np.unique(key, return_inverse=True)[1]
    _, first, f = np.unique(key, return_index=True, return_counts=True)
    at = at[first]
    code = codes[ids[at]]
    for j in range(1, n):
        code = _pair_codes(code, codes[ids[at + j]])
    share = (_mixed(code) % np.uint64(shares)).astype(np.int64)
    order = np.argsort(share, kind="stable")
    held, lo = np.unique(share[order], return_index=True)
    ends = [*lo[1:].tolist(), len(order)]
    where = at[order].tolist()
    text = [b" ".join([words[i] for i in ids[p:p + n].tolist()]) for p in where]
    count = f[order].astype("<u4")
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(held), pa.string()), pa.array(held, pa.int64()),
         pa.array([b"\n".join(text[i:j]) for i, j in zip(lo.tolist(), ends)], pa.binary()),
         pa.array([count[i:j].tobytes() for i, j in zip(lo.tolist(), ends)], pa.binary())],
        names=["lang", "share", "phrases", "counts"])


def _block(row) -> tuple[str, list[bytes], np.ndarray]:
    return row["lang"], row["words"].split(b"\n"), np.frombuffer(row["ids"], dtype="<i4")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {c: b.column(c)[i].as_py() for c in ("lang", "words", "ids")}


_PACKED = "lang string, share long, phrases binary, counts binary"


def shares_of(blocks: DataFrame) -> int:
    """Shares of the phrases, of about a million phrases or fewer."""
    words = blocks.agg(F.sum("n")).first()[0] or 0
    return max(words // SHARE_WORDS, min(32, partitions(blocks.sparkSession))) + 1


def _frequent(packed: DataFrame, min_count: int) -> DataFrame:
    """(lang, phrase, f) with f >= ``min_count`` from the packed counts."""
    def one(unit: pa.Table) -> pa.Table:
        lang = unit.column("lang")[0].as_py()
        text = [t for x in unit.column("phrases").to_pylist() for t in x.split(b"\n")]
        f = np.frombuffer(b"".join(unit.column("counts").to_pylist()), dtype="<u4").astype(np.int64)
        met = pa.table({"phrase": pa.array(text, pa.binary()), "f": f}).group_by("phrase").aggregate([("f", "sum")])
        met = met.filter(pa.array(met.column("f_sum").to_numpy() >= min_count))
        return pa.table({"lang": pa.array([lang] * len(met), pa.string()), "phrase": met.column("phrase"),
                         "f": met.column("f_sum")})

    return (packed.groupBy("lang", "share").applyInArrow(one, "lang string, phrase binary, f long")
            .withColumn("phrase", F.col("phrase").cast("string")))


def word_counts(blocks: DataFrame, min_count: int, shares: int) -> DataFrame:
    """(lang, phrase, f) of the words with f >= ``min_count``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            lang, words, ids = _block(row)
            yield _counted(lang, words, _word_codes(lang, words), ids, np.flatnonzero(ids >= 0), 1, shares)

    return _frequent(blocks.mapInArrow(run, _PACKED), min_count)


def _at_segment(codes: np.ndarray, segment: int, segments: int) -> np.ndarray:
    if segments == 1:
        return np.ones(len(codes), dtype=bool)
    return (codes.view(np.int64) & 65535) % segments == segment


def longer_counts(blocks: DataFrame, filters: list[np.ndarray], known: int, longest: int, min_count: int,
                  shares: int) -> DataFrame:
    """(lang, phrase, f) of the phrases of ``known`` + 1 to ``longest`` words with
    f >= ``min_count`` all of whose parts of ``known`` (1 or 2) words pass the filter;
    with several segments a phrase is counted in that of its first part, which alone
    must pass."""
    spark = blocks.sparkSession
    out = None
    for segment, bitmap in enumerate(filters):
        shared = spark.sparkContext.broadcast(bitmap)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, segment=segment,
                segments=len(filters)) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                lang, words, ids = _block(row)
                if len(ids) <= known:
                    continue
                codes = _word_codes(lang, words)
                code = codes[ids]                              # -1 picks any word, masked below
                inside = ids >= 0
                if known == 2:
                    code, inside = _pair_codes(code[:-1], code[1:]), inside[:-1] & inside[1:]
                good = inside & _passes(code, shared.value)
                first = good & _at_segment(code, segment, segments)
                rest = good if segments == 1 else inside
                run_of = first
                for n in range(known + 1, longest + 1):
                    # parts at i … i+n-known; the first in this segment
                    run_of = run_of[:-1] & rest[n - known:]
                    at = np.flatnonzero(run_of)
                    if not len(at):
                        break
                    yield _counted(lang, words, codes, ids, at, n, shares)

        rows = blocks.mapInArrow(run, _PACKED)
        out = rows if out is None else out.unionByName(rows)
    return _frequent(out, min_count)


def count_streams(blocks: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST):
    """(stream, totals): lang, words, f of all phrases with f >= ``min_count``, and
    the word count n of every language."""
    spark, shares = blocks.sparkSession, shares_of(blocks)
    totals = materialize(blocks.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"), "lang-words")
    with wide_rows(spark):
        levels = [materialize(word_counts(blocks, min_count, shares), "word-counts")]
    for known, upto in ((1, 2), (2, longest)):
        if known < longest:
            filters = bit_filters(levels[-1], known)
            with wide_rows(spark):
                more = longer_counts(blocks, filters, known, upto, min_count, shares)
                levels.append(materialize(more, "phrase-counts"))
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out.select("lang", F.split("phrase", " ", -1).alias("words"), "f"), totals


def parts_of(stream: DataFrame) -> DataFrame:
    """stream (lang, words, f) → the same with parts ARRAY<BIGINT>, the counts of
    the first 1, 2, … words. One sort, one pass in lockstep over all lengths."""
    stream = materialize(stream, "count-stream")
    ranges = stream.count() // STREAM_ROWS + 1
    ranges = max(ranges, min(partitions(stream.sparkSession), 8))
    ordered = (stream.repartitionByRange(ranges, "lang", "words").sortWithinPartitions("lang", "words")
               .select(F.spark_partition_id().alias("pid"), "lang", "words", "f"))
    schema = "pid int, lang string, words array<string>, f long, parts array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, path, counts = None, [], []            # the open beginnings
        for b in batches:
            langs, words, fs = (b.column(i).to_pylist() for i in (1, 2, 3))
            parts = []
            for g, w, f in zip(langs, words, fs):
                if g != lang:
                    lang, path, counts = g, [], []
                keep = 0
                while keep < len(path) and keep < len(w) - 1 and path[keep] == w[keep]:
                    keep += 1
                del path[keep:], counts[keep:]
                # beginnings in an earlier range stay open, with unknown counts
                path += w[keep:]
                counts += [None] * (len(w) - 1 - keep) + [f]
                parts.append(counts[:-1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(parts, pa.list_(pa.int64()))], names=["pid", "lang", "words", "f", "parts"])

    passed = materialize(ordered.mapInArrow(run, schema), "lockstep")
    # beginnings that stand in an earlier range: at most 4 for each range
    gaps = passed.where(F.exists("parts", lambda x: x.isNull())).select("pid", "lang", F.explode(F.filter(
        F.transform("parts", lambda x, i: F.when(x.isNull(), F.slice("words", F.lit(1), i + 1))),
        lambda x: x.isNotNull())).alias("words")).distinct()
    known = gaps.join(stream, ["lang", "words"]).groupBy("pid").agg(F.map_from_entries(F.collect_list(
        F.struct(F.size("words").alias("at"), "f"))).alias("known"))
    filled = F.transform("parts", lambda x, i: F.coalesce(x, F.element_at("known", i + 1)))
    return passed.join(F.broadcast(known), "pid", "left").select("lang", "words", "f", filled.alias("parts"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                 longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases."""
    blocks = materialize(token_blocks(docs, text, lang), "token-blocks")
    stream, totals = count_streams(blocks, min_count, longest)
    stream = materialize(stream, "frequent-phrases")
    lefts = materialize(parts_of(stream), "prefix-order")
    rights = materialize(parts_of(stream.withColumn("words", F.reverse("words"))), "suffix-order")

    def covered(side: DataFrame) -> DataFrame:
        """The phrases that a phrase of one word more covers, in the side's order."""
        n = F.size("words")
        return side.where((n > 2) & (F.get("parts", n - 2) == F.col("f"))).select(
            "lang", F.slice("words", F.lit(1), n - 1).alias("words"))

    nothing = F.lit(None).cast("array<bigint>")
    rows = (lefts.select("lang", "words", "f", F.col("parts").alias("lefts"), nothing.alias("rights"))
            .unionByName(rights.select("lang", F.reverse("words").alias("words"), "f", nothing.alias("lefts"),
                                       F.col("parts").alias("rights"))))
    marks = covered(lefts).unionByName(covered(rights).select("lang", F.reverse("words").alias("words")))
    rows = rows.withColumn("gone", F.lit(0)).unionByName(
        marks.withColumn("gone", F.lit(1)), allowMissingColumns=True).where(F.size("words") > 1)
    ranges = rows.count() // STREAM_ROWS + min(partitions(docs.sparkSession), 8)
    met = rows.repartitionByRange(ranges, "lang", "words").groupBy("lang", "words").agg(
        F.max("f").alias("a"), F.max("lefts").alias("lefts"), F.max("rights").alias("rights"),
        F.max("gone").alias("gone")).where("gone = 0")
    scored = materialize(_scored(met.join(totals, "lang")), "scored-phrases")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # in two levels: no task holds the best rows of all parts of a large language
    salt = F.pmod(F.xxhash64("phrase"), F.lit(partitions(docs.sparkSession)))
    some = (scored.withColumn("salt", salt)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
            .where(F.col("rank") <= top).drop("salt"))
    best = (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top))
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def best_cut(a: int, n: int, lefts: list[int], rights: list[int]) -> tuple[int, int, int]:
    """(score, l, r) of the lowest-scoring cut, the first of equal ones; ``lefts``
    are the counts of the first 1, 2, … words, ``rights`` of the last ones."""
    cuts = enumerate(zip(lefts, reversed(rights)))
    score, _, x, y = min((1000 * a * n // (x * y), k, x, y) for k, (x, y) in cuts)
    return score, x, y


def _scored(rows: DataFrame) -> DataFrame:
    src = rows.select("lang", F.array_join("words", " ").alias("phrase"), "a", "n", "lefts", "rights")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, n, lefts, rights = (b.column(i).to_pylist() for i in (2, 3, 4, 5))
            cuts = [best_cut(*x) for x in zip(a, n, lefts, rights)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], *(pa.array([c[i] for c in cuts], pa.int64()) for i in range(3))],
                names=["lang", "phrase", "a", "n", "score", "l", "r"])

    return src.mapInArrow(run, "lang string, phrase string, a long, n long, score long, l long, r long")


def collocations_sql(docs: str = "documents") -> str:
    """The same in DuckDB, for the default parameters."""
    grams = " UNION ALL ".join(
        f"SELECT lang, array_to_string(w[i:i + {n - 1}], ' ') AS p, {n} AS k FROM starts WHERE i + {n - 1} <= len(w)"
        for n in range(1, LONGEST + 1))
    return f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM {docs}),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
ws AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM ws),
f AS MATERIALIZED (SELECT lang, p, k, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING k = 1 OR f >= {MIN_COUNT}),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, p, k, f AS a, string_split(p, ' ') AS w FROM f WHERE k > 1),
longer AS (SELECT DISTINCT lang, array_to_string(w[s:s + m - 1], ' ') AS p, a FROM
  (SELECT *, unnest(range(1, k - m + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS m FROM cand))),
kept AS (SELECT c.* FROM cand c ANTI JOIN longer x ON x.lang = c.lang AND x.p = c.p AND 100 * x.a >= 100 * c.a),
cuts AS (SELECT *, array_to_string(w[1:j], ' ') AS lp, array_to_string(w[j + 1:], ' ') AS rp FROM
  (SELECT *, unnest(range(1, k)) AS j FROM kept)),
s AS (SELECT c.lang, c.p, c.a, c.j, x.f AS l, y.f AS r, n.n,
        (1000 * c.a::HUGEINT * n.n) // (x.f::HUGEINT * y.f) AS score
      FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.lp JOIN f y ON y.lang = c.lang AND y.p = c.rp
      JOIN n ON n.lang = c.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM b)
SELECT lang, rank, p AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM o WHERE rank <= {TOP}
"""
