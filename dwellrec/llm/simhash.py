"""SimHash near-dedup by bit-sliced comparison.

Fingerprint: ASCII letters lower-cased, words split at ASCII white space,
3-word shingles (repeats included; fewer words: the whole sequence; none:
fingerprint 0), XXH64 with seed 42 of each; a bit is 1 if set in over half of
the hashes. Equal fingerprints are one vertex from then on.

Search for pairs at ``radius`` or fewer differing bits: the 64 bits are cut in
blocks, of which any such pair has some in common (pigeonhole), so equal keys
of block groups give all candidates. Keys get as many bits as keep a bucket
near ``BUCKET`` fingerprints at the table's size. Within a bucket the
candidates are stored vertically, one bit vector per bit plane. A query's bit
turns a plane into 64 differences per word; a carry-save counter (ones, twos,
overflow) adds the planes up for 64 distances at once; words in which all 64
counters are over the radius are abandoned. The links found are contracted to
a spanning forest inside the task, so a dense bucket never emits its pairs.
Buckets of over ``TILE`` fingerprints are cut in tiles, and each pair of tiles
is a task of its own.

Defined results: null text is the empty text; null ids are ignored when the
smallest id of a group is taken (null only if all are); repeated rows share a
fingerprint; an empty table gives an empty result; other columns are ignored by
``near_duplicates`` and carried by ``keep_one``; texts are read whole.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrec.llm.common import as_text, fresh, join_groups, quoted, row_key
from dwellrec.llm.components import components
from dwellrec.llm.digest_merge import one_per_key
from dwellrec.session import materialize

RADIUS = 3
SHINGLE = 3
HASH_SEED = 42
BUCKET = 1024
TILE = 8192
CHUNK = 256          # queries compared at a time
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)

# byte value -> its 8 bits as 8 byte-wide counters of one word
_SPREAD = np.array([int.from_bytes(bytes((v >> i) & 1 for i in range(8)), "little")
                    for v in range(256)], dtype=np.uint64)


def shingle_hashes(text: str, width: int = SHINGLE) -> list[int]:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, HASH_SEED)]
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = itertools.chain((0,), ends)
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b - 1], HASH_SEED) for a, b in zip(starts, ends[width - 1:])]


def majority_bits(hashes: list[int]) -> int:
    """Bit i of the result is set if it is set in over half of ``hashes``."""
    h = np.array(hashes, dtype=np.uint64)
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 255 * 256):
        rows = _SPREAD[h[at:at + 255 * 256].view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(rows, np.arange(0, len(rows), 255), axis=0)   # no byte overflows
        total += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * total > len(h)).tolist())


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    h = shingle_hashes(text or "", width)
    return majority_bits(h) if h else 0


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 width: int = SHINGLE, extra=()) -> DataFrame:
    """(doc_id, fp BIGINT, extra…) for every row; fp holds the 64 bits signed."""
    src = docs.select(quoted(doc_id).alias("doc_id"), *extra, as_text(text).alias("_t"))
    schema = src.drop("_t").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, width) for t in b.column(b.num_columns - 1).to_pylist()],
                           dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps, pa.int64())],
                                             names=schema.names)

    return src.mapInArrow(run, schema)


def key_masks(n: int, radius: int = RADIUS, bucket: int = BUCKET) -> list[int]:
    """Masks of block groups: two values within ``radius`` bits agree under at
    least one. Blocks are as coarse as the wanted key length allows."""
    want = max(0, math.ceil(math.log2(max(1, n) / bucket)))
    for blocks in range(radius + 1, radius + 5):
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        groups = list(itertools.combinations(range(blocks), blocks - radius))
        bits = [[i for g in group for i in range(cuts[g], cuts[g + 1])] for group in groups]
        if min(map(len, bits)) >= want:
            break
    return [sum(1 << i for i in b[:want]) for b in bits]


def planes(fps: np.ndarray) -> np.ndarray:
    """uint64 values → (64, words) bit planes; bit j of word w of plane i is bit
    i of value 64·w + j. Padding repeats the last value."""
    pad = -len(fps) % 64
    v = np.concatenate([fps, np.repeat(fps[-1:], pad)]) if pad else fps
    bits = np.unpackbits(v.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)


def near_words(queries: np.ndarray, vertical: np.ndarray, radius: int = RADIUS):
    """(query number, word number, bits): set bits are values of that word at
    ``radius`` or fewer differing bits from the query."""
    stages = max(1, radius).bit_length()            # counter bits below the overflow
    nq, nw = len(queries), vertical.shape[1]
    q, w = np.repeat(np.arange(nq), nw), np.tile(np.arange(nw), nq)
    # start the counters so that the overflow is set exactly at radius + 1
    lead = (1 << stages) - 1 - radius
    count = [np.full(nq * nw, FULL if (lead >> s) & 1 else 0, dtype=np.uint64)
             for s in range(stages)]
    over = np.zeros(nq * nw, dtype=np.uint64)
    for i in range(64):
        flip = (np.uint64(0) - ((queries >> np.uint64(i)) & np.uint64(1)))
        carry = vertical[i][w] ^ flip[q]
        for s in range(stages):
            count[s], carry = count[s] ^ carry, count[s] & carry
        over |= carry
        if i >= 11 and i % 4 == 3:
            alive = np.flatnonzero(over != FULL)
            if len(alive) < 0.8 * len(over):        # abandoned words leave
                q, w, over = q[alive], w[alive], over[alive]
                count = [c[alive] for c in count]
                if not len(q):
                    break
    hit = over != FULL
    return q[hit], w[hit], ~over[hit]


def _contract(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union the pairs (a, b) into ``parent`` (every entry points at its root)."""
    while True:
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        if not open_.any():
            return parent
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def links(fps: np.ndarray, n_left: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the near pairs between the first ``n_left`` values and
    the others, or among all values if ``n_left`` is their number."""
    left = fps[:n_left]
    base = 0 if n_left == len(fps) else n_left
    right = fps[base:]
    parent = np.arange(len(fps))
    if len(right):
        vertical = planes(right)
        for at in range(0, n_left, CHUNK):
            q, w, bits = near_words(left[at:at + CHUNK], vertical, radius)
            if not len(q):
                continue
            row, bit = np.nonzero(np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1,
                                                bitorder="little"))
            a, b = at + q[row], w[row] * 64 + bit
            real = b < len(right)
            parent = _contract(parent, a[real], base + b[real])
    child = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[child], fps[parent[child]]


def near_links(fps: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """Distinct fingerprints (fp) → edges (u, v) that join all near pairs."""
    masks = key_masks(n, radius)
    keyed = fps.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint"))
        for m in masks])).alias("tbl", "key"))
    keyed = materialize(keyed, "simhash-keys")
    sizes = keyed.groupBy("tbl", "key").agg(F.count("*").alias("m")).where("m > 1")
    sizes = materialize(sizes, "simhash-buckets")
    rows = join_groups(keyed, sizes, ["tbl", "key"], "m", n * len(masks))
    tiles = F.ceil(F.col("m") / F.lit(TILE)).cast("int")
    rows = rows.select("tbl", "key", "fp", tiles.alias("g"),
                       F.pmod(F.xxhash64("fp"), tiles).cast("int").alias("t"))
    rows = rows.select("tbl", "key", "fp", "t", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("o"))
    rows = rows.select("tbl", "key", F.least("t", "o").alias("lo"), F.greatest("t", "o").alias("hi"),
                       "t", "fp")

    def compare(unit: pa.Table) -> pa.Table:
        t = unit.column("t").to_numpy()
        fp = unit.column("fp").to_numpy().view(np.uint64)
        first = t == unit.column("lo")[0].as_py()
        ordered = np.concatenate([fp[first], fp[~first]])
        if unit.column("lo")[0] == unit.column("hi")[0] or not first.all():
            u, v = links(np.ascontiguousarray(ordered), int(first.sum()), radius)
        else:                                       # the other tile is empty
            u = v = ordered[:0]
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return (rows.groupBy("tbl", "key", "lo", "hi").applyInArrow(compare, "u long, v long"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    width: int = SHINGLE, radius: int = RADIUS, extra=()) -> DataFrame:
    """(doc_id, extra…, fingerprint, component_id) for every row; component_id
    is the smallest doc_id reachable over links, its own included."""
    out = _grouped(docs, doc_id, text, width, radius, extra)
    names = [c for c in out.columns if c not in ("doc_id", "fp", "root", "component_id")]
    return out.select("doc_id", *names, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")


def _grouped(docs: DataFrame, doc_id: str, text: str, width: int, radius: int, extra=()) -> DataFrame:
    """(doc_id, extra…, fp, root, component_id) for every row; root is a
    fingerprint of the group and names it, as component_id need not: ids may be
    null or repeated."""
    rows = materialize(fingerprints(docs, doc_id, text, width, extra), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("low"),
                                                  F.count("*").alias("copies")), "distinct-fps")
    n = distinct.count()
    roots = components(near_links(distinct.select("fp"), n, radius))
    rooted = materialize(distinct.join(roots, distinct["fp"] == roots["vertex"], "left")
                         .select("fp", "low", "copies", F.coalesce("root", "fp").alias("root")),
                         "rooted-fps")
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("_m"))
    groups = join_groups(rooted, materialize(lows, "component-ids"), ["root"], "_m", n)
    groups = materialize(groups.select("fp", "copies", "root", "component_id"), "fp-components")
    return join_groups(rows, groups, ["fp"], "copies", rows.count()).drop("copies")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` (all columns) with one row of each group of near duplicates: the
    one with the smallest id (null last; least row among several with that id)."""
    key = fresh(docs, "_rk")
    rows = _grouped(docs, doc_id, text, width, radius, [row_key(doc_id, text).alias("_rk")])
    # rows alike in id and text share a row key; they are counted before the choice
    alike = rows.groupBy("root", "doc_id", "_rk").agg(F.count("*").alias("_c"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_rk", "_c"))
    least = materialize(alike.groupBy("root").agg(best.alias("b"))
                        .select(F.col("b._rk").alias(key), F.col("b._c").alias("_c")), "kept-keys")
    rk = row_key(doc_id, text)
    alone = docs.join(least.where("_c = 1").select(key), rk == F.col(key), "left_semi")
    tied = docs.join(least.where("_c > 1").select(key), rk == F.col(key), "left_semi")
    return alone.unionByName(one_per_key(tied, rk))
