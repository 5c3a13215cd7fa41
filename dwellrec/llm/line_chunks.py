"""Line dedup by content-defined chunks (DataFrame functions only).

A text's lines are hashed; a rolling hash over ``window`` line hashes ends a
chunk wherever it is not 0 modulo ``divisor``, so chunks are short. Boundaries
depend on the nearby lines alone, so a passage shared by two texts is cut alike in
both, however far it is shifted. The units that are counted and compared are
every two adjacent chunks, and every chunk of two or more lines: a one-line chunk
takes part with each of its neighbours. A chunk is removed if a unit with it stands
at an earlier place.

1. Digests of all units are counted (map-side first), with the first occurrence
   of each: the least (doc_id, row key, position).
2. The positions of repeated digests are joined to the texts (the only shuffle
   of texts), and the result is written.
3. The bytes of every repeated unit meet those of its first occurrence; a
   unit whose bytes differ (a digest collision) is taken off the list.
4. The texts are cut again by the same expression and put together without the
   chunks of the units on the list. The first occurrence of a chunk always stays.

A digest held by a third of all rows: its narrow count row is broadcast (fewer
than ``partitions`` such digests exist), and its bytes are met over a salted
key with one salt per partition's share of rows.

Defined results: null text is the empty text, one line, never removed; null
ids come last among occurrences; rows alike in id and text share their fate; a
text whose chunks all go becomes empty; lines are split at \\n only, trailing
empty ones included; an empty table gives an empty result; other columns are
ignored by ``dedup_lines``. Texts are processed whole.

At the ends of a passage a chunk may be cut together with its neighbours there and
then stays (measured recall: README and tests). ``dedup_passages`` asks of every
two adjacent lines whether they stand together earlier, so every line of every
repeated run of two or more lines is found, wherever it starts and ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrec.llm.common import as_text, join_groups, partitions, quoted, row_key
from dwellrec.session import materialize

WINDOW = 2
DIVISOR = 16
MIN_LINES = 2
_BASE, _PRIME = 1000003, 2147483647


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint") % F.lit(_PRIME)


def _add_scaled(power: int):
    return lambda a, b: (a + b * F.lit(power)) % F.lit(_PRIME)


def chunked(rows: DataFrame, window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """rows (k, doc_id, t) → the same without t, with n_lines and chunks:
    ARRAY<STRUCT<pos, n, body>>. Arrays are projected one after the other, so
    that no lambda holds an expression over a whole array."""
    keep = [c for c in rows.columns if c != "t"]
    lines = rows.select(*keep, F.split("t", "\n", -1).alias("lines"))
    hashed = lines.select(*keep, "lines", F.transform("lines", _line_hash).alias("h"))
    roll, power = F.col("h"), 1
    for back in range(1, window):
        power = power * _BASE % _PRIME
        gap = F.array_repeat(F.lit(0).cast("bigint"), back)
        shifted = F.slice(F.concat(gap, F.col("h")), F.lit(1), F.size("h"))
        roll = F.zip_with(roll, shifted, _add_scaled(power))
    rolled = hashed.select(*keep, "lines", roll.alias("r"))
    cut = F.transform("r", lambda r, i: F.when(r % F.lit(divisor) != 0, i + 1).otherwise(0))
    ends = rolled.select(*keep, "lines", F.array_union(
        F.filter(cut, lambda e: e > 0), F.array(F.size("lines"))).alias("ends"))
    starts = F.concat(F.array(F.lit(1)), F.transform("ends", lambda e: e + 1))
    spans = ends.select(*keep, "lines", F.zip_with(
        F.slice(starts, F.lit(1), F.size("ends")), F.col("ends"),
        lambda s, e: F.struct(s.alias("s"), (e - s + 1).alias("n"))).alias("spans"))
    return spans.select(*keep, F.size("lines").alias("n_lines"), F.transform(
        "spans", lambda x, i: F.struct(
            i.alias("pos"), x["n"].alias("n"),
            F.array_join(F.slice("lines", x["s"], x["n"]), "\n").alias("body"))).alias("chunks"))


def _units(min_lines: int) -> Column:
    """The units of ``chunks``, at 2·pos the chunk with the next one and at 2·pos+1 the
    chunk alone, null where there is none."""
    after = F.concat(F.slice("chunks", F.lit(2), F.size("chunks")), F.array(F.lit(None)))

    def unit(pos, n, body):
        return F.struct(pos.alias("pos"), n.alias("n"), body.alias("body"))

    return F.flatten(F.zip_with("chunks", after, lambda c, d: F.array(
        F.when(d.isNotNull(), unit(c["pos"] * 2, c["n"] + d["n"], F.concat(c["body"], F.lit("\n"), d["body"]))),
        F.when(c["n"] >= min_lines, unit(c["pos"] * 2 + 1, c["n"], c["body"])))))


def _chunks_of(units: Column) -> Column:
    """Positions of the chunks in some units, ascending."""
    each = F.transform(units, lambda u: F.when(u % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))))
    both = F.zip_with(units, each, lambda u, add: F.transform(add, lambda x: (F.floor(u / 2) + x).cast("int")))
    return F.array_sort(F.array_distinct(F.flatten(both)))


def _aligned(entries: Column) -> Column:
    """(key, value) entries, ascending by key → an array with every value at its
    key and nulls between: merged with the chunks in one pass, where a lookup
    per chunk would take the square of a long text's chunks."""
    keys = F.transform(entries, lambda e: e["key"])
    before = F.slice(F.concat(F.array(F.lit(-1)), keys), F.lit(1), F.size(entries))
    return F.flatten(F.zip_with(entries, before, lambda e, b: F.concat(
        F.array_repeat(F.when(F.lit(False), e["value"]), e["key"] - b - 1), F.array(e["value"]))))


def _places(docs: DataFrame, min_lines: int, window: int, divisor: int) -> DataFrame:
    """(digest, at) of every unit."""
    # explode_outer: for explode, the optimizer would infer a filter on the
    # array's size and evaluate the whole cutting expression once more in it
    cut = chunked(docs, window, divisor).select("k", "doc_id", _units(min_lines).alias("units"))
    one = cut.select("k", "doc_id", F.explode_outer("units").alias("c"))
    return one.where(F.col("c.n") >= 2).select(
        F.unhex(F.md5("c.body")).alias("digest"),
        F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k", F.col("c.pos").alias("pos")).alias("at"))


def _candidates(docs: DataFrame, min_lines: int, window: int, divisor: int) -> DataFrame:
    """(k, refs): for each text with repeated digests, the map from a chunk's
    position to its digest, the digest's count and whether it is the first."""
    seen = materialize(_places(docs, min_lines, window, divisor), "chunk-digests")
    counts = materialize(seen.groupBy("digest").agg(F.count("*").alias("n"), F.min("at").alias("first"))
                         .where("n > 1"), "repeated-digests")
    total = counts.agg(F.sum("n")).first()[0] or 0
    refs = join_groups(seen, counts, ["digest"], "n", total)
    entry = F.struct(F.col("at.pos").alias("key"), F.struct(
        "digest", "n", (F.col("at") == F.col("first")).alias("is_first")).alias("value"))
    return materialize(refs.groupBy("at.k").agg(F.map_from_entries(F.collect_set(entry)).alias("refs")),
                       "chunk-candidates")


def _unequal(joined: DataFrame, min_lines: int, window: int, divisor: int) -> DataFrame:
    """(k, wrong): positions whose bytes differ from the digest's first unit."""
    cut = chunked(joined.where("refs is not null"), window, divisor).select(
        "k", "refs", _units(min_lines).alias("units"))
    found = F.zip_with("units", _aligned(F.array_sort(F.map_entries("refs"))), lambda c, r: F.struct(
        c["pos"].alias("pos"), c["body"].alias("body"), r.alias("ref")))
    found = F.filter(found, lambda c: c["ref"].isNotNull())
    rows = cut.select("k", F.explode_outer(found).alias("c")).select(
        "k", "c.pos", "c.body", "c.ref.digest", "c.ref.n", "c.ref.is_first")
    rows = materialize(rows, "candidate-chunks")
    limit = max(1, rows.count() // partitions(joined.sparkSession))
    salts = F.ceil(F.col("n") / F.lit(limit)).cast("int")
    # a row that is repeated whole brings its first chunks several times
    first = (rows.where("is_first").groupBy("digest", salts.alias("salts"))
             .agg(F.min("body").alias("first_body")).select("digest", "first_body", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    others = rows.where("not is_first").select(
        "digest", "body", "k", "pos", F.pmod(F.xxhash64("k", "pos"), salts).cast("int").alias("salt"))
    differ = others.join(first, ["digest", "salt"]).where("body <> first_body")
    return materialize(differ.groupBy("k").agg(F.collect_set("pos").alias("wrong")), "unequal-chunks")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                min_lines: int = MIN_LINES, window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_chunks, removed_chunks,
    removed_lines, text (without the removed chunks)."""
    src = docs.select(row_key(doc_id, text).alias("k"), quoted(doc_id).alias("doc_id"),
                      as_text(text).alias("t"))
    candidates = _candidates(src, min_lines, window, divisor)
    joined = materialize(src.join(candidates, "k", "left"), "texts-with-candidates")
    wrong = _unequal(joined.select("k", "doc_id", "t", "refs"), min_lines, window, divisor)
    cut = chunked(joined.join(wrong, "k", "left"), window, divisor)
    others = F.map_keys(F.map_filter("refs", lambda k, v: ~v["is_first"]))
    none = F.array().cast("array<int>")
    gone = F.array_except(F.coalesce(others, none), F.coalesce("wrong", none))
    parts = cut.select("doc_id", "n_lines", "chunks", gone.alias("units")).select(
        "doc_id", "n_lines", "chunks", _chunks_of(F.col("units")).alias("gone"))
    marks = F.transform(F.array_sort("gone"), lambda g: F.struct(g.alias("key"), F.lit(True).alias("value")))
    marked = F.zip_with("chunks", _aligned(marks), lambda c, g: F.struct(
        c["n"].alias("n"), c["body"].alias("body"), g.alias("gone")))
    parts = parts.select("doc_id", "n_lines", "gone", F.size("chunks").alias("n_chunks"), F.filter(
        marked, lambda c: c["gone"].isNull()).alias("kept"))
    left = F.aggregate("kept", F.lit(0), lambda s, c: s + c["n"])
    return parts.select("doc_id", "n_lines", "n_chunks", F.size("gone").alias("removed_chunks"),
                        (F.col("n_lines") - left).alias("removed_lines"),
                        F.array_join(F.transform("kept", lambda c: c["body"]), "\n").alias("text"))


def _pairs(docs: DataFrame) -> DataFrame:
    """(digest, at) of every two adjacent lines; lines hold no \\n, so the
    joined pair is unambiguous."""
    lines = docs.select("k", "doc_id", F.split("t", "\n", -1).alias("lines"))
    n = F.size("lines") - 1
    pairs = lines.select("k", "doc_id", F.zip_with(
        F.slice("lines", F.lit(1), n), F.slice("lines", F.lit(2), n),
        lambda a, b: F.unhex(F.sha2(F.concat_ws("\n", a, b), 256))).alias("pairs"))
    one = pairs.select("k", "doc_id", F.posexplode_outer("pairs").alias("pos", "digest"))
    return one.where("digest is not null").select("digest", F.struct(
        F.col("doc_id").isNull().alias("last"), "doc_id", "k", "pos").alias("at"))


def dedup_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_lines, removed_lines, text.

    A line goes if it stands, together with the line before or after it, at an
    earlier place (doc_id, row key, position). Every repeated run of two or more
    lines goes whole; the first occurrence of every line stays, and a line
    repeated in a row shrinks to one. Pairs are compared by SHA-256."""
    src = docs.select(row_key(doc_id, text).alias("k"), quoted(doc_id).alias("doc_id"),
                      as_text(text).alias("t"))
    seen = materialize(_pairs(src), "line-pairs")
    counts = materialize(seen.groupBy("digest").agg(F.count("*").alias("n"), F.min("at").alias("first"))
                         .where("n > 1"), "repeated-pairs")
    total = counts.agg(F.sum("n")).first()[0] or 0
    again = join_groups(seen, counts, ["digest"], "n", total).where("at <> first")
    again = materialize(again.groupBy("at.k").agg(F.collect_set("at.pos").alias("again")), "later-pairs")
    both = F.concat("again", F.transform("again", lambda p: p + 1))
    gone = F.transform(F.array_sort(F.array_distinct(F.coalesce(both, F.array().cast("array<int>")))),
                       lambda p: F.struct(p.alias("key"), F.lit(True).alias("value")))
    # the large-data plan at every size: the texts are shuffled once
    lines = src.join(again.hint("merge"), "k", "left").select(
        "doc_id", F.split("t", "\n", -1).alias("lines"), gone.alias("gone"))
    marked = lines.select("doc_id", F.size("lines").alias("n_lines"), F.size("gone").alias("removed_lines"),
                          F.zip_with("lines", _aligned(F.col("gone")), lambda x, g: F.struct(
                              x.alias("line"), g.alias("gone"))).alias("lines"))
    kept = F.transform(F.filter("lines", lambda x: x["gone"].isNull()), lambda x: x["line"])
    return marked.select("doc_id", "n_lines", "removed_lines", F.array_join(kept, "\n").alias("text"))


def dedup_passages_sql(docs: str = "documents") -> str:
    """The same in DuckDB for unique ids."""
    return f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {docs}),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM s),
p AS (SELECT *, line || chr(10) || lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS pair FROM l),
a AS (SELECT *, pair IS NOT NULL AND row_number() OVER (PARTITION BY pair ORDER BY doc_id, i) > 1
             AS again FROM p),
g AS (SELECT *, again OR lag(again, 1, false) OVER (PARTITION BY doc_id ORDER BY i) AS gone FROM a)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines,
       CAST(count(*) FILTER (gone) AS INTEGER) AS removed_lines,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
FROM g GROUP BY doc_id
"""


def dedup_lines_sql(docs: str = "documents") -> str:
    """The same in DuckDB for the default parameters and unique ids."""
    return f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {docs}),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM s),
h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) % {_PRIME} AS h FROM l),
r AS (SELECT *, (h + {_BASE} * lag(h, 1, 0) OVER (PARTITION BY doc_id ORDER BY i)) % {_PRIME}
             % {DIVISOR} <> 0 AS cut FROM h),
p AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM r),
c AS (SELECT doc_id, pos, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body
      FROM p GROUP BY doc_id, pos),
u AS (SELECT doc_id, 2 * pos AS unit, pos, 2 AS chunks,
             body || chr(10) || lead(body) OVER (PARTITION BY doc_id ORDER BY pos) AS body FROM c
      UNION ALL SELECT doc_id, 2 * pos + 1, pos, 1, body FROM c WHERE n >= {MIN_LINES}),
a AS (SELECT * FROM u WHERE body IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, unit) > 1),
x AS (SELECT DISTINCT doc_id, unnest(range(CAST(pos AS BIGINT), CAST(pos + chunks AS BIGINT))) AS pos FROM a),
g AS (SELECT c.*, x.pos IS NOT NULL AS gone FROM c LEFT JOIN x ON x.doc_id = c.doc_id AND x.pos = c.pos)
SELECT doc_id, CAST(sum(n) AS INTEGER) AS n_lines, CAST(count(*) AS INTEGER) AS n_chunks,
       CAST(count(*) FILTER (gone) AS INTEGER) AS removed_chunks,
       CAST(coalesce(sum(n) FILTER (gone), 0) AS INTEGER) AS removed_lines,
       coalesce(string_agg(body, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
FROM g GROUP BY doc_id
"""
