"""Packing into optimal length buckets.

The global histogram of text lengths (words) decides where the bucket
boundaries lie: a dynamic programme over its distinct lengths finds the at most
``n_buckets`` boundaries with the least padding, where every text is padded to
its bucket's boundary. Inside a bucket, texts in order of (length, id) form
batches that hold as many padded texts as the token budget allows (at least
one, so a text longer than the budget is a batch of its own, whole).

The histogram is the only thing that reaches the driver: m distinct lengths
need m²/2 words in the table, so m stays below √(2 · words of the table). The
programme is a hull of lines, O(m) per bucket, in exact integers; among equal
optima the boundary further left wins. Positions come from a range-partitioned
ordinal of (length, id) rows without texts.

Defined results: null, empty and wordless texts have length 0; null ids come
first among equal lengths; repeated rows are separate texts in any order; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrec.llm.common import as_text, ordinal, quoted
from dwellrec.session import materialize

N_BUCKETS = 8
TOKEN_BUDGET = 16384
WORD = "[^ \\t\\n\\r]+"      # the same in Java and RE2


def word_count(text: str = "text") -> Column:
    return F.regexp_count(as_text(text), F.lit(WORD)).cast("int")


def boundaries(histogram: list[tuple[int, int]], n_buckets: int = N_BUCKETS) -> list[int]:
    """(length, count) ascending → ascending boundaries with the least padding.

    With S and C the running sums of length·count and count, bucket (i, j] pads
    L_j·(C_j - C_i) - (S_j - S_i), so a layer of the programme is the lower
    envelope of the lines best(i) + S_i - C_i·x taken at x = L_j.
    """
    lengths = [int(h[0]) for h in histogram]
    if not lengths:
        return []
    m = len(lengths)
    count, mass = [0], [0]
    for length, n in histogram:
        count.append(count[-1] + int(n))
        mass.append(mass[-1] + int(length) * int(n))
    best = [0] + [None] * m               # zero buckets cover zero lengths
    chosen = []
    for _ in range(min(n_buckets, m)):
        layer, choice = [None] * (m + 1), [0] * (m + 1)
        hull, at = [], 0                  # (slope, intercept, i), slopes falling
        for j in range(1, m + 1):
            i = j - 1
            if best[i] is not None:
                s, b = -count[i], best[i] + mass[i]
                while len(hull) - at >= 2:
                    (s1, b1, _), (s2, b2, _) = hull[-2], hull[-1]
                    if (b - b1) * (s1 - s2) <= (b2 - b1) * (s1 - s):
                        hull.pop()
                    else:
                        break
                hull.append((s, b, i))
            x = lengths[j - 1]
            while len(hull) - at >= 2 and (hull[at + 1][0] * x + hull[at + 1][1]
                                           < hull[at][0] * x + hull[at][1]):
                at += 1
            if len(hull) > at:
                s, b, i = hull[at]
                layer[j], choice[j] = s * x + b + x * count[j] - mass[j], i
        best = layer
        chosen.append(choice)
    out, j = [], m
    for choice in reversed(chosen):
        out.append(lengths[j - 1])
        j = choice[j]
    return out[::-1]


def pack(docs: DataFrame, n_buckets: int = N_BUCKETS, token_budget: int = TOKEN_BUDGET,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: doc_id, n_tokens, bucket, boundary, batch (within the
    bucket), slot (within the batch), padding."""
    lens = materialize(docs.select(quoted(doc_id).alias("doc_id"),
                                   word_count(text).alias("n_tokens")), "token-lengths")
    hist = sorted((r[0], r[1]) for r in lens.groupBy("n_tokens").count().collect())
    cuts = boundaries(hist, n_buckets) or [0]
    before = [sum(c for n, c in hist if n <= cut) for cut in [-1, *cuts[:-1]]]
    placed = ordinal(lens, ["n_tokens", "doc_id"])
    bucket = F.lit(len(cuts) - 1)
    for i in reversed(range(len(cuts) - 1)):
        bucket = F.when(F.col("n_tokens") <= cuts[i], F.lit(i)).otherwise(bucket)

    def per_bucket(values):
        return F.element_at(F.from_json(F.lit(json.dumps(values)), "array<bigint>"),
                            F.col("bucket") + 1)

    placed = placed.withColumn("bucket", bucket)
    placed = placed.withColumn("rank", F.col("_ix") - per_bucket(before))
    placed = placed.withColumn("cap", per_bucket([max(1, token_budget // max(1, c)) for c in cuts]))
    return placed.select(
        "doc_id", "n_tokens", "bucket", per_bucket(cuts).cast("int").alias("boundary"),
        F.expr("rank div cap").alias("batch"), F.expr("cast(rank % cap as int)").alias("slot"),
        (per_bucket(cuts) - F.col("n_tokens")).cast("int").alias("padding"))


def pack_sql(n_buckets: int = N_BUCKETS, token_budget: int = TOKEN_BUDGET,
             docs: str = "documents") -> str:
    """The same result in DuckDB SQL: the programme as one CTE per layer."""
    layers = [f"""b1 AS (SELECT j, l * c - s AS v, 0 AS i FROM h)"""]
    for k in range(2, n_buckets + 1):
        layers.append(f"""b{k} AS (
  SELECT y.j, min(struct_pack(v := p.v + y.l * (y.c - x.c) - (y.s - x.s), i := x.j)).v AS v,
         min(struct_pack(v := p.v + y.l * (y.c - x.c) - (y.s - x.s), i := x.j)).i AS i
  FROM h y JOIN h x ON x.j < y.j JOIN b{k - 1} p ON p.j = x.j GROUP BY y.j)""")
    # walk back from the last length; layers deeper than the number of lengths are empty
    walk = []
    for k in range(n_buckets, 0, -1):
        seed = (f"SELECT least(max(j), {n_buckets}) AS k, max(j) AS j FROM h" if k == n_buckets else
                f"SELECT w.k, CASE WHEN w.k > {k} THEN b.i ELSE w.j END AS j "
                f"FROM w{k + 1} w LEFT JOIN b{k + 1} b ON b.j = w.j")
        walk.append(f"w{k} AS ({seed})")
    ends = " UNION ".join(f"SELECT j FROM w{k} WHERE j > 0" for k in range(1, n_buckets + 1))
    return f"""
WITH lens AS (SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS INTEGER)
              AS n_tokens FROM {docs}),
g AS (SELECT n_tokens AS l, count(*) AS n FROM lens GROUP BY 1),
h AS (SELECT row_number() OVER (ORDER BY l) AS j, CAST(l AS BIGINT) AS l,
             CAST(sum(n) OVER (ORDER BY l) AS BIGINT) AS c,
             CAST(sum(n * l) OVER (ORDER BY l) AS BIGINT) AS s FROM g),
{", ".join(layers)},
{", ".join(walk)},
ends AS ({ends}),
cuts AS (SELECT CAST(row_number() OVER (ORDER BY h.l) - 1 AS INTEGER) AS bucket,
                CAST(h.l AS INTEGER) AS boundary,
                coalesce(lag(h.l) OVER (ORDER BY h.l), -1) AS low FROM ends JOIN h USING (j)),
r AS (SELECT doc_id, n_tokens, bucket, boundary,
             row_number() OVER (PARTITION BY bucket ORDER BY n_tokens, doc_id) - 1 AS rank,
             greatest(1, {token_budget} // greatest(1, boundary)) AS cap
      FROM lens JOIN cuts ON n_tokens > low AND n_tokens <= boundary)
SELECT doc_id, n_tokens, bucket, boundary, CAST(rank // cap AS BIGINT) AS batch,
       CAST(rank % cap AS INTEGER) AS slot, CAST(boundary - n_tokens AS INTEGER) AS padding FROM r
"""
