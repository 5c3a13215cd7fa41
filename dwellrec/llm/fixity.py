"""WARC: Merkle fixity audit of replicas.

``records`` lays a table of pages out as WARC records: length, SHA-256 of the
record's bytes, file number and byte offset. ``tree`` hashes a replica upwards:
a record's leaf binds its offset, length, id and digest; above it, nodes cover
ordered offset ranges of 64 KiB, 1 MiB, 16 MiB, … of a file (16 children each),
then the file, then 16, 256, … files, up to one root for the replica. A node binds
the number of its children and each child's place (range or file number) with its
hash, so a renumbered, swapped or shifted part changes every node above it.
``audit`` compares the roots and descends, level by level, only into nodes that
differ, down to the records.

A node's children are bounded by construction (16; below the lowest range, the
records that start within 64 KiB), and record bytes are hashed where they are
read: only digests are shuffled.

Defined results: null urls and bodies are empty; null ids sort first; repeated
pages are separate records; a record that one side holds more often at a place is
reported once, as missing or extra; where a place has lost some records and gained
others, these are paired in order as changed; a replica without records has no
root, and every record of the other one is then missing or extra; two empty
replicas give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from dwellrec.llm.common import as_text, ordinal, quoted
from dwellrec.session import materialize

RECORDS_PER_FILE = 1000
RANGE_BITS = 16          # lowest range: 64 KiB
FAN_BITS = 4             # 16 children
RANGE_LEVELS = 5         # up to 4 GiB; larger files just have more top ranges
CUT_AT = 512 << 10
CRLF = "\r\n"


def warc_record(page_id: Column, url: Column, body: Column) -> Column:
    """The text of a response record."""
    head = F.concat(F.lit(f"WARC/1.0{CRLF}WARC-Type: response{CRLF}WARC-Record-ID: <urn:page:"),
                    F.coalesce(page_id.cast("string"), F.lit("")),
                    F.lit(f">{CRLF}WARC-Target-URI: "), url,
                    F.lit(f"{CRLF}Content-Length: "), F.octet_length(body).cast("string"),
                    F.lit(CRLF + CRLF))
    return F.concat(head, body, F.lit(CRLF + CRLF))


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """(file, offset, length, record_id, digest): pages in id order, so many
    records to a file, as a WARC writer would lay them out."""
    rec = warc_record(quoted(page_id), as_text(url), as_text(html))
    narrow = pages.select(quoted(page_id).alias("record_id"), as_text(url).alias("url"),
                          F.octet_length(rec).cast("bigint").alias("length"),
                          F.sha2(rec, 256).alias("digest"))
    # written first: the range sort reads its input twice
    placed = ordinal(materialize(narrow, "record-digests"), ["record_id", "url", "length", "digest"])
    w = (Window.partitionBy("file").orderBy("_ix")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))   # at most per_file rows
    return (placed.withColumn("file", F.expr(f"_ix div {int(per_file)}"))
            .withColumn("offset", F.sum("length").over(w) - F.col("length"))
            .select("file", "offset", "length", "record_id", "digest"))


def _combine(place: str) -> Column:
    """Hash of the number of children and of their places and hashes in order (a
    bounded list)."""
    kids = F.array_sort(F.collect_list(F.struct(F.col(place).alias("place"), "hash")))
    each = F.transform(kids, lambda c: F.concat_ws("=", c["place"].cast("string"), c["hash"]))
    return F.sha2(F.concat_ws("|", F.size(kids).cast("string"), F.array_join(each, "|")), 256)


def leaf_hash() -> Column:
    return F.sha2(F.concat_ws(":", "offset", "length", "digest", F.coalesce(
        F.concat(F.lit("id"), F.col("record_id").cast("string")), F.lit("none"))), 256)


def tree(leaves: DataFrame) -> list[DataFrame]:
    """Levels from the lowest ranges to the root, each (side, file, idx, hash);
    ``leaves`` has side and the columns of ``records``."""
    low = leaves.select("side", "file", "offset", leaf_hash().alias("hash"))
    level = low.groupBy("side", "file", F.shiftright("offset", RANGE_BITS).alias("idx")).agg(
        _combine("offset").alias("hash"))
    levels = [materialize(level, "merkle-ranges")]
    for _ in range(RANGE_LEVELS - 1):
        up = levels[-1].withColumn("up", F.shiftright("idx", FAN_BITS))
        levels.append(materialize(
            up.groupBy("side", "file", "up").agg(_combine("idx").alias("hash"))
            .withColumnRenamed("up", "idx"), "merkle-ranges"))
    files = levels[-1].groupBy("side", "file").agg(_combine("idx").alias("hash"))
    zero = F.lit(0).cast("bigint").alias("idx")
    levels.append(materialize(files.select("side", "file", zero, "hash"), "merkle-files"))
    top = levels[-1].agg(F.max("file")).first()[0] or 0
    while top:
        top >>= FAN_BITS
        up = levels[-1].withColumn("up", F.shiftright("file", FAN_BITS))
        levels.append(materialize(
            up.groupBy("side", "up").agg(_combine("file").alias("hash"))
            .select("side", F.col("up").alias("file"), zero, "hash"), "merkle-files"))
    return levels


def _differing(nodes: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Nodes of which the two sides have different or missing values."""
    a, b = (nodes.where(F.col("side") == s).select(*keys, F.col(value).alias(s)) for s in "ab")
    return a.join(b, keys, "full").where(~F.col("a").eqNullSafe(F.col("b")))


def audit(good: DataFrame, replica: DataFrame) -> DataFrame:
    """Records in which ``replica`` differs from ``good`` (both as from
    ``records``): file, offset, length, record_id, kind (changed, missing,
    extra), digest, found."""
    leaves = materialize(good.withColumn("side", F.lit("a")).unionByName(
        replica.withColumn("side", F.lit("b"))), "fixity-leaves")
    levels = tree(leaves)
    n_files = len(levels) - RANGE_LEVELS          # levels of whole files, the last is the root
    bad = materialize(_differing(levels[-1], ["file", "idx"], "hash").select("file", "idx"), "bad")
    for i in range(len(levels) - 2, -1, -1):
        if i >= len(levels) - n_files:            # children are files or groups of files
            parent = [F.shiftright("file", FAN_BITS).alias("pf"), F.lit(0).cast("bigint").alias("pi")]
        elif i == RANGE_LEVELS - 1:               # children are a file's top ranges
            parent = [F.col("file").alias("pf"), F.lit(0).cast("bigint").alias("pi")]
        else:
            parent = [F.col("file").alias("pf"), F.shiftright("idx", FAN_BITS).alias("pi")]
        kids = levels[i].select("*", *parent)
        kids = kids.join(bad.toDF("pf", "pi"), ["pf", "pi"], "left_semi")
        bad = materialize(_differing(kids, ["file", "idx"], "hash").select("file", "idx"), "bad")
    found = (leaves.withColumn("pi", F.shiftright("offset", RANGE_BITS))
             .join(bad.toDF("file", "pi"), ["file", "pi"], "left_semi"))
    return record_differences(found)


def record_differences(leaves: DataFrame) -> DataFrame:
    """Records that one side holds more often than the other at a place."""
    leaf = F.struct("length", "record_id", "digest")
    held = leaves.groupBy("file", "offset", leaf.alias("leaf")).agg(
        F.count_if(F.col("side") == "a").alias("na"), F.count_if(F.col("side") == "b").alias("nb"))
    odd = held.where("na <> nb").withColumn("lost", F.col("na") > F.col("nb"))
    w = Window.partitionBy("file", "offset", "lost").orderBy("leaf")      # different records of one place
    odd = odd.withColumn("r", F.row_number().over(w))
    a, b = (odd.where(F.col("lost") == F.lit(lost)).select("file", "offset", "r", F.col("leaf").alias(side))
            for side, lost in (("a", True), ("b", False)))
    diff = a.join(b, ["file", "offset", "r"], "full")
    some = F.coalesce("a", "b")
    return diff.select(
        "file", "offset", some["length"].alias("length"), some["record_id"].alias("record_id"),
        F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra")
        .otherwise("changed").alias("kind"),
        F.col("a.digest").alias("digest"), F.col("b.digest").alias("found"))


def damaged(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """A replica's pages with rot, the same for the same pages: one character
    overwritten, or the whole body blanked, on ids chosen by residue."""
    n = quoted(page_id).cast("bigint")
    body = as_text(html)
    flipped = F.concat(F.lit("#"), F.substring(body, 2, 2147483647))
    blank = F.regexp_replace(body, "[ -~]", " ")
    return pages.withColumn(html, F.when((n % 97 == 13) & body.rlike("^[ -~]"), flipped)
                            .when(n % 389 == 7, blank).otherwise(body))


def cut_short(laid_out: DataFrame) -> DataFrame:
    """A replica of which every eleventh file has lost its last bytes: records
    that end beyond 512 KiB of it are missing."""
    return laid_out.where(~((F.col("file") % 11 == 0)
                            & (F.col("offset") + F.col("length") > CUT_AT)))


def audit_sql(pages: str = "pages") -> str:
    """Expected rows of ``audit(records(p), cut_short(records(damaged(p))))``."""
    def side(body):
        return f"""SELECT page_id, url, concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13),
  chr(10), 'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10), 'WARC-Target-URI: ', url,
  chr(13), chr(10), 'Content-Length: ', strlen({body}), chr(13), chr(10), chr(13), chr(10), {body},
  chr(13), chr(10), chr(13), chr(10)) AS r FROM p"""
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS h,
  CASE WHEN page_id % 97 = 13 AND regexp_matches(coalesce(html, ''), '^[ -~]') THEN '#' || substr(html, 2)
       WHEN page_id % 389 = 7 THEN regexp_replace(coalesce(html, ''), '[ -~]', ' ', 'g')
       ELSE coalesce(html, '') END AS hb FROM {pages}),
a0 AS ({side('h')}), b0 AS ({side('hb')}),
lay AS (SELECT a0.page_id, sha256(a0.r) AS digest, sha256(b0.r) AS found, strlen(a0.r) AS length,
          (row_number() OVER (ORDER BY a0.page_id, a0.url) - 1) // {RECORDS_PER_FILE} AS file
        FROM a0 JOIN b0 USING (page_id)),
o AS (SELECT *, CAST(sum(length) OVER (PARTITION BY file ORDER BY page_id) - length AS BIGINT) AS off FROM lay),
f AS (SELECT *, file % 11 = 0 AND off + length > {CUT_AT} AS lost FROM o)
SELECT file, off AS offset, length, page_id AS record_id,
       CASE WHEN lost THEN 'missing' ELSE 'changed' END AS kind, digest,
       CASE WHEN lost THEN '' ELSE found END AS found
FROM f WHERE lost OR digest <> found
"""
