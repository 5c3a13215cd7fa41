"""Rows that every operator must take, and helpers of these tests."""
import pytest
from pyspark.sql import types as T

WORDS = ("river stone lamp cedar music window harvest pilot garden copper thread winter signal "
         "market bridge candle forest letter orbit canvas meadow harbor velvet engine").split()


def prose(n, salt=0):
    """n words, the same for the same arguments."""
    x, out = 12345 + salt, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + ("" if x % 7 else str(x % 100)))
    return " ".join(out)


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # columns that clash with names the operators use
    *[T.StructField(c, T.StringType()) for c in
      ("shard", "slot", "_bucket", "bucket", "component_id", "kept", "lang_pred", "_t", "_key", "fp", "digest")],
])


def edge_rows():
    base = prose(400, 1)
    near = base.split()
    near[200] = "changed"
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, None), (7, "   \n\t "),
        (8, "Solo"), (9, "two words"), (10, "12 34 !! ###"), (11, prose(20000, 2)),
        (12, "\n".join(prose(9, i) for i in range(12))), (13, "intro line\n" + "\n".join(prose(9, i) for i in range(12))),
        (None, base), (None, None), (None, prose(30, 3)), (14, "ünïcödé ßtraße 漢字 \U0001f600 text"),
        (15, prose(60, 4)), (15, prose(60, 4)), (15, prose(60, 4)), (15, prose(60, 5)), (16, prose(60, 5)),
        (17, "a\x0bb\x0cc d\xa0e"), (18, "same same same same same same"), (-3, prose(60, 6)),
    ]
    texts += [(100 + i, prose(50 + i, 50 + i)) for i in range(25)]
    return [(d, t, None if i % 5 == 0 else ("en", "de")[i % 2], None if i % 3 == 0 else "s", None if i % 4 else 7)
            + tuple("x" if (i + j) % 2 else None for j in range(11)) for i, (d, t) in enumerate(texts)]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
