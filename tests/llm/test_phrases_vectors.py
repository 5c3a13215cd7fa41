"""Phrase mining, nearest neighbours and clustering against brute force."""
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import edge, empty, prose, rows_of  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from dwellrec.llm import ns_kmeans, permutation_index, phrases

SF = "/root/testdata/sf0.1"


# --- phrases ---------------------------------------------------------------

def brute_phrases(rows, min_count, longest=5, top=2000):
    """rows (text, lang) → {(lang, rank, phrase, a, l, r, n, score)}."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        gone = {p[i:j] for p in cand for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * cand[p] >= 100 * counts[p[i:j]]}
        scored = []
        for p, a in cand.items():
            if p in gone:
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n[lang], -s))
    return sorted(out)


def mined(docs, **kw):
    return sorted(rows_of(phrases.collocations(docs, **kw)))


@pytest.mark.parametrize("stream_rows,block_words,bits", [(1 << 18, 1 << 20, 1 << 30), (7, 50, 1 << 16)])
def test_phrases_brute_force(edge, empty, monkeypatch, stream_rows, block_words, bits):
    """Also over many ranges of the sorted streams, many blocks and several
    segments of the filter."""
    monkeypatch.setattr(phrases, "STREAM_ROWS", stream_rows)
    monkeypatch.setattr(phrases, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(phrases, "MAX_FILTER_BITS", bits)
    monkeypatch.setattr(phrases, "FILTER_SLOTS", 16 if bits > 1 << 16 else 1 << 10)
    rows = [(r["text"], r["lang"]) for r in edge.collect()]
    want = brute_phrases(rows, 3)
    assert len(want) > 50 and {len(r[2].split(" ")) for r in want} >= {2, 3, 5}
    assert mined(edge, min_count=3) == want
    assert mined(empty) == []


def test_phrases_odd_words(spark):
    """Control characters, words that begin others, repeats that overlap, ties."""
    texts = ["a b a b a b a b c", "A\x01 b. a\x01 b, a\x00 b; A\tb  a b", "x\xa0y z x\xa0y z!x\xa0y z",
             "b b b b b b b b", "É é É é É é", "", None, ". . .", "p q r s t u p q r s t u p q r s t"]
    rows = [(i, t, lang) for i, t in enumerate(texts * 3) for lang in ("en", None, "und", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    for top in (2000, 3):
        assert mined(docs, min_count=2, top=top) == brute_phrases([r[1:] for r in rows], 2, top=top)


def test_filter_segments_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MAX_FILTER_BITS", 1 << 16)
    monkeypatch.setattr(phrases, "FILTER_SLOTS", 1 << 12)
    docs = spark.createDataFrame([(prose(3000, s), "en") for s in range(4)], "text string, lang string")
    blocks = phrases.token_blocks(docs)
    ones = phrases.word_counts(blocks, 2, 5)
    filters = phrases.bit_filters(ones, 1)
    assert len(filters) > 1
    got = {r["phrase"]: r["f"] for r in phrases.longer_counts(blocks, filters, 1, 2, 5, 3).collect()}
    words = [prose(3000, s).split() for s in range(4)]
    want = Counter(" ".join(w[i:i + 2]) for w in words for i in range(len(w) - 1))
    assert got == {p: c for p, c in want.items() if c >= 5}


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 2**62), st.integers(1, 2**62), st.lists(st.integers(1, 2**62), min_size=2, max_size=8))
def test_best_cut_is_exact(a, n, counts):
    half = len(counts) // 2
    lefts, rights = counts[:half], counts[half:2 * half]
    score, x, y = phrases.best_cut(a, n, lefts, rights)
    cuts = list(zip(lefts, rights[::-1]))
    scores = [1000 * a * n // (p * q) for p, q in cuts]
    assert score == min(scores) and (x, y) == cuts[scores.index(score)]


# --- nearest neighbours ----------------------------------------------------

def brute_nearest(rows, is_query, n=10):
    """rows (id, vector) → {(query id, rank, id, score)} over distinct rows."""
    good = {(i, tuple(0.0 + x for x in v)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q, a in sorted(good):
        if is_query(q):
            near = sorted((math.dist(a, b), i) for i, b in good if (i, b) != (q, a) and len(b) == len(a))
            out += [(q, r, i, d) for r, (d, i) in enumerate(near[:n], 1)]
    return out


def test_nearest_recall(spark):
    """The production parameters on the whole table, against brute force."""
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = permutation_index.nearest(vectors, F.col("id") % 100 == 0).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    want = brute_nearest(rows, lambda i: i % 100 == 0)
    assert Counter(r["query_id"] for r in got) == Counter(w[0] for w in want)
    hits = {(r["query_id"], r["vec_id"]) for r in got} & {(w[0], w[2]) for w in want}
    assert len(hits) >= 0.9 * len(want)
    by = dict(rows)
    for r in got:
        assert r["score"] == pytest.approx(math.dist(by[r["query_id"]], by[r["vec_id"]]), rel=1e-12)
    lists = defaultdict(list)
    for r in got:
        lists[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    for near in lists.values():
        near.sort()
        assert [x[0] for x in near] == list(range(1, 11))
        assert [x[1:] for x in near] == sorted(x[1:] for x in near)


def odd_vectors():
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(150)]
    same = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    rows += [(1000 + i, same) for i in range(80)] + [(1010, same)] * 30
    rows += [(None, same), (7, None), (8, []), (9, [0.0] * 6), (10, [1.0, None] + [0.0] * 4),
             (20, [float("nan")] + [1.0] * 5), (30, [float("inf")] + [1.0] * 5), (40, [1.0, 2.0]),
             (50, [1.0, 2.5]), (200, [1.0] * 3), (60, [-0.0, 1.0, 0.0, 0.0, 0.0, 0.0]),
             (61, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0]), (1010, [2.0] * 6), (300, same)]
    return rows


VECTORS = "vec_id long, embedding array<double>, id string, k string, score string, ids string"


@pytest.mark.parametrize("chunk,block", [(16384, 8192), (3, 20)])
def test_nearest_edges(spark, chunk, block):
    """Equal vectors, other lengths, rows that take no part; with every vector of a
    block reranked the search is exact."""
    rows = odd_vectors()
    docs = spark.createDataFrame([(*r, "x", None, "y", "z") for r in rows], VECTORS).repartition(5)
    got = permutation_index.nearest(docs, F.col("id") % 10 == 0, chunk=chunk, block=block)
    want = brute_nearest(rows, lambda i: i % 10 == 0)
    key = lambda r: (r[0], r[1], r[2], round(r[3], 9))
    assert Counter(map(key, rows_of(got))) == Counter(map(key, want))
    none = spark.createDataFrame([], VECTORS)
    assert permutation_index.nearest(none, F.col("id") % 10 == 0).count() == 0


def test_footrule_savings():
    """The inverted file gives the footrule distance of the truncated orders."""
    rng = np.random.default_rng(1)
    keep, n_pivots = 6, 15
    order = np.array([rng.permutation(n_pivots)[:keep] for _ in range(40)], dtype=np.uint16)
    saved = permutation_index.footrule_savings(order[0], *permutation_index.inverted(order, n_pivots), 40, keep)
    place = np.full((40, n_pivots), keep)
    np.put_along_axis(place, order.astype(int), np.arange(keep)[None].repeat(40, 0), 1)
    footrule = np.abs(place - place[0]).sum(axis=1)
    assert (footrule == keep * (keep + 1) - 2 * saved).all()


# --- clustering ------------------------------------------------------------

def brute_clusters(rows, k=8, rounds=10, dim=64, scale=1024, seed=3):
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(),
                                        np.array(r[1], "<i8").tobytes()))
    c = [r[1] for r in order[:k]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(q, m)), j) for j, m in enumerate(c)) for _, q in kept]

    for _ in range(rounds):
        at = nearest()
        for j in range(len(c)):
            own = [q for (_, q), (_, a) in zip(kept, at) if a == j]
            if own:
                c[j] = tuple(sum(col) // len(own) for col in zip(*own))
    at = nearest()
    part = Counter()
    for d, j in at:
        part[j] += d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return Counter((i, j, d, part[j], sum(part.values()), sha[j]) for (i, _), (d, j) in zip(kept, at))


@pytest.mark.parametrize("k,rounds", [(8, 10), (3, 4), (400, 2)])
def test_clusters_brute_force(spark, k, rounds):
    rows = odd_vectors()
    rows += [(2000 + i, [3.0 + i % 3, 1.0, 1.0, 1.0, 1.0, 1.0 + i / 50]) for i in range(60)]     # ties, repeats
    docs = spark.createDataFrame([(*r, "x", None, "y", "z") for r in rows], VECTORS).repartition(5)
    got = ns_kmeans.cluster(docs, k=k, rounds=rounds, dim=6, scale=4)
    assert Counter(rows_of(got)) == brute_clusters(rows, k, rounds, 6, 4)
    none = spark.createDataFrame([], VECTORS)
    assert ns_kmeans.cluster(none).count() == 0


def test_component_too_large_is_refused(spark):
    docs = spark.createDataFrame([(1, [1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="cannot be clustered exactly"):
        ns_kmeans.cluster(docs, dim=1).collect()


def lloyd(x, past):
    d = ((x[:, None, :] - past[-1][None]) ** 2).sum(axis=2)
    return d.argmin(axis=1)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 6), st.integers(1, 5))
def test_reassign_equals_a_full_scan(seed, k, dim):
    rng = np.random.default_rng(seed)
    x = rng.integers(-6, 7, size=(60, dim)) * rng.choice([1, 1000])
    past = x[:k].copy()[None]
    cluster, seen, at = np.full(60, -1), np.zeros((60, k)), np.zeros((60, k), dtype=np.uint8)
    for _ in range(6):
        cluster, seen, at, _ = ns_kmeans.reassign(x, cluster, seen, at, past)
        assert (cluster == lloyd(x, past)).all()
        now = np.array([x[cluster == j].sum(axis=0) // max(1, (cluster == j).sum()) if (cluster == j).any()
                        else past[-1][j] for j in range(k)])
        past = np.concatenate([past, now[None]])


def test_total_displacement_skips_more_than_summed_drifts():
    """Centroids that wander back and forth: the norm of the total displacement
    stays small where the sum of steps grows, and fewer distances are computed."""
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.integers(-30, 30, size=(200, 2)) + c for c in ((0, 0), (400, 0), (0, 400))])
    base = np.array([[0, 0], [400, 0], [0, 400]])
    steps = [base + s * np.array([[90, 0], [0, 90], [90, 90]]) for s in (0, 1, 0, 1, 0, 1, 0)]
    spent = {}
    for how in ("total", "summed"):
        cluster, seen, at = np.full(600, -1), np.zeros((600, 3)), np.zeros((600, 3), dtype=np.uint8)
        spent[how] = 0
        for t in range(len(steps)):
            past = np.array(steps[:t + 1])
            if how == "summed":                    # loosen by the sum of steps: shift old centroids out
                drift = np.linalg.norm(np.diff(past, axis=0), axis=2)
                total = np.concatenate([drift[::-1].cumsum(axis=0)[::-1], np.zeros((1, 3))])
                fake = past[-1][None] + np.stack([total, np.zeros_like(total)], axis=2)
                fake[-1] = past[-1]
                cluster, seen, at, computed = ns_kmeans.reassign(x, cluster, seen, at, fake.round().astype(int))
            else:
                cluster, seen, at, computed = ns_kmeans.reassign(x, cluster, seen, at, past)
            assert (cluster == lloyd(x, past)).all()
            spent[how] += computed.sum()
    assert spent["total"] < spent["summed"] < 3 * 600 * len(steps)
