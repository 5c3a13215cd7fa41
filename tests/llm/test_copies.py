"""Exact dedup, SimHash near-dedup, line dedup and sharding against brute force."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import edge, empty, prose, rows_of  # noqa: F401  (fixtures)

from dwellrec.llm import digest_merge, external_shuffle, line_chunks, simhash
from dwellrec.llm.components import components


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup_edges(edge, keep):
    got = digest_merge.exact_dedup(edge, keep=keep).collect()
    src = [(r["doc_id"], r["text"] or "") for r in edge.collect()]
    groups = defaultdict(list)
    for d, t in src:
        groups[t].append(d)
    pick = max if keep == "largest" else min
    want = {hashlib.sha256(t.encode()).hexdigest():
            (pick((d for d in ds if d is not None), default=None), len(ds)) for t, ds in groups.items()}
    assert len(got) == len(src)
    assert Counter(r["text_sha256"] for r in got) == Counter(
        hashlib.sha256(t.encode()).hexdigest() for _, t in src)
    for r in got:
        assert (r["keep_id"], r["group_size"]) == want[r["text_sha256"]]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter(want.keys())


def test_drop_copies_keeps_columns_and_one_of_each(edge, empty):
    out = digest_merge.drop_copies(edge, keep="largest")
    assert out.columns == edge.columns
    rows = out.collect()
    texts = Counter(r["text"] or "" for r in rows)
    assert set(texts.values()) == {1}
    assert set(texts) == {r["text"] or "" for r in edge.collect()}
    source = Counter(tuple(r) for r in edge.collect())
    assert all(source[tuple(r)] for r in rows)
    assert digest_merge.exact_dedup(empty).count() == 0
    assert digest_merge.drop_copies(empty).count() == 0


def test_runs_are_native(edge):
    plan = digest_merge.exact_dedup(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    s = [" ".join(w)] if len(w) < 3 else [" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def test_fingerprints(edge):
    for r in edge.collect():
        assert simhash.fingerprint(r["text"]) == brute_fingerprint(r["text"])


def union_find(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_groups(rows):
    """rows (id, text) → (fingerprint, root) of each; equal roots are one group."""
    fps = [brute_fingerprint(t) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3]
    return fps, union_find(len(rows), near)


def brute_components(rows):
    """rows (id, text) → component id of each."""
    fps, root = brute_groups(rows)
    low = defaultdict(list)
    for (d, _), r in zip(rows, root):
        low[r].append(d)
    return fps, [min((d for d in low[r] if d is not None), default=None) for r in root]


@pytest.mark.parametrize("tile,bucket", [(8192, 1024), (5, 4)])
def test_near_duplicates(edge, empty, monkeypatch, tile, bucket):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    fps, comp = brute_components(rows)
    got = simhash.near_duplicates(edge).select("doc_id", "fingerprint", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(
        (d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, comp))
    assert simhash.near_duplicates(empty).count() == 0


def test_keep_one(edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    out = simhash.keep_one(edge)
    assert out.columns == edge.columns
    _, root = brute_groups(rows)
    least = {}
    for (d, _), r in zip(rows, root):
        least[r] = min(least.get(r, (True, 0)), (d is None, d or 0))
    kept = [r["doc_id"] for r in out.collect()]
    assert Counter(kept) == Counter(None if none else d for none, d in least.values())
    assert simhash.keep_one(empty).count() == 0


def test_keep_one_counts_groups_not_ids(spark):
    """Unlinked texts under null or repeated ids: one row of each group stays."""
    a, b, c, d, e = (prose(60, 200 + i) for i in range(5))
    rows = [(None, a), (None, a), (None, b), (None, c), (15, d), (15, d), (15, e), (16, e), (None, e)]
    fps = [brute_fingerprint(t) for t in (a, b, c, d, e)]
    assert min(bin(x ^ y).count("1") for x in fps for y in fps if x != y) > 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = rows_of(simhash.keep_one(docs).select("doc_id", "text"))
    assert Counter(kept) == Counter([(None, a), (None, b), (None, c), (15, d), (15, e)])


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=3), st.sampled_from([1, 10**5, 10**8, 10**10]))
def test_key_masks_lose_no_pair(a, flips, n):
    b = a
    for f in flips:
        b ^= 1 << f
    assert any(a & m == b & m for m in simhash.key_masks(n))


def test_links_and_planes():
    rng = np.random.default_rng(3)
    v = rng.integers(0, 2**63, 700).astype(np.uint64)
    v[:200] = v[200:400] ^ np.uint64(0b1011)
    v[400:450] = v[:50] ^ np.uint64(1 << 40)
    v = np.unique(v)
    near = [(i, j) for i in range(len(v)) for j in range(i) if bin(int(v[i]) ^ int(v[j])).count("1") <= 3]
    a, b = simhash.links(v, len(v))
    at = {int(x): i for i, x in enumerate(v)}
    assert union_find(len(v), near) == union_find(len(v), [(at[int(x)], at[int(y)]) for x, y in zip(a, b)])
    assert len(a) < len(v)          # a forest, not the pairs
    a, b = simhash.links(v, 300)    # between two tiles only
    cross = [(i, j) for i, j in near if (i < 300) != (j < 300)]
    assert union_find(len(v), cross) == union_find(len(v), [(at[int(x)], at[int(y)]) for x, y in zip(a, b)])


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] \
        + [(500, i) for i in range(501, 580)] + [(7, 7)]
    got = dict(rows_of(components(spark.createDataFrame(edges, "u long, v long"))))
    root = union_find(600, edges)
    touched = {x for e in edges for x in e if e[0] != e[1]}
    assert got == {x: root[x] for x in touched}


def brute_lines(rows):
    """rows (id, text) with unique ids → results of dedup_lines."""
    def chunks(text):
        lines = text.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % line_chunks._PRIME for x in lines]
        out, cur = [], []
        for i, x in enumerate(lines):
            cur.append(x)
            if (h[i] + line_chunks._BASE * (h[i - 1] if i else 0)) % line_chunks._PRIME % line_chunks.DIVISOR != 0:
                out.append(cur)
                cur = []
        return out + ([cur] if cur else [])
    seen, result = set(), []
    for d, t in sorted(rows):
        cs = chunks(t or "")
        gone = set()
        for p, c in enumerate(cs):
            units = [(cs[p:p + 2], (p, p + 1))] if p + 1 < len(cs) else []
            units += [([c], (p,))] if len(c) >= 2 else []
            for unit, places in units:
                body = "\n".join(x for y in unit for x in y)
                if body in seen:
                    gone.update(places)
                seen.add(body)
        kept = [c for p, c in enumerate(cs) if p not in gone]
        result.append((d, sum(map(len, cs)), len(cs), len(gone), sum(len(cs[p]) for p in gone),
                       "\n".join("\n".join(c) for c in kept)))
    return result


def test_dedup_lines(spark):
    rng = random.Random(2)
    pool = [f"line {i} of the pool, word {i * 7}" for i in range(60)]
    rows = []
    for d in range(60):
        at = rng.randrange(50)
        body = [f"own {d} {i}" for i in range(rng.randrange(6))] + pool[at:at + rng.randrange(10)] + ["", "x", "x"]
        rows.append((d, "\n".join(body)))
    rows += [(100, None), (101, ""), (102, "\n\n\n"), (103, "\n".join(f"l{i}" for i in range(3000)))]
    got = rows_of(line_chunks.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert sorted(got) == brute_lines(rows)
    assert sum(r[3] for r in got) > 20


def test_dedup_lines_edges(edge, empty):
    got = line_chunks.dedup_lines(edge).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in edge.collect())
    alike = [r for r in got if r["doc_id"] == 15]      # rows alike share their fate
    assert len({r["text"] for r in alike}) == 2
    shifted = {r["doc_id"]: r for r in got}
    assert shifted[12]["removed_chunks"] == 0 and shifted[13]["removed_chunks"] >= 2
    assert line_chunks.dedup_lines(empty).count() == 0
    assert "Python" not in line_chunks.dedup_lines(edge)._jdf.queryExecution().toString()


def test_dedup_lines_long_text(spark):
    """A text with tens of thousands of repeated chunks costs no lookup per chunk."""
    body = "\n".join(f"row {i} {i * i}" for i in range(60000))
    rows = [(1, body), (2, "intro\n" + body), (3, "own\nlines")]
    got = rows_of(line_chunks.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sorted(got) == brute_lines(rows)
    assert {r[0]: r[3] for r in got}[2] > 10000


def runs_of_earlier_lines(rows, words=50):
    """(id, first line, last line) of the later runs of 2+ lines and over
    ``words`` words that stand in one earlier text."""
    at, found = defaultdict(list), []
    texts = [(d, (t or "").split("\n")) for d, t in sorted(rows)]
    for no, (d, lines) in enumerate(texts):
        i = 0
        while i < len(lines) - 1:
            best = 0
            for o, j in at[lines[i], lines[i + 1]]:
                n, other = 2, texts[o][1]
                while i + n < len(lines) and j + n < len(other) and lines[i + n] == other[j + n]:
                    n += 1
                best = max(best, n)
            if best and sum(len(x.split()) for x in lines[i:i + best]) > words:
                found.append((d, i, i + best))
            i += max(best, 1)
        for j in range(len(lines) - 1):
            at[lines[j], lines[j + 1]].append((no, j))
    return found


def test_dedup_passages_finds_every_repeated_run(spark):
    """Planted passages of 2 to 9 lines, shifted, at both ends and in the middle of texts."""
    rng = random.Random(9)
    passages = [[f"{prose(30, 900 + 10 * p + i)} {p}" for i in range(2 + p % 8)] for p in range(40)]
    rows = []
    for d in range(160):
        own = [prose(9, 5000 + 20 * d + i) + f" own {d} {i}" for i in range(rng.randrange(8))]
        cut = rng.randrange(len(own) + 1)
        rows.append((d, "\n".join(own[:cut] + passages[d % 40] + own[cut:])))
    rows += [(900, None), (901, "one line"), (902, "one line"), (903, "x\nx\nx\ny"), (904, "")]
    runs = runs_of_earlier_lines(rows)
    assert len(runs) >= 120
    got = {r["doc_id"]: r for r in line_chunks.dedup_passages(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    source = {d: (t or "").split("\n") for d, t in rows}
    for d, a, b in runs:
        assert not set(source[d][a:b]) & set(got[d]["text"].split("\n"))
    everywhere = {x for r in got.values() for x in r["text"].split("\n")}
    assert everywhere == {x for lines in source.values() for x in lines}       # no line is lost
    assert all(got[d]["n_lines"] == len(x) for d, x in source.items())
    assert (got[903]["text"], got[903]["removed_lines"]) == ("x\ny", 2)
    # the chunks of op4: no line is lost, at least nine in ten repeated lines go
    chunks = {r["doc_id"]: Counter(r["text"].split("\n")) for r in line_chunks.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {x for c in chunks.values() for x in c} == everywhere
    assert recall(runs, source, chunks) >= 0.9


def recall(runs, source, left):
    """Share of the lines of repeated runs that are gone."""
    lines = [(d, x) for d, a, b in runs for x in source[d][a:b]]
    return sum(not left[d][x] for d, x in lines) / len(lines)


def test_chunk_recall_on_documents(spark):
    """Runs of 2+ lines and over 50 words that stand in an earlier document."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = rows_of(docs)
    source = {d: (t or "").split("\n") for d, t in rows}
    left = {r["doc_id"]: Counter(r["text"].split("\n")) for r in line_chunks.dedup_lines(docs).collect()}
    runs = runs_of_earlier_lines(rows)
    assert len(runs) > 20 and recall(runs, source, left) >= 0.9


def test_dedup_passages_edges(edge, empty):
    got = line_chunks.dedup_passages(edge).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in edge.collect())
    assert {r["doc_id"]: r["text"] for r in got}[13] == "intro line"
    assert line_chunks.dedup_passages(empty).count() == 0
    assert "Python" not in line_chunks.dedup_passages(edge)._jdf.queryExecution().toString()


def test_colliding_digests_are_not_removed(spark):
    """Two chunks under one digest with different bytes: the second is taken off the list."""
    texts = spark.createDataFrame([(1, 1, "a\nb\nc"), (2, 2, "d\ne\nf"), (3, 3, "a\nb\nc")],
                                  "i int, doc_id long, t string")
    ref = "map(0, named_struct('digest', cast('z' as binary), 'n', 3L, 'is_first', i = 1))"
    joined = texts.selectExpr("named_struct('a', i) as k", "doc_id", "t", f"{ref} as refs")
    wrong = {r["k"]["a"]: r["wrong"] for r in line_chunks._unequal(joined, 2, 2, 16).collect()}
    assert wrong == {2: [0]}


def test_shards(edge, empty, spark):
    out = external_shuffle.shard(edge, 16, bucket_bytes=4000)
    added = [c for c in out.columns if c not in edge.columns]
    assert added == ["_shard", "_slot"]                # the table has shard and slot
    rows = out.collect()
    by = defaultdict(list)
    for r in rows:
        by[r["_shard"]].append(r["_slot"])
    counts = [len(by[s]) for s in range(16)]
    assert sum(counts) == edge.count() and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert Counter(tuple(r)[:len(edge.columns)] for r in rows) == Counter(map(tuple, edge.collect()))
    assert external_shuffle.shard(empty, 16).count() == 0


def test_rows_alike_do_not_overfill_a_bucket(spark):
    docs = spark.createDataFrame([(7, "x" * 100)] * 300 + [(i, f"t{i}") for i in range(100, 200)],
                                 "doc_id long, text string").repartition(6)
    written, b, _ = external_shuffle.shuffled_buckets(docs, bucket_bytes=4000)
    assert max(r["count"] for r in written.groupBy(b).count().collect()) < 70     # not 300
    out = external_shuffle.shard(docs, 16, bucket_bytes=4000).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    counts = Counter(r["shard"] for r in out)
    assert len({(r["shard"], r["slot"]) for r in out}) == 400 and set(counts.values()) == {25}


def test_shards_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(500)], "doc_id long, text string")
    a, b = (rows_of(external_shuffle.shard(docs.repartition(n), 7, bucket_bytes=3000).select("doc_id", "shard", "slot"))
            for n in (3, 11))
    assert sorted(a) == sorted(b)
    assert sorted(a) != sorted((i, i % 7, i // 7) for i in range(500))
    other = external_shuffle.shard(docs, 7, seed=5, bucket_bytes=3000).select("doc_id", "shard", "slot")
    assert sorted(rows_of(other)) != sorted(a)


def test_shuffle_brute_force(spark):
    """The permutation, step by step: scatter by hash, Fisher-Yates, concatenate."""
    docs = spark.createDataFrame([(i, "x" * (i % 9)) for i in range(300)], "doc_id long, text string")
    f = external_shuffle.F
    h = {r[0]: r[1] for r in docs.select("doc_id", f.xxhash64(
        f.lit(external_shuffle.SHUFFLE_SEED), "doc_id", f.lit(1), "text")).collect()}
    n_buckets = -(-sum(i % 9 + 64 + 8 for i in range(300)) // 2000)     # text, row, id
    order = []
    for b in range(n_buckets):
        ids = sorted((i for i in h if h[i] % n_buckets == b), key=lambda i: (h[i], i))
        order += [ids[j] for j in external_shuffle.fisher_yates(len(ids), external_shuffle.SHUFFLE_SEED, b)]
    want, slots = [], Counter()
    for p, i in enumerate(order):
        s = p * 16 // 300
        want.append((i, s, slots[s]))
        slots[s] += 1
    got = rows_of(external_shuffle.shard(docs, 16, bucket_bytes=2000).select("doc_id", "shard", "slot"))
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("block", [1, 2, 5, 4096])
def test_bucket_offsets(spark, block):
    counts = {b: (b * 7) % 5 + 1 for b in range(60) if b % 11 != 3}
    df = spark.createDataFrame(list(counts.items()), "b long, count long").repartition(4)
    got = {r["b"]: r["_start"] for r in external_shuffle.bucket_offsets(df, "b", block).collect()}
    assert got == {b: sum(n for k, n in counts.items() if k < b) for b in counts}
    assert external_shuffle.bucket_offsets(df.limit(0), "b", block).count() == 0


def test_wide_columns_count_in_bucket_sizes(spark):
    docs = spark.range(200).selectExpr("id as doc_id", "'t' as text", "repeat('w', 1000) as html",
                                       "array(1.5D, 2D) as v", "id % 2 = 0 as flag").repartition(3)
    written, b, _ = external_shuffle.shuffled_buckets(docs, bucket_bytes=20_000)
    sizes = [r["count"] * 1100 for r in written.groupBy(b).count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 60_000                     # about 20,000 each, by hash
    out = external_shuffle.shard(docs, 3, bucket_bytes=20_000)
    assert out.columns == [*docs.columns, "shard", "slot"] and out.select("doc_id").distinct().count() == 200


def test_fisher_yates():
    p = external_shuffle.fisher_yates(1000, 1, 2)
    assert sorted(p) == list(range(1000)) and list(p) != list(range(1000))
    first = Counter(int(external_shuffle.fisher_yates(4, s, 0)[0]) for s in range(4000))
    assert all(850 < first[i] < 1150 for i in range(4))


def test_write_shards(spark, edge, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "doc_id long, text string")
    out = external_shuffle.shard(docs, 4, bucket_bytes=1000)
    external_shuffle.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(rows_of(back.select("doc_id", "shard", "slot"))) == sorted(rows_of(out.select("doc_id", "shard", "slot")))
