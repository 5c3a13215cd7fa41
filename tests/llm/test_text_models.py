"""Quality field, language codes, decontamination, packing."""
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_data import edge, empty, prose, rows_of  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from dwellrec.llm import crf_quality as crf
from dwellrec.llm import decontam, length_buckets
from dwellrec.llm import ecoc_langid as ecoc
from dwellrec.llm import queries as Q

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


# --- quality -----------------------------------------------------------------

def enumerated_marginals(emit, stay, lean, start):
    n, good, total = len(emit), np.zeros(len(emit)), 0.0
    for path in itertools.product((0, 1), repeat=n):
        s = path[0] * (emit[0] + start)
        for a, b, e in zip(path, path[1:], emit[1:]):
            s += stay * (a == b) + b * (lean + e)
        total += np.exp(s)
        good += np.exp(s) * np.array(path)
    return good / total


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 9):
        emit = rng.normal(0, 2, n)
        got = 1 / (1 + np.exp(-crf.chain(emit, 0.7, -0.3, 0.4)))
        assert np.allclose(got, enumerated_marginals(emit, 0.7, -0.3, 0.4))


def test_likelihood_gradient():
    rng = np.random.default_rng(2)
    sizes = np.array([6, 3, 1])
    starts = np.array([0, 6, 9])
    x, y, w = rng.normal(size=(10, 4)), np.array([1.0, 0.0, 1.0]), rng.normal(size=4)
    theta = np.concatenate([w, [0.5, -0.2, 0.3]])
    like, grad = crf._likelihood_gradient(x, starts, sizes, y, theta[:-3], *theta[-3:])
    for i in range(len(theta)):
        up, down = theta.copy(), theta.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        fu = crf._likelihood_gradient(x, starts, sizes, y, up[:-3], *up[-3:])[0]
        fd = crf._likelihood_gradient(x, starts, sizes, y, down[:-3], *down[-3:])[0]
        assert abs((fu - fd) / 2e-5 - grad[i]) < 1e-4


def test_features_bounded():
    for t in ("", "\n\n", "A!! B!!", "x | y |", "a" * 100000, " \t", prose(3000), "12 ### \x00"):
        x, length = crf.features(t)
        assert x.shape == (t.count("\n") + 1, crf.N_FEATURES) and (length > 0).all()
        assert x.min() >= 0 and x.max() <= 1


def test_held_out_quality(spark):
    got = Q.op5_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    held = got.where("held_out").select("predicted", "quality").collect()
    assert len(held) > 50
    assert sum(r[0] == r[1] for r in held) / len(held) > 0.97


def test_quality_edges(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (2, 1), (10, 0), (11, 1), (5, 0), (None, 1), (12, None)],
                                   "doc_id long, quality int")
    model = crf.fit(edge, labels)
    out = crf.score(edge, model)
    rows = out.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in edge.collect())
    assert all(0 <= r["score"] <= 1 for r in rows)
    blank = crf.fit(edge, labels.limit(0))
    assert {r["score"] for r in crf.score(edge, blank).collect()} == {0.5}
    assert crf.score(empty, model).count() == 0
    assert crf.fit(empty, labels).weights.sum() == 0


# --- language ----------------------------------------------------------------

@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 12, 40])
def test_codewords_apart(n):
    code = ecoc.codewords(n)
    apart = min(int((a != b).sum()) for a, b in itertools.combinations(code, 2))
    assert apart >= (1 if n == 2 else 2 if n == 3 else 4)
    assert all(abs(c.sum()) < n for c in code.T)


def test_decoding_corrects_a_wrong_bit():
    code = ecoc.codewords(5)
    bits = code.shape[1]
    model = ecoc.Model("abcde", code, np.zeros((4, bits)), np.ones(bits), np.zeros(bits), np.ones(bits))
    for k, wrong in itertools.product(range(5), range(bits)):
        x = 3 * code[k].copy()
        x[wrong] *= -1
        model.log_odds = lambda text, x=x: x
        lang, score, ambiguous = model.decode("t")
        assert lang == "abcde"[k] and not ambiguous and 0 < score <= 1
    model.log_odds = lambda text: np.zeros(bits)
    assert model.decode("t")[2]                        # nothing to choose by


def brute_grams(text):
    """Numbers of the 1- to 3-grams of a text, one position after the other."""
    v = [ord(c) if c.isalpha() else 32 for c in f" {(text or '').lower()} "]
    out, m, a, b, c, d = [], 1 << 32, 2654435761, 2246822519, 3266489917, 668265263
    for i, x in enumerate(v if set(v) != {32} else []):
        y, z = v[i + 1] if i + 1 < len(v) else None, v[i + 2] if i + 2 < len(v) else None
        if x != 32:
            out.append((x * a + 97) * b % m >> 18)
        if y is not None and (x != 32 or y != 32):
            out.append((x * a + y) * c % m >> 18)
        if z is not None and y != 32:
            out.append(((x * a + y) * b + z) * d % m >> 18)
    return out


def brute_decode(model, text):
    """(language, score, loss a unit of weight of its codeword) from the model's numbers."""
    grams = brute_grams(text)
    if not grams or not model.langs:
        return "und", 0.0, math.inf
    if len(model.langs) == 1:
        return model.langs[0], 1.0, 0.0
    loss = []
    z = [s * sum(float(model.odds[g, k]) for g in grams) / len(grams) + o
         for k, (s, o) in enumerate(zip(model.slope, model.offset))]
    for word in model.code:
        loss.append(sum(w * math.log1p(math.exp(-bit * x)) for bit, x, w in zip(word, z, model.weight)))
    best = loss.index(min(loss))
    return (model.langs[best], 1 / sum(math.exp(loss[best] - x) for x in loss), loss[best] / sum(model.weight))


def test_language_brute_force(spark):
    """The query's rows from n-grams counted, and texts decoded, in plain Python."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    rows = [r for r in docs.collect() if len(r["text"] or "") < 20_000]
    model = ecoc.fit(ecoc.learnable(docs))
    learn = [r for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"]]
    key = {r["doc_id"]: xxhash.xxh64_intdigest(r["doc_id"].to_bytes(8, "little"), 42) % (1 << 30) for r in learn}
    counts = {k: Counter() for k in model.langs}
    for lang in model.langs:
        mine = sorted((r for r in learn if r["lang"] == lang), key=lambda r: (key[r["doc_id"]], r["doc_id"]))
        for r in mine[0::2]:
            counts[lang].update(brute_grams(r["text"]))
    share = np.array([[counts[k][g] / max(1, sum(counts[k].values())) for g in range(1 << 14)] for k in model.langs])
    for bit in range(model.code.shape[1]):
        p, q = (share[model.code[:, bit] == side].mean(axis=0) + 1e-6 for side in (1, -1))
        assert np.allclose(model.odds[:, bit], np.log(p / p.sum()) - np.log(q / q.sum()), atol=1e-4)
    got = {r["doc_id"]: r for r in Q.op6_language_id(spark, SMALL).collect()}
    assert len(got) == docs.count()
    for r in rows:
        lang, score, _ = brute_decode(model, r["text"])
        mine = got[r["doc_id"]]
        assert mine["lang_pred"] == lang and abs(mine["score"] - score) < 1e-3
        assert mine["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_rejection(spark):
    """Texts in no learned language go; of texts never learned from, at least 0.99 stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(2)
    odd = [(-k, "".join(chr(rng.randrange(0x4e00, 0x9fa5)) for _ in range(400)), None) for k in range(1, 21)]
    odd += [(-50, "12 34 !!", None), (-51, "", None), (-52, None, None)]
    mixed = docs.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    assert ecoc.fit(ecoc.learnable(mixed)).reject == math.log(2) / 2
    kept = {r["doc_id"] for r in ecoc.keep_identified(mixed).select("doc_id").collect()}
    held = [r["doc_id"] for r in docs.select("doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 200 and sum(d in kept for d in held) / len(held) >= 0.99
    assert not [d for d in kept if d < 0]


def test_held_out_language(spark):
    got = Q.op6_language_id(spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").collect()
    assert len(held) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in held)


def test_language_edges(spark, edge, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = ecoc.fit(docs.limit(300), per_lang=40)
    out, names = ecoc.identify(edge, model)
    assert names == ["_lang_pred", "lang_score", "lang_ambiguous", "lang_loss"]      # the table has lang_pred
    for r in out.collect():
        has = any(c.isalpha() for c in r["text"] or "")
        assert (r[names[0]] != "und") == has and 0 <= r[names[1]] <= 1
    kept = ecoc.keep_identified(edge)
    assert kept.columns == edge.columns
    own = ecoc.fit(ecoc.learnable(edge).select("doc_id", "text", "lang"))
    assert Counter(r["text"] for r in kept.collect()) == Counter(
        r["text"] for r in edge.collect() if brute_decode(own, r["text"])[2] <= own.reject)
    assert ecoc.keep_identified(empty).count() == 0
    assert ecoc.identify(empty, model)[0].count() == 0
    one = ecoc.fit(docs.where("lang = 'en'"))
    assert one.decode("hello there") == ("en", 1.0, False) and one.decode("42")[0] == "und"
    assert ecoc.fit(docs.limit(0)).decode("hello")[0] == "und"


# --- decontamination -----------------------------------------------------------

def test_letters_beyond_the_bmp(spark):
    """Emoji and mathematical digits are no letters, ideographs of plane 2 are."""
    model = ecoc.Model(["en"], ecoc.codewords(1), np.zeros((1 << ecoc.DIM_BITS, 0)), *[np.zeros(0)] * 3)
    for text in ("\U0001f600 \U0001f680\U0001f600", "\U0001d7d8\U0001d7d9", "\U0001f600 42"):
        assert not any(map(str.isalpha, text))
        assert model.decode(text) == ("und", 0.0, True)
    assert model.decode("\U00020000\U00020001")[0] == "en"
    plain, emoji = (np.concatenate(list(ecoc.gram_slices(t))) for t in ("ab  cd", "ab \U0001f600 cd"))
    assert not set(emoji.tolist()) - set(plain.tolist())


def test_nothing_learned_keeps_texts_with_letters(spark):
    docs = spark.createDataFrame([(1, "hello there", None), (2, "42 !", None), (3, None, None), (None, "ja", None)],
                                 "doc_id long, text string, lang string")
    assert sorted(r["text"] for r in ecoc.keep_identified(docs).collect()) == ["hello there", "ja"]


def brute_shingles(text, k=None):
    """k-word shingles; without k those of an item: five words, or all of a shorter one."""
    w = re.findall(r"[^\W_]+", (text or "").lower())
    k = k or min(5, len(w))
    return {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute_contaminated(docs, items):
    out = []
    for d, t in docs:
        for i, it in items:
            its = brute_shingles(it)
            ds = brute_shingles(t, len(min(its).split())) if its else set()
            if its and len(ds & its) >= (0.8 - 1e-9) * len(its):
                out.append((d, i, len(its), len(ds & its), len(ds & its) / len(its)))
    return sorted(out)


def test_short_items_in_long_documents(spark):
    docs = [(1, "Alpha beta, gamma delta! " + prose(10, 1)), (2, prose(3000, 2) + " alpha beta gamma delta"),
            (3, "alpha beta gamma"), (4, "beta alpha gamma delta " + prose(9, 3)), (5, "gamma Delta"), (6, "delta"),
            (7, "alpha beta gamma delta"), (8, prose(40, 4)), (9, None), (10, "")]
    items = [(1, "alpha beta gamma delta"), (2, "gamma delta"), (3, "Delta"), (4, "alpha  beta gamma"), (5, prose(30, 4))]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string"))
    want = brute_contaminated(docs, items)
    assert sorted(rows_of(got)) == want
    assert [x[:2] for x in want if x[1] == 1] == [(1, 1), (2, 1), (7, 1)] and (3, 4) in [x[:2] for x in want]


def test_filter_follows_the_items():
    assert decontam.filter_bits(0) == decontam.filter_bits(1000) == decontam.MIN_FILTER_BITS
    assert 32 * 10**6 <= decontam.filter_bits(10**6) < 64 * 10**6
    assert decontam.filter_bits(10**12) == decontam.MAX_FILTER_BITS


def test_decontamination(spark, empty):
    rng = random.Random(4)
    items = [(i, prose(rng.randrange(3, 60), 900 + i)) for i in range(25)] + [(90, None), (91, ""), (92, "Solo")]
    docs = []
    for d in range(80):
        w = prose(rng.randrange(1, 300), d).split()
        for _ in range(rng.randrange(3)):
            it = items[rng.randrange(25)][1].split()
            for _ in range(rng.randrange(4)):           # damage: containment falls step by step
                it[rng.randrange(len(it))] = "damaged"
            at = rng.randrange(len(w) + 1)
            w[at:at] = it
        docs.append((d, " ".join(w).title() if d % 3 else " ... ".join(w)))
    docs += [(200, None), (201, ""), (202, "SOLO!"), (203, items[0][1])]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string"))
    want = brute_contaminated(docs, items)
    assert sorted(rows_of(got)) == want and len(want) > 20
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.contaminated(empty, bench).count() == 0


def test_drop_contaminated_edges(spark, edge, empty):
    bench = spark.createDataFrame([(1, prose(60, 5)), (1, prose(30, 3)), (None, "two words")],
                                  "item_id long, text string")
    out = decontam.drop_contaminated(edge, bench)
    assert out.columns == edge.columns
    items = [r["text"] for r in bench.collect()]
    clean = [r for r in edge.collect()
             if not brute_contaminated([(0, r["text"])], [(0, t) for t in items])]
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, clean))
    assert Counter(r["doc_id"] for r in out.collect())[15] == 3      # only the row that contains it goes
    assert decontam.drop_contaminated(empty, bench).count() == 0
    assert decontam.drop_contaminated(edge, bench.limit(0)).count() == edge.count()


# --- packing -------------------------------------------------------------------

def padding_of(hist, cuts):
    return sum(n * (min(c for c in cuts if c >= length) - length) for length, n in hist)


def test_boundaries_are_optimal():
    rng = random.Random(6)
    for _ in range(60):
        hist = [(x, rng.randrange(1, 30)) for x in sorted(rng.sample(range(60), rng.randrange(1, 10)))]
        k = rng.randrange(1, 6)
        lengths = [h[0] for h in hist]
        best = min(padding_of(hist, (*c, lengths[-1]))
                   for m in range(min(k, len(hist))) for c in itertools.combinations(lengths[:-1], m))
        cuts = length_buckets.boundaries(hist, k)
        assert cuts == sorted(set(cuts)) and len(cuts) <= k and cuts[-1] == lengths[-1]
        assert padding_of(hist, cuts) == best
    assert length_buckets.boundaries([], 4) == []


def brute_pack(docs, k, budget):
    lens = sorted((len(re.findall(r"[^ \t\n\r]+", t or "")), d) for d, t in docs)
    cuts = length_buckets.boundaries(sorted(Counter(n for n, _ in lens).items()), k)
    seen, out = Counter(), []
    for n, d in lens:
        b = next(i for i, c in enumerate(cuts) if n <= c)
        cap = max(1, budget // max(1, cuts[b]))
        out.append((d, n, b, cuts[b], seen[b] // cap, seen[b] % cap, cuts[b] - n))
        seen[b] += 1
    return sorted(out)


def test_pack(spark, edge, empty):
    docs = [(i, prose((i * 37) % 200, i)) for i in range(150)] + [(500, prose(3000)), (501, None), (502, " ")]
    got = length_buckets.pack(spark.createDataFrame(docs, "doc_id long, text string"), 5, 400)
    assert sorted(rows_of(got)) == brute_pack(docs, 5, 400)
    out = length_buckets.pack(edge).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r["doc_id"] for r in edge.collect())
    used = Counter((r["bucket"], r["batch"]) for r in out)
    assert all(used[r["bucket"], r["batch"]] * r["boundary"] <= length_buckets.TOKEN_BUDGET
               or used[r["bucket"], r["batch"]] == 1 for r in out)
    assert length_buckets.pack(empty).count() == 0


def test_nothing_is_broadcast_but_the_filter(spark):
    codes = spark.createDataFrame([(-5,), (0,), (1 << 62,), ((1 << 63) - 1,)], "code long")
    bits = decontam.shingle_filter(codes, 1 << 12)
    at = {(c % (1 << 64)) >> 52 for c in (-5, 0, 1 << 62, (1 << 63) - 1)}
    assert {i for i in range(1 << 12) if int(bits[i // 64]) >> i % 64 & 1} == at
    n, k = codes.select(*decontam.size_partition(F.lit(50))).first()
    assert (n, k) == (10, 13)
