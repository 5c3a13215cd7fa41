"""Language identification by error-correcting output codes.

Every learned language has a codeword; each bit of the code is a binary
classifier of character n-grams (naive Bayes over hashed 1- to 3-grams of
letters, word edges included), which tells the languages with a 1 in that
column from those with a 0. A text's mean log-odds per n-gram are scaled to
margins on held-back sample texts, where each bit's reliability is measured as
well. Decoding adds the logistic losses of all bits against each codeword,
weighted by reliability, and takes the codeword of least loss: with d bits
between any two codewords, up to (d-1)/2 wrong bits are corrected. A text is
flagged ambiguous when the runner-up is within ``AMBIGUOUS`` of the best
(loss per unit of weight). ``keep_identified`` rejects a text whose bits lose
too much per unit of weight against the best codeword, so that they spell no
learned language: more than ``REJECT`` (half of what coin tosses would lose) and
than ``SLACK`` times what 0.995 of the sample texts held back for the margins
lose. Bits that learned nothing reliable therefore reject hardly anything.

Codes: all 2^(L-1) - 1 column splits for up to 7 languages, else the best of
seeded random codes of 10·log2(L) bits.

Fit: on at most ``FIT_PER_LANG`` texts of each language, those with the least
hash of their id; half of them give n-gram counts, half margins. Counts are
summed in Spark: (languages × 2^14) numbers reach the driver, and
``FIT_PER_LANG``/2 margins a language.

Defined results: null texts and texts without a letter are ``und`` with score
0; no learned language at all makes everything ``und``; one language wins with
score 1; rows with a null id or language are not learned from, but predicted;
repeated rows are predicted alike; an empty table gives an empty result; whole
texts are read. ``keep_identified`` carries all columns; with fewer than two
learned languages there is no code to reject by, and texts with a letter stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellrec.llm.common import as_text, fresh, quoted
from dwellrec.session import materialize

FIT_PER_LANG = 800
DIM_BITS = 14
AMBIGUOUS = 0.1
REJECT = math.log(2) / 2
SLACK = 1.25
UNKNOWN = "und"
_LETTER = np.array([chr(i).isalpha() for i in range(0x110000)])
_SLICE = 1 << 20          # letters hashed at a time


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hashed n-gram numbers of an array of code points (spaces: 32)."""
    c = codes.astype(np.uint32)
    shift = np.uint32(32 - DIM_BITS)
    is_letter = c != 32
    one = (c * np.uint32(2654435761) + np.uint32(97)) * np.uint32(2246822519)
    two = (c[:-1] * np.uint32(2654435761) + c[1:]) * np.uint32(3266489917)
    three = ((c[:-2] * np.uint32(2654435761) + c[1:-1]) * np.uint32(2246822519)
             + c[2:]) * np.uint32(668265263)
    return np.concatenate([(one >> shift)[is_letter], (two >> shift)[is_letter[:-1] | is_letter[1:]],
                           (three >> shift)[is_letter[1:-1]]])


def gram_slices(text: str) -> Iterator[np.ndarray]:
    """n-grams of a whole text, a bounded slice at a time; none without letters."""
    c = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _LETTER[c]
    if letter.any():
        c = np.where(letter, c, np.uint32(32))
        for at in range(0, len(c) - 2, _SLICE):
            yield _grams(c[at:at + _SLICE + 2])


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """(n, bits) matrix of ±1."""
    if n <= 1:
        return np.zeros((n, 0))
    if n <= 7:
        cols = np.arange(1, 1 << (n - 1))
        code = np.array([[(c >> k) & 1 for c in cols] for k in range(n - 1)] + [[0] * len(cols)])
        return code * 2.0 - 1
    rng, best = np.random.default_rng(seed), (-1, None)
    for _ in range(64):
        code = rng.integers(0, 2, (n, math.ceil(10 * math.log2(n)))) * 2.0 - 1
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = min(int((code[i] != code[i + 1:]).sum(axis=1).min()) for i in range(n - 1))
        if apart > best[0]:
            best = (apart, code)
    return best[1]


class Model:
    """Languages, codewords (L, B), n-gram log-odds (2^14, B), and per bit the
    margin's slope and offset and the bit's weight; the loss that rejects."""

    def __init__(self, langs, code, odds, slope, offset, weight, reject=REJECT):
        self.langs, self.code, self.odds = list(langs), code, odds.astype(np.float32)
        self.slope, self.offset, self.weight, self.reject = slope, offset, weight, reject

    def log_odds(self, text: str | None) -> np.ndarray | None:
        """Mean log-odds of the bits, None for a text without letters."""
        total, n = np.zeros(self.code.shape[1]), 0
        for g in gram_slices(text or ""):
            total += self.odds.take(g, axis=0).sum(axis=0, dtype=np.float64)
            n += len(g)
        return total / n if n else None

    def decode(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous)."""
        return self.verdict(text)[:3]

    def verdict(self, text: str | None) -> tuple[str, float, bool, float]:
        """(language, score, ambiguous, loss per unit of weight of its codeword)."""
        x = self.log_odds(text)
        if x is None or not self.langs:
            return UNKNOWN, 0.0, True, math.inf
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False, 0.0
        z = self.slope * x + self.offset
        loss = np.logaddexp(0, -self.code * z) @ self.weight
        best = int(np.argmin(loss))
        p = np.exp(loss[best] - loss)
        gap = np.partition(loss, 1)[1] - loss[best]
        total = self.weight.sum()
        return self.langs[best], float(1 / p.sum()), bool(gap < AMBIGUOUS * total), float(loss[best] / total)


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """(slope, offset, accuracy) of a one-dimensional logistic fit."""
    a, b, t = 1.0, 0.0, (y > 0).astype(float)
    scale = max(float(np.abs(x).max(initial=0)), 1e-9)
    u = x / scale
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * u + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([((p - t) * u).sum() + 1e-2 * a, (p - t).sum() + 1e-3 * b])
        h = np.array([[(w * u * u).sum() + 1e-2, (w * u).sum()],
                      [(w * u).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
    right = float(((a * u + b > 0) == (y > 0)).mean()) if len(x) else 0.5
    return a / scale, b, right


def _least_hashes(ids: DataFrame, per_lang: int) -> DataFrame:
    """(doc_id, lang, r): about the ``per_lang`` least id hashes of a language,
    never more. A language's count tells below which hash a quarter more than
    that lie, so that its window holds no more rows, whatever its share."""
    counts = materialize(ids.groupBy("lang").agg(F.count("*").alias("n")), "langid-counts")
    below = F.lit(1.25 * per_lang * (1 << 30)) / F.col("n")
    few = ids.join(counts, "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < below)
    w = Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), "doc_id")
    ranked = few.select("doc_id", "lang", F.row_number().over(w).alias("r"))
    return materialize(ranked.where(F.col("r") <= per_lang), "langid-picked")


def fit(rows: DataFrame, per_lang: int = FIT_PER_LANG) -> Model:
    """rows (doc_id, text, lang), the ones to learn from."""
    usable = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    picked = _least_hashes(usable.select("doc_id", "lang").distinct(), per_lang)
    sample = materialize(usable.join(picked, ["doc_id", "lang"]).groupBy("doc_id", "lang", "r")
                         .agg(F.min("text").alias("text")), "langid-sample")
    langs = [r[0] for r in sample.select("lang").distinct().orderBy("lang").collect()]
    code, dim = codewords(len(langs)), 1 << DIM_BITS
    if len(langs) < 2:
        return Model(langs, code, np.zeros((dim, 0)), np.zeros(0), np.zeros(0), np.zeros(0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                into = total.setdefault(lang, np.zeros(dim, dtype=np.int64))
                for g in gram_slices(text):
                    into += np.bincount(g, minlength=dim)
        for lang, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(c[at])],
                names=["lang", "gram", "n"])

    half = sample.select("lang", "text", "r")
    counted = (half.where("r % 2 = 1").select("lang", "text").mapInArrow(count, "lang string, gram int, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counts = np.zeros((len(langs), dim))
    number = {k: i for i, k in enumerate(langs)}
    for r in counted.toLocalIterator():
        counts[number[r["lang"]], r["gram"]] = r["n"]
    freq = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)    # languages count alike
    odds = np.zeros((dim, code.shape[1]))
    for bit in range(code.shape[1]):
        p1 = freq[code[:, bit] > 0].mean(axis=0) + 1e-6
        p0 = freq[code[:, bit] < 0].mean(axis=0) + 1e-6
        odds[:, bit] = np.log(p1 / p1.sum()) - np.log(p0 / p0.sum())
    ones = np.ones(code.shape[1])
    raw = Model(langs, code, odds, ones, 0 * ones, ones)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(lang, x.tolist()) for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                   if (x := raw.log_odds(t)) is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.list_(pa.float64()))],
                names=["lang", "x"])

    seen = (half.where("r % 2 = 0").select("lang", "text")
            .mapInArrow(margins, "lang string, x array<double>").collect())
    x = np.array([r["x"] for r in seen]).reshape(-1, code.shape[1])
    y = np.array([code[number[r["lang"]]] for r in seen]).reshape(-1, code.shape[1])
    fits = np.array([_platt(x[:, b], y[:, b]) for b in range(code.shape[1])])
    accuracy = np.clip(fits[:, 2], 0.5, 1 - 1 / (2 * len(x) + 2))
    weight = np.log(accuracy / (1 - accuracy)) + 1e-3
    weight = weight / weight.mean()
    z = fits[:, 0] * x + fits[:, 1]
    lost = np.array([np.logaddexp(0, -code * row) @ weight for row in z]).reshape(-1, len(langs)).min(axis=1)
    usual = float(np.quantile(lost, 0.995)) / weight.sum() if len(lost) else math.inf
    return Model(langs, code, odds, fits[:, 0], fits[:, 1], weight, max(REJECT, SLACK * usual))


def identify(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` (all columns) with the language, its score, the ambiguity flag
    and the codeword's loss in four added columns, whose names are returned."""
    names = [fresh(docs, c) for c in ("lang_pred", "lang_score", "lang_ambiguous", "lang_loss")]
    src = docs.select("*", as_text(text).alias(fresh(docs, "_t")))
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType(), T.DoubleType())
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, names, kinds)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdict = shared.value.verdict
        for b in batches:
            got = [verdict(t) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_()),
                 pa.array([g[3] for g in got], pa.float64())],
                names=schema.names)

    return src.mapInArrow(run, schema), names


def learnable(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Rows to learn from: crc32 of the id's text modulo ``folds`` is not ``held``."""
    return docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != held)


def keep_identified(docs: DataFrame, per_lang: int = FIT_PER_LANG) -> DataFrame:
    """``docs`` without the texts that have no identifiable language: no letter
    at all, or bits that spell none (a loss over the model's limit). Ambiguous texts stay."""
    model = fit(learnable(docs).select("doc_id", "text", "lang"), per_lang)
    if not model.langs:       # nothing to learn from: only texts without a letter go
        model.langs = ["any"]
    found, (lang, _, _, loss) = identify(docs, model)
    return found.where((quoted(lang) != UNKNOWN) & (quoted(loss) <= F.lit(model.reject))).select(*[quoted(c) for c in docs.columns])
