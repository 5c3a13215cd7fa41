"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad by a two-state chain: state weights over
features of the line and of its neighbours (shares of symbols, capitals, bars
and digits, word repetition and stutter, length, sentence ends, copies of the line in the
text), and transition and start weights. Forward-backward gives each line's
marginal probability of being good; their mean, weighted by line length, is the
document's quality, and a monotone scaling learned on the fit sample turns it
into the score.

Fit: labels are known for documents, so a labelled text's lines all take its
label. Maximum likelihood with ridge penalty by full-batch gradient steps, on
at most ``FIT_DOCS`` labelled texts (the least hashes of their ids) and
``FIT_LINES`` lines in that order; a text with more lines than that bound does
not enter the fit. Only the features of that sample reach the driver.

Defined results: null and empty texts are one empty line and get a score like
any other; null labels are not learned from; without labels every score is
0.5; a repeated id enters the fit once; repeated rows score alike; empty tables
give an empty result; whole texts are read; other columns are ignored.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrec.llm.common import as_text, quoted
from dwellrec.session import materialize

FIT_DOCS = 3000
FIT_LINES = 120_000
RIDGE = 1e-3
STEPS = 250
_SYMBOL = re.compile(r"[#$%&*!<>{}\[\]=~^@\\/_+]")
_END = (".", "?", "!", ":", ";", '"', "'", ")")
OWN = ("symbols", "runs", "capitals", "bars", "digits", "repeats", "short", "long", "word length",
       "no end", "copies", "stutter", "empty")
NEIGHBOUR = ("symbols", "capitals", "bars", "stutter", "short")
N_FEATURES = 1 + len(OWN) + 2 * (len(NEIGHBOUR) + 1)


def _line(line: str, copies: int) -> list[float]:
    """The features of one line, each between 0 and 1."""
    n = len(line)
    words = line.split()
    if not words:
        return [0.0] * (len(OWN) - 1) + [1.0]
    k = len(words)
    symbols = len(_SYMBOL.findall(line))
    upper = sum(map(str.isupper, words))
    bars = line.count("|")
    return [min(1.0, 3.0 * symbols / n), min(1.0, symbols / k), upper / k, min(1.0, 2.0 * bars / k),
            min(1.0, 4.0 * sum(map(str.isdigit, words)) / k), 1.0 - len(set(words)) / k,
            1.0 / (1.0 + k), min(1.0, math.log1p(n) / 10.0), min(1.0, (n - k + 1) / k / 12.0),
            0.0 if line.rstrip().endswith(_END) else 1.0, 1.0 - 1.0 / copies,
            sum(map(operator.eq, words, words[1:])) / k, 0.0]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines, N_FEATURES) and the lines' lengths of a whole text."""
    lines = text.split("\n")
    seen = Counter(lines)
    own = np.array([_line(x, seen[x]) for x in lines])
    near = own[:, [OWN.index(x) for x in NEIGHBOUR]]
    out = np.zeros((len(lines), N_FEATURES))
    out[:, 0] = 1.0
    out[:, 1:1 + len(OWN)] = own
    at = 1 + len(OWN)
    for shift in (1, -1):
        to, of = (slice(1, None), slice(None, -1)) if shift == 1 else (slice(None, -1), slice(1, None))
        out[to, at:at + len(NEIGHBOUR)] = near[of]
        out[to, at + len(NEIGHBOUR)] = 1.0             # there is such a neighbour
        at += len(NEIGHBOUR) + 1
    return out, np.array([len(x) + 1.0 for x in lines])


def chain(emit: np.ndarray, stay: float, lean: float, start: float):
    """Forward-backward in log-odds. State good scores emit[i] in line i, bad
    scores 0; a kept state scores ``stay``, a step into good ``lean``, a good
    first line ``start``. → marginal log-odds of good, one per line."""
    n = len(emit)
    fwd, bwd = [0.0] * n, [0.0] * n
    e = emit.tolist()
    a = e[0] + start
    fwd[0] = a
    for i in range(1, n):
        a = e[i] + lean + _mix(a, stay)
        fwd[i] = a
    b = 0.0
    for i in range(n - 2, -1, -1):
        b = _mix(b + e[i + 1] + lean, stay)
        bwd[i] = b
    return np.array(fwd) + np.array(bwd)


def _mix(x: float, stay: float) -> float:
    """log((e^(x+stay) + 1) / (e^x + e^stay)): log-odds after one transition."""
    hi = x + stay
    up = hi + math.log1p(math.exp(-hi)) if hi > 0 else math.log1p(math.exp(hi))
    d = x - stay
    down = x + math.log1p(math.exp(-d)) if d > 0 else stay + math.log1p(math.exp(d))
    return up - down


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Model:
    def __init__(self, weights, stay=0.0, lean=0.0, start=0.0, slope=1.0, offset=0.0):
        self.weights, self.stay, self.lean, self.start = weights, stay, lean, start
        self.slope, self.offset = slope, offset

    def quality(self, x: np.ndarray, length: np.ndarray) -> float:
        """Length-weighted mean of the lines' marginals."""
        p = _sigmoid(chain(x @ self.weights, self.stay, self.lean, self.start))
        return float((p * length).sum() / length.sum())

    def calibrated(self, q: float) -> float:
        q = min(1 - 1e-6, max(1e-6, q))
        return float(_sigmoid(self.slope * math.log(q / (1 - q)) + self.offset))

    def score(self, text: str | None) -> float:
        return self.calibrated(self.quality(*features(text or "")))


def _likelihood_gradient(x, starts, sizes, y, w, stay, lean, start):
    """Gradient of the mean log-likelihood per document; all documents of the
    sample advance together, one line at a time (longest first)."""
    emit = x @ w
    n_docs, longest = len(sizes), int(sizes.max())
    fwd = np.full((len(emit), 2), -np.inf)
    bwd = np.zeros((len(emit), 2))
    alive = [int((sizes > t).sum()) for t in range(longest)]      # sizes are descending
    move = np.array([[stay, lean], [0.0, stay + lean]])           # from (bad, good) to (bad, good)
    at = starts.copy()
    fwd[at, 0], fwd[at, 1] = 0.0, emit[at] + start
    for t in range(1, longest):
        k = alive[t]
        now, was = starts[:k] + t, starts[:k] + t - 1
        for s in (0, 1):
            fwd[now, s] = np.logaddexp(fwd[was, 0] + move[0, s], fwd[was, 1] + move[1, s])
        fwd[now, 1] += emit[now]
    for t in range(longest - 2, -1, -1):
        k = alive[t + 1]
        now, nxt = starts[:k] + t, starts[:k] + t + 1
        for s in (0, 1):
            bwd[now, s] = np.logaddexp(move[s, 0] + bwd[nxt, 0], move[s, 1] + emit[nxt] + bwd[nxt, 1])
    last = starts + sizes - 1
    z = np.logaddexp(fwd[last, 0], fwd[last, 1])
    doc = np.repeat(np.arange(n_docs), sizes)
    good = np.exp(fwd[:, 1] + bwd[:, 1] - z[doc])
    label = y[doc]
    g_w = x.T @ ((label - good) / n_docs)
    inner = np.ones(len(emit), dtype=bool)
    inner[starts] = False                                         # lines with a line before
    i = np.flatnonzero(inner)
    both = {}
    for a in (0, 1):
        for b in (0, 1):
            both[a, b] = np.exp(fwd[i - 1, a] + move[a, b] + (emit[i] if b else 0) + bwd[i, b] - z[doc[i]])
    # within a text all labels agree, so every step keeps its state
    g_stay = (1.0 - both[0, 0] - both[1, 1]).sum() / n_docs
    g_lean = (label[i] - both[0, 1] - both[1, 1]).sum() / n_docs
    g_start = (y - good[starts]).sum() / n_docs
    like = (np.where(y > 0, np.bincount(doc, emit) + start + (sizes - 1) * (stay + lean),
                     (sizes - 1) * stay) - z).mean()
    return like, np.concatenate([g_w, [g_stay, g_lean, g_start]])


def fit_sample(docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, steps: int = STEPS) -> Model:
    """Fit on (features, lengths) of documents and their 0/1 labels."""
    if not docs:
        return Model(np.zeros(N_FEATURES))
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i][0]))
    sizes = np.array([len(docs[i][0]) for i in order])
    x = np.concatenate([docs[i][0] for i in order])
    y_sorted = np.asarray(y, dtype=float)[order]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    theta = np.zeros(N_FEATURES + 3)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        _, g = _likelihood_gradient(x, starts, sizes, y_sorted, theta[:-3], *theta[-3:])
        g -= RIDGE * theta
        g[-3] -= 0.05 * theta[-3]                  # labels never switch within a text: hold it finite
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta += 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    model = Model(theta[:-3], *map(float, theta[-3:]))
    q = np.clip([model.quality(*d) for d in docs], 1e-6, 1 - 1e-6)
    u, label = np.log(q / (1 - q)), np.asarray(y, dtype=float)
    a, b = 1.0, 0.0
    for _ in range(100):
        p = _sigmoid(a * u + b)
        wt = p * (1 - p) + 1e-6
        g = np.array([((p - label) * u).sum() + 0.1 * (a - 1), (p - label).sum() + 0.1 * b])
        h = np.array([[(wt * u * u).sum() + 0.1, (wt * u).sum()], [(wt * u).sum(), wt.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a - 0.5 * step[0], b - 0.5 * step[1]
    model.slope, model.offset = max(0.05, float(a)), float(b)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_docs: int = FIT_DOCS,
        max_lines: int = FIT_LINES) -> Model:
    """docs (doc_id, text) and labels (doc_id, ``label`` 0/1) to learn from."""
    known = labels.select("doc_id", quoted(label).alias("y")).where("doc_id is not null and y is not null")
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    sample = materialize(docs.select("doc_id", as_text("text").alias("t"))
                         .join(F.broadcast(picked), "doc_id")               # max_docs rows at most
                         .groupBy("doc_id", "y").agg(F.min("t").alias("t"))
                         .withColumn("n", F.size(F.split("t", "\n", -1))), "quality-sample")
    chosen, lines = [], 0
    for r in sample.select("doc_id", "n").orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        if lines + r["n"] <= max_lines:
            chosen.append(r["doc_id"])
            lines += r["n"]
    if not chosen:
        return fit_sample([], np.zeros(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0].ravel().tolist() for g in got], pa.list_(pa.float64())),
                 pa.array([g[1].tolist() for g in got], pa.list_(pa.float64()))], names=["y", "x", "len"])

    small = sample.where(F.col("n") <= max_lines).join(
        sample.sparkSession.createDataFrame([(c,) for c in chosen], ["doc_id"]), "doc_id")
    rows = (small.select(F.col("y").cast("int").alias("y"), "t")
            .mapInArrow(run, "y int, x array<double>, len array<double>").toArrow())
    xs = [np.asarray(v.values).reshape(-1, N_FEATURES) for v in rows.column("x")]
    ls = [np.asarray(v.values) for v in rows.column("len")]
    return fit_sample(list(zip(xs, ls)), np.array(rows.column("y").to_pylist()))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, good_lines): good_lines is the number of lines whose
    marginal favours good."""
    src = docs.select(quoted(doc_id).alias("doc_id"), as_text(text).alias("t"))
    schema = src.select("doc_id").schema.add("score", "double").add("good_lines", "integer")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            scores, good = [], []
            for t in b.column(1).to_pylist():
                x, length = features(t)
                odds = chain(x @ model.weights, model.stay, model.lean, model.start)
                scores.append(model.calibrated(float((_sigmoid(odds) * length).sum() / length.sum())))
                good.append(int((odds > 0).sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(scores, pa.float64()), pa.array(good, pa.int32())],
                names=["doc_id", "score", "good_lines"])

    return src.mapInArrow(run, schema)


def learnable(labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Label rows to learn from: crc32 of the id's text modulo ``folds`` is not ``held``."""
    return labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != held)
