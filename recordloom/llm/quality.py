"""Quality scores by positive-unlabelled learning with a non-negative risk.

A text becomes some twenty figures (shares of character kinds, repeated words, word lengths ...).  Trusted
positives are labelled rows outside the held-out fold, unlabelled are rows of the whole table, each at most
``SAMPLE`` in hash order.  A first classifier of positives against unlabelled gives the class prior: the
smallest ratio of the two score distributions' tails.  Then a small network minimises the non-negative unbiased
risk (Kiryo et al., 2017): prior * positive risk + max(0, unlabelled risk - prior * positive risk as negatives).
Negative labels are never read.

Defined results: null text is empty and scored like any; repeated rows give repeated rows, and of several
texts of an id that with the smallest hash is learnt from; null doc_id is carried; without positives or unlabelled rows every score is 0.5; an empty table gives an empty table; all columns of the
input are kept, and an input column named like a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import CHARS, slices, texts_of, trimmed
from .toxicity import one_text
from .words import END, LETTER, NUMBER, SPACE, class_table, code_points, token_array

SAMPLE = 10_000
SEED = 7
SYMBOLS = "#*$%&|<>"
FIGURES = 20


def figures(texts: list[str]) -> np.ndarray:
    """A row of figures for each text."""
    cps, ends = code_points(texts)
    cls = class_table()[cps]
    first = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    if not len(texts):
        return np.zeros((0, FIGURES))
    low = np.minimum(cps, 0x1FF)
    kind = np.zeros(0x200, bool)
    upper = kind.copy()
    upper[[c for c in range(0x200) if chr(c).isupper()]] = True
    symbol = kind.copy()
    symbol[[ord(c) for c in SYMBOLS]] = True
    stop = kind.copy()
    stop[[ord(c) for c in ".,;:?"]] = True
    count = lambda m: np.add.reduceat(m, first, dtype=np.int64)
    space = (cls == SPACE) | (cls == END)
    start = np.empty(len(cps), bool)
    start[:1] = True
    start[1:] = space[1:] != space[:-1]
    start[first] = True
    tokens, at = token_array(cps, start)
    keep = ~space[at]
    size = np.diff(np.append(at, len(cps)))[keep]
    at = at[keep]
    coded = tokens.filter(pa.array(keep)).dictionary_encode()
    idx = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.searchsorted(ends, at)
    per = lambda w=None: np.bincount(doc, weights=w, minlength=len(texts))
    many = max(1, len(coded.dictionary))
    distinct = np.bincount(np.unique(doc * many + idx) // many, minlength=len(texts))
    same = np.zeros(len(idx))
    same[1:] = (idx[1:] == idx[:-1]) & (doc[1:] == doc[:-1])
    pair = np.unique(np.stack([doc[:-1], idx[:-1], idx[1:]])[:, doc[1:] == doc[:-1]], axis=1)[0]
    pairs = np.bincount(pair, minlength=len(texts)) if len(pair) else np.zeros(len(texts))
    last = np.minimum(cps[at + size - 1], 0x1FF) if len(at) else np.empty(0, np.int64)
    head = np.minimum(cps[at], 0x1FF) if len(at) else last
    n = np.maximum(1, np.diff(np.append(first, len(cps))) - 1)
    words = np.maximum(1, per())
    letters = np.maximum(1, count(cls == LETTER))
    lines = np.maximum(1, count(cps == 10) + 1)
    out = [
        np.log1p(n), np.log1p(per()), letters / n, count(cls == NUMBER) / n, count(space) / n, count(cps == 10) / n, count(symbol[low]) / n, count(cps == 33) / n,
        count(cps == 124) / n, count(stop[low]) / n, count(upper[low]) / letters, per(size) / words, np.sqrt(np.maximum(0, per(size.astype(float) ** 2) / words - (per(size) / words) ** 2)),
        distinct / words, per(same) / words, pairs / np.maximum(1, words - 1), per(symbol[last]) / words, per(upper[head]) / words, np.log1p(words / lines), count(cps > 0x24F) / n,
    ]
    return np.stack(out, axis=1)


class Net:
    """One hidden layer; trained by Adam on any loss that gives the gradient at the output."""

    def __init__(self, width: int, hidden: int, rng: np.random.Generator):
        self.w = [rng.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        self.m, self.v, self.t = [np.zeros_like(x) for x in self.w], [np.zeros_like(x) for x in self.w], 0

    def out(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.tanh(x @ self.w[0] + self.w[1])
        return h @ self.w[2] + self.w[3][0], h

    def step(self, x: np.ndarray, h: np.ndarray, g: np.ndarray, rate: float = 0.01, decay: float = 1e-4) -> None:
        back = np.outer(g, self.w[2]) * (1 - h * h)
        grads = [x.T @ back, back.sum(axis=0), h.T @ g, np.array([g.sum()])]
        self.t += 1
        for k, d in enumerate(grads):
            d = d + decay * self.w[k]
            self.m[k] = 0.9 * self.m[k] + 0.1 * d
            self.v[k] = 0.999 * self.v[k] + 0.001 * d * d
            self.w[k] = self.w[k] - rate * self.m[k] / (1 - 0.9**self.t) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _train(pos: np.ndarray, unl: np.ndarray, gradient, rng: np.random.Generator, steps: int, net: Net | None = None) -> Net:
    net = net or Net(pos.shape[1], 16, rng)
    for _ in range(steps):
        p, u = pos[rng.integers(0, len(pos), 256)], unl[rng.integers(0, len(unl), 256)]
        x = np.concatenate([p, u])
        z, h = net.out(x)
        net.step(x, h, gradient(z[:256], z[256:]))
    return net


def estimate_prior(pos: np.ndarray, unl: np.ndarray, rng: np.random.Generator) -> float:
    """The share of positives among the unlabelled, from the tails of a classifier of the two."""

    def gradient(p: np.ndarray, u: np.ndarray) -> np.ndarray:
        return np.concatenate([(_sigmoid(p) - 1) / len(p), _sigmoid(u) / len(u)]) / 2

    half_p, half_u = len(pos) // 2, len(unl) // 2
    net = _train(pos[:half_p], unl[:half_u], gradient, rng, 600)
    p, u = np.sort(net.out(pos[half_p:])[0]), np.sort(net.out(unl[half_u:])[0])
    t = np.quantile(p, np.linspace(0.02, 0.6, 30))
    share = (len(u) - np.searchsorted(u, t)) / len(u) / ((len(p) - np.searchsorted(p, t)) / len(p))
    return float(np.clip(share.min(), 0.05, 0.98))


def logistic_risks(p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """(risk of positives, risk of negatives estimated from unlabelled less positives) of outputs, logistic loss."""
    loss = lambda z: np.log1p(np.exp(np.clip(z, -50, 50))).mean()
    return prior * loss(-p), loss(u) - prior * loss(p)


def logistic_step(p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Gradient at the outputs of the whole risk, or of the negatives' risk turned round while that is below 0."""
    a, b = _sigmoid(p) / len(p), _sigmoid(u) / len(u)
    if logistic_risks(p, u, prior)[1] < 0:
        return np.concatenate([prior * a, -b])
    return np.concatenate([prior * (a - 1 / len(p)) - prior * a, b])


def bounded_risks(p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """The same of the sigmoid loss: sure positives of a batch no longer drown the rest."""
    return prior * _sigmoid(-p).mean(), _sigmoid(u).mean() - prior * _sigmoid(p).mean()


def bounded_step(p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    s, t = _sigmoid(p), _sigmoid(u)
    dp, du = prior * s * (1 - s) / len(p), t * (1 - t) / len(u)
    return np.concatenate([dp, -du]) if bounded_risks(p, u, prior)[1] < 0 else np.concatenate([-2 * dp, du])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict | None:
    """The model, from trusted positives and unlabelled rows; None if either is missing."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    train = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    trusted = labels.where((F.col("quality") == 1) & train).select(F.col("doc_id").cast("long").alias("doc_id")).distinct().orderBy(*order).limit(sample)
    some = own.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(sample)
    marks = trusted.withColumn("p", F.lit(1)).join(some.withColumn("u", F.lit(1)), "doc_id", "full")  # at most 2 * sample rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            for part in slices(batch, chars=CHARS):
                rows = pa.array(list(figures(texts_of(part))), pa.list_(pa.float64()))
                yield pa.record_batch([part.column(0), part.column(2), part.column(3), rows], names=["doc_id", "p", "u", "x"])

    got = one_text(own.join(F.broadcast(marks), "doc_id"), "p", "u").mapInArrow(run, "doc_id long, p int, u int, x array<double>")
    rows = sorted(got.collect(), key=lambda r: r.doc_id)
    pos, unl = np.array([r.x for r in rows if r.p]), np.array([r.x for r in rows if r.u])
    if len(pos) < 2 or len(unl) < 2:
        return None
    mean, dev = unl.mean(axis=0), unl.std(axis=0) + 1e-6
    scale = lambda x: np.clip((x - mean) / dev, -6, 6)
    rng = np.random.default_rng(SEED)
    pos, unl = rng.permutation(scale(pos)), rng.permutation(scale(unl))
    prior = estimate_prior(pos, unl, rng)

    net = _train(pos, unl, lambda p, u: logistic_step(p, u, prior), rng, 1500)
    net = _train(pos, unl, lambda p, u: bounded_step(p, u, prior), rng, 1500, net)
    return {"mean": mean, "dev": dev, "w": net.w, "prior": prior}


def score(docs: DataFrame, model: dict | None, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    rest = docs.select(*[F.col(f"`{f.name}`") for f in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Net(FIGURES, 1, np.random.default_rng(0))
        if model:
            net.w = model["w"]
        for batch in trimmed(batches):
            for part in slices(batch, chars=CHARS):
                if model:
                    s = _sigmoid(net.out(np.clip((figures(texts_of(part)) - model["mean"]) / model["dev"], -6, 6))[0])
                else:
                    s = np.full(part.num_rows, 0.5)
                yield pa.record_batch([*part.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*part.schema.names, "score", "predicted"])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rest.mapInArrow(run, f"{out}, score double, predicted int")
