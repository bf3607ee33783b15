"""Quality classifier, learned from trusted positives and unlabelled web text by non-negative risk.

With p the trusted positives, u the unlabelled texts and c the share of positives in u, the risk of a
scorer g is  c E_p l(g) + max(0, E_u l(-g) - c E_p l(-g)),  l the sigmoid loss: the second part is an
unbiased estimate of the risk on negatives, and as that cannot be negative it is held at zero. When it
falls below, a step is taken to raise it. The class prior c is estimated from the lowest ratio of u to p
among the sets of texts that a first scorer of p against u ranks above a threshold, each with its standard error. The scorers are fitted on
samples of `positives` and `unlabelled` texts at most (parameters); the shares of u that the prior follows from are
counted over all texts that may be learned from. For that there are two first scorers, each fitted on one half of
the samples and asked about the other half of all texts.

A null text counts as empty; an empty text has a score like any other. Rows with a null doc_id are scored
but never learned from, repeated rows are scored alike. Without positives every score is 0.5. An empty table
gives an empty result. Only doc_id and text are read from the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, lean, utf8

#: Bounds of the samples that scorers are fitted on: trusted positives, and unlabelled texts.
POSITIVES, UNLABELLED = 8_000, 16_000
#: Bytes that are compressed at once, over the whole text: repetition within a window.
WINDOW = 1 << 15
#: Shares of the 256 bytes, and sizes and repetition.
FEATURES = 256 + 16


def features(texts: pa.Array) -> np.ndarray:
    """A row of features of each text: shares of bytes, sizes of words, and how much repeats."""
    data, offsets = utf8(texts)
    texts = pc.fill_null(texts, "")
    out = np.zeros((len(texts), FEATURES), np.float32)
    cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    words = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
    flat = cut.flatten()
    codes = flat.dictionary_encode().indices.to_numpy()
    sizes = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.float32)
    lines = pc.count_substring(texts, "\n").to_numpy()
    for i in range(len(texts)):
        a, b = offsets[i], offsets[i + 1]
        n, own, of_word = int(b - a), data[a:b], codes[words[i] : words[i + 1]]
        out[i, :256] = np.sqrt(np.bincount(own, minlength=256) / max(1, n))
        raw = own.tobytes()
        packed = sum(len(zlib.compress(raw[k : k + WINDOW], 1)) for k in range(0, n, WINDOW))
        different, length = np.unique(of_word, return_counts=True)[1], sizes[words[i] : words[i + 1]]
        upper = float(((own >= 65) & (own <= 90)).sum())
        lower = float(((own >= 97) & (own <= 122)).sum() + (own >= 128).sum())
        odd = n - upper - lower - float((own == 32).sum() + (own == 10).sum())
        many = len(of_word)
        out[i, 256:] = (
            np.log1p(n) / 10, np.log1p(many) / 8, packed / max(20, n), np.log(max(1, len(different))) / np.log(max(2, many)), len(different) / many, different.max() / many,
            np.count_nonzero(of_word[1:] == of_word[:-1]) / many, np.count_nonzero(of_word[2:] == of_word[:-2]) / many, length.mean() / 10, length.std() / 10, length.max(initial=0) > 40,
            upper / max(1, upper + lower), odd / max(1, n), lines[i] / many, n < 40, n == 0,
        )
    return out


@dataclass
class Model:
    """A scorer of one hidden layer; centre and scale are of the unlabelled features."""

    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8)

    def score(self, x: np.ndarray) -> np.ndarray:
        z, _ = forward(self.weights, self.scaled(x))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def forward(weights: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = weights
    h = np.tanh(x @ w1 + b1)
    return h @ w2 + b2[0], h


def gradient(weights: list[np.ndarray], x: np.ndarray, h: np.ndarray, dz: np.ndarray) -> list[np.ndarray]:
    dh = np.outer(dz, weights[2]) * (1 - h * h)
    return [x.T @ dh, dh.sum(0), h.T @ dz, np.array([dz.sum()], np.float32)]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def descend(p: np.ndarray, u: np.ndarray, slopes, hidden: int, steps: int, decay: float, rate: float = 0.01, seed: int = 7) -> list[np.ndarray]:
    """Adam over mini-batches; slopes(z of p, z of u) gives the derivatives by z."""
    rng = np.random.default_rng(seed)
    w = [rng.normal(0, 0.5 / p.shape[1] ** 0.5, (p.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.5 / hidden**0.5, hidden), np.zeros(1)]
    w = [x.astype(np.float32) for x in w]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    for t in range(1, steps + 1):
        x = np.concatenate((p[rng.integers(0, len(p), 512)], u[rng.integers(0, len(u), 1024)]))
        z, h = forward(w, x)
        g = gradient(w, x, h, np.concatenate(slopes(z[:512], z[512:])).astype(np.float32))
        step = rate * min(1, 2 * (1 - t / (steps + 1)))
        for i in range(4):
            d = g[i] + (decay * w[i] if i in (0, 2) else 0)
            m[i] += 0.1 * (d - m[i])
            v[i] += 0.001 * (d * d - v[i])
            w[i] -= step * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return w


def upper_sets(p: np.ndarray, least: float = 0.3) -> np.ndarray:
    """Thresholds of sets that hold a share `least` of the positives at least, by scores."""
    return np.quantile(p, np.linspace(0.01, 1 - least, 60))


def class_prior(p: np.ndarray, steps: np.ndarray, shares: np.ndarray, n: int) -> float:
    """The lowest ratio of unlabelled to positive texts among the sets above thresholds, by its upper bound: one standard error is added, as the least of noisy ratios is too low. shares are of n unlabelled texts."""
    inside = np.array([np.mean(p >= t) for t in steps]).clip(1e-9)
    # Shares with one more text on either side, so that few texts give no error of zero.
    some, other = (inside * len(p) + 1) / (len(p) + 2), (shares * n + 1) / (n + 2)
    error = np.sqrt((1 - some) / (some * len(p)) + (1 - other) / (other * max(1, n)))
    return float(np.clip(np.min(other / some * (1 + error)), 0.02, 0.98))


def first_scorers(p: np.ndarray, u: np.ndarray, p_half: np.ndarray, u_half: np.ndarray, hidden: int = 16, steps: int = 300) -> list[Model]:
    """Two scorers of p against u: one fitted on the rows that are not marked, one on those that are."""
    centre, scale = u.mean(0), u.std(0) + 1e-3
    out = []
    for own in (False, True):
        parts = [x[marks == own] if (marks == own).any() else x for x, marks in ((p, p_half), (u, u_half))]
        model = Model(centre, scale, [], 0.5)
        model.weights = descend(*(model.scaled(x).astype(np.float32) for x in parts), lambda zp, zu: (-sigmoid(-zp) / len(zp), sigmoid(zu) / len(zu)), hidden, steps, 1e-3)
        out.append(model)
    return out


def fit(p: np.ndarray, u: np.ndarray, prior: float, hidden: int = 16, steps: int = 900) -> Model:
    """Non-negative risk over the features of positives and of unlabelled texts."""
    model = Model(u.mean(0), u.std(0) + 1e-3, [], prior)

    def slopes(zp: np.ndarray, zu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sp, su = sigmoid(zp), sigmoid(zu)
        dp, du = prior * sp * (1 - sp) / len(zp), su * (1 - su) / len(zu)
        if np.mean(su) < prior * np.mean(sp):  # held at zero: undo what went too far
            return dp, -du
        return -2 * dp, du

    model.weights = descend(*(model.scaled(x).astype(np.float32) for x in (p, u)), slopes, hidden, steps, 1e-3)
    return model


def half() -> Column:
    """Whether a row is of the half that is marked."""
    return F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(2)) == 0


def chosen(rows: DataFrame, most: int) -> Column:
    """Whether a row is among about `most` of them at most, by a hash of doc_id."""
    n = rows.count()
    return F.lit(True) if n <= most else F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < int((1 << 30) * (most / n))


def sampled(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The features of a bounded sample, on the driver; and which rows are of the marked half."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = features(batch.column("text"))
                yield pa.record_batch([pa.array([r.tobytes() for r in x], pa.binary()), batch.column("half")], names=["x", "half"])

    found = rows.select(F.coalesce("text", F.lit("")).alias("text"), half().alias("half")).mapInArrow(lean(each), "x binary, half boolean").toArrow()
    pairs = sorted(zip(found.column("x").to_pylist(), found.column("half").to_pylist()))
    return np.frombuffer(b"".join(x for x, _ in pairs), np.float32).reshape(len(pairs), FEATURES), np.array([f for _, f in pairs], bool)


def counts_above(rows: DataFrame, models: list[Model], steps: list[np.ndarray]) -> list[np.ndarray]:
    """How many of the rows' texts each scorer puts at each of its thresholds or above, and how many texts it is asked about: those of the half it was not fitted on. Counted where the rows are."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(s) + 1, np.int64) for s in steps]
        for batch in batches:
            if batch.num_rows:
                x, marks = features(batch.column("text")), batch.column("half").to_numpy(zero_copy_only=False).astype(bool)
                for model, s, count, own in zip(models, steps, counts, (marks, ~marks)):
                    z = np.sort(forward(model.weights, model.scaled(x[own]))[0])
                    count += np.append(len(z) - np.searchsorted(z, s, side="left"), len(z))
        yield pa.record_batch([pa.array(np.arange(sum(map(len, counts)))), pa.array(np.concatenate(counts))], names=["place", "n"])

    parts = rows.select(F.coalesce("text", F.lit("")).alias("text"), half().alias("half")).mapInArrow(lean(each), "place long, n long")
    found = {r.place: r.n for r in parts.groupBy("place").agg(F.sum("n").alias("n")).collect()}  # a row for each threshold
    every = np.array([found.get(k, 0) for k in range(sum(len(s) + 1 for s in steps))])
    return np.split(every, np.cumsum([len(s) + 1 for s in steps])[:-1])


def learn(docs: DataFrame, labels: DataFrame, fold: int = 5, held: int = 0, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """A model from the rows whose crc32(doc_id as text) mod fold is not `held`. Negative labels are not used; a document with several labels is trusted if all are 1."""
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % fold != held
    texts = docs.select("doc_id", "text").filter(learned)
    trusted = labels.filter(learned).groupBy("doc_id").agg(F.min("quality").alias("least")).filter("least = 1").select("doc_id")
    trusted = trusted.filter(chosen(trusted, positives))
    arrow_batches(docs.sparkSession)
    p, p_half = sampled(texts.join(F.broadcast(trusted), "doc_id", "left_semi"))  # at most about `positives` ids
    u, u_half = sampled(texts.filter(chosen(texts, unlabelled)))
    if not len(p) or not len(u):
        return None
    models = first_scorers(p, u, p_half, u_half)
    scores = [forward(m.weights, m.scaled(p[own] if own.any() else p))[0] for m, own in zip(models, (p_half, ~p_half))]
    steps = [upper_sets(z) for z in scores]
    counts = counts_above(texts, models, steps)
    priors = [class_prior(z, s, n[:-1] / n[-1], int(n[-1])) for z, s, n in zip(scores, steps, counts) if n[-1]]
    return fit(p, u, float(np.mean(priors)))


def scored(docs: DataFrame, model: Model | None, *keep: str, score: str = "score") -> DataFrame:
    """The score of each document's text, in a column of that name, beside the columns to keep."""
    schema = docs.select(*keep).schema.add(score, "double")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            scores = model.score(features(texts)) if model and batch.num_rows else np.full(batch.num_rows, 0.5)
            yield pa.record_batch([*(batch.column(i) for i in range(len(keep))), pa.array(scores.astype(np.float64))], names=[*keep, score])

    arrow_batches(docs.sparkSession)
    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(lean(each), schema)
