"""Document quality from lines: a linear-chain conditional random field.

Every line that is not blank is good or bad. Its features are measures of the
line and of the lines before and after it; the chain adds weights for the four
transitions. Learning takes the quality of a labelled document as that of all
its lines and maximises the likelihood with L2 regularisation, by L-BFGS; every
evaluation is one Spark pass over the sample's feature table in which each task
sums its gradient. A document's score is the mean of its lines' forward-backward
marginals of good, weighted by their lengths.

The training sample is about `SAMPLE_DOCS` documents of each label, chosen by
hash and weighed back to the true shares of the labels; this is the bound on
what the classifier is fitted to.

Defined cases: texts of any length are read whole, all lines of one text at
once; a null text, or one of blank lines only, has the labelled share
of good documents as its score; without labels every score is 0.5; a null
doc_id is neither learned from nor held out; null qualities are ignored, and a
document with contradicting labels counts as bad; repeated rows give a row
each. Other columns are ignored; labels, lang, source and doc_id are never
inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrain.llm.common import WordCodes, column, encoded, rows_kernel, slices
from fleetgrain.session import cut_lineage

SAMPLE_DOCS = 1500
EVALUATIONS = 40
RIDGE = 1e-3
GOOD_FROM = 0.7

# Classes of a UTF-8 byte.
_UPPER, _LOWER, _DIGIT, _SYMBOL, _BANG, _STOP, _SIGN, _REST, _SPACE, _BREAK = range(10)
_CLASS = np.full(256, _REST, np.uint8)
_CLASS[0x80:0xC0] = _SPACE + 2  # continues a character, counted with its first byte
_CLASS[0xC0:] = _LOWER
for _chars, _kind in (
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER),
    (b"abcdefghijklmnopqrstuvwxyz", _LOWER),
    (b"0123456789", _DIGIT),
    (b"#*$%&|<>", _SYMBOL),
    (b"!", _BANG),
    (b".?:;", _STOP),
    (b"\"'(),-/", _SIGN),
    (b" \t\r\x0b\x0c", _SPACE),
    (b"\n", _BREAK),
):
    _CLASS[list(_chars)] = _kind
_KINDS = 12

OWN = ("capitals", "symbols", "bangs", "digits", "stutter", "seen", "few_words", "word_size", "stops", "opens")
BESIDE = OWN[:6]
N_FEATURES = 1 + len(OWN) + 2 * (len(BESIDE) + 1)
N_WEIGHTS = N_FEATURES + 4


def line_features(raw_texts: list[bytes | None], words: WordCodes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines that are not blank, their lengths, and each text's number of them."""
    raw_texts = [raw or b"" for raw in raw_texts]
    # one break ends every text, so lines never run across texts
    data = np.frombuffer(b"\n".join([*raw_texts, b""]), np.uint8)
    kinds = _CLASS[data]
    breaks = np.flatnonzero(kinds == _BREAK)
    starts = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else np.zeros(0, np.int64)
    line = np.repeat(np.arange(len(breaks)), breaks - starts + 1)
    counts = np.bincount(line * _KINDS + kinds, minlength=len(breaks) * _KINDS).reshape(-1, _KINDS)
    blank = (kinds == _SPACE) | (kinds == _BREAK)
    begins = ~blank & np.concatenate([[True], blank[:-1]])
    n_words = np.bincount(line[begins], minlength=len(breaks))
    solid = counts[:, : _SPACE].sum(axis=1)

    ends = np.cumsum([len(raw) + 1 for raw in raw_texts])
    doc = np.searchsorted(ends, breaks + 1)
    kept = n_words > 0

    of_word = np.repeat(np.arange(len(breaks)), n_words)
    same = (words.codes[1:] == words.codes[:-1]) & (of_word[1:] == of_word[:-1])
    stutter = np.bincount(of_word[1:][same], minlength=len(breaks))

    seen = np.zeros(len(breaks))
    before: set[bytes] = set()
    last_doc, raw = -1, data.tobytes()
    for i in np.flatnonzero(kept).tolist():
        if doc[i] != last_doc:
            before, last_doc = set(), doc[i]
        text = raw[starts[i] : breaks[i]]
        seen[i] = text in before
        before.add(text)

    final = data[np.maximum(breaks - 1, 0)]
    letters = np.maximum(counts[:, _UPPER] + counts[:, _LOWER], 1)
    per_word = np.maximum(n_words, 1)
    own = np.stack(
        [
            counts[:, _UPPER] / letters,
            np.minimum(1, 4 * counts[:, _SYMBOL] / np.maximum(solid, 1)),
            np.minimum(1, counts[:, _BANG] / per_word),
            counts[:, _DIGIT] / np.maximum(solid, 1),
            stutter / per_word,
            seen,
            n_words < 4,
            np.minimum(1, solid / per_word / 20),
            np.isin(final, np.frombuffer(b".?!:;", np.uint8)),
            _CLASS[data[np.minimum(starts, max(len(data) - 1, 0))]] == _UPPER,
        ],
        axis=1,
    ).astype(float)[kept] if len(breaks) else np.zeros((0, len(OWN)))
    doc = doc[kept]
    beside = own[:, : len(BESIDE)]
    first = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
    last = np.concatenate([doc[1:] != doc[:-1], [True]]) if len(doc) else np.zeros(0, bool)
    above = np.where(first[:, None], 0.0, np.roll(beside, 1, axis=0))
    below = np.where(last[:, None], 0.0, np.roll(beside, -1, axis=0))
    x = np.concatenate([np.ones((len(own), 1)), own, above, first[:, None], below, last[:, None]], axis=1)
    return x, solid[kept], np.bincount(doc, minlength=len(raw_texts))


@dataclass
class Chains:
    """Chains of different lengths, stepped through together: longer chains first, so active ones lead."""

    sizes: np.ndarray

    def __post_init__(self):
        self.order = np.argsort(-self.sizes, kind="stable")
        self.begin = (np.cumsum(self.sizes) - self.sizes)[self.order]
        ranked = self.sizes[self.order]
        self.active = [int(np.searchsorted(-ranked, -t, "left")) for t in range(int(ranked.max(initial=0)))]

    def marginals(self, u: np.ndarray, transitions: np.ndarray):
        """Marginals of good by line, expected transitions by chain, and log partition by chain."""
        move = np.exp(transitions - transitions.max())
        good = 1 / (1 + np.exp(-u))
        emit = np.stack([1 - good, good], axis=1)
        n = len(self.sizes)
        alpha, norms, beta = np.zeros_like(emit), np.ones(len(u)), np.ones_like(emit)
        for t, k in enumerate(self.active):
            at = self.begin[:k] + t
            a = emit[at] * (alpha[at - 1] @ move if t else 1.0)
            norms[at] = a.sum(axis=1)
            alpha[at] = a / norms[at][:, None]
        pairs = np.zeros((n, 2, 2))
        for t in range(len(self.active) - 1, 0, -1):
            k = self.active[t]
            at = self.begin[:k] + t
            ahead = emit[at] * beta[at] / norms[at][:, None]
            pairs[self.order[:k]] += alpha[at - 1][:, :, None] * move * ahead[:, None, :]
            beta[at - 1] = ahead @ move.T
        chain = np.repeat(np.arange(n), self.sizes)
        logs = np.log(norms) + np.logaddexp(0, u)
        log_z = np.bincount(chain, logs, n) + np.maximum(self.sizes - 1, 0) * transitions.max()
        return alpha[:, 1] * beta[:, 1], pairs, log_z


def loss_and_gradient(weights, x, sizes, good, weight):
    """Weighted negative log likelihood of chains whose lines are all good or all bad."""
    w, transitions = weights[:N_FEATURES], weights[N_FEATURES:].reshape(2, 2)
    u = np.clip(x @ w, -30, 30)
    p, pairs, log_z = Chains(sizes).marginals(u, transitions)
    chain = np.repeat(np.arange(len(sizes)), sizes)
    moves = np.maximum(sizes - 1, 0)
    path = good * (np.bincount(chain, u, len(sizes)) + moves * transitions[1, 1]) + (1 - good) * moves * transitions[0, 0]
    gradient = np.zeros(N_WEIGHTS)
    gradient[:N_FEATURES] = x.T @ ((p - good[chain]) * weight[chain])
    expected = (pairs * weight[:, None, None]).sum(axis=0)
    expected[1, 1] -= (weight * good * moves).sum()
    expected[0, 0] -= (weight * (1 - good) * moves).sum()
    gradient[N_FEATURES:] = expected.ravel()
    return float((weight * (log_z - path)).sum()), gradient


def minimise(function, start: np.ndarray, evaluations: int = EVALUATIONS, memory: int = 8) -> np.ndarray:
    """L-BFGS with step halving."""
    x, (f, g) = start, function(start)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    used = 1
    while used < evaluations and np.abs(g).max() > 1e-4:
        d, kept = g.copy(), []
        for s, y in reversed(steps):
            a = s @ d / (s @ y)
            kept.append(a)
            d -= a * y
        if steps:
            s, y = steps[-1]
            d *= s @ y / (y @ y)
        else:
            d /= max(1.0, np.abs(g).sum())
        for (s, y), a in zip(steps, reversed(kept), strict=True):
            d += s * (a - y @ d / (s @ y))
        rate = 1.0
        while used < evaluations:
            new = x - rate * d
            f_new, g_new = function(new)
            used += 1
            if f_new <= f - 1e-4 * rate * (g @ d):
                break
            rate /= 2
        else:
            break
        if (new - x) @ (g_new - g) > 1e-12:
            steps = [*steps[-(memory - 1) :], (new - x, g_new - g)]
        x, f, g = new, f_new, g_new
    return x


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[np.ndarray | None, float]:
    """Weights, and the share of good documents among the labelled ones that may be learned from."""
    spark = docs.sparkSession
    marks = cut_lineage(
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg((F.min("quality") > 0).cast("int").alias("good"))
    )
    held = {r["good"]: r["n"] for r in marks.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(held.values())
    if not total:
        return None, 0.5
    share = {k: min(1.0, sample_docs / n) for k, n in held.items()}
    limit = F.when(F.col("good") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))
    # about 2 * sample_docs rows
    chosen = marks.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1e6 < limit)
    chosen = chosen.withColumn("weight", 1 / limit / total)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(chosen), "id")
    schema = pa.schema([("good", pa.int32()), ("weight", pa.float64()), ("lines", pa.int64()), ("x", pa.list_(pa.float64()))])

    def features(batch):
        x, _, sizes = line_features(encoded(batch, "text"), WordCodes(batch.column(batch.schema.get_field_index("text"))))
        parts = np.split(x, np.cumsum(sizes)[:-1])
        made = {"lines": sizes.tolist(), "x": [p.ravel().tolist() for p in parts]}
        return made | {"good": column(batch, "good"), "weight": column(batch, "weight")}

    table = texts.select("text", "good", "weight").mapInArrow(
        rows_kernel(features, schema), "good int, weight double, lines long, x array<double>"
    )
    # few rows; spread over the cores as one row is many lines
    table = cut_lineage(table.where("lines > 0").repartition(spark.sparkContext.defaultParallelism))

    def evaluate(weights):
        def sums(batches):
            total = np.zeros(N_WEIGHTS + 1)
            for batch in batches:
                if batch.num_rows:
                    good, weight, sizes = (batch.column(i).to_numpy().astype(float) for i in range(3))
                    x = batch.column(3).flatten().to_numpy().reshape(-1, N_FEATURES)
                    loss, gradient = loss_and_gradient(weights, x, sizes.astype(np.int64), good, weight)
                    total += np.concatenate([[loss], gradient])
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

        rows = table.mapInArrow(sums, "sums array<double>").toArrow().column(0).to_pylist()  # a row per task
        found = np.sum(sorted(rows), axis=0) if rows else np.zeros(N_WEIGHTS + 1)
        return found[0] + RIDGE * weights @ weights, found[1:] + 2 * RIDGE * weights

    return minimise(evaluate, np.zeros(N_WEIGHTS)), held.get(1, 0) / total


RESULT = "doc_id long, held_out boolean, score double, predicted int, n_lines long"


def score(docs: DataFrame, weights: np.ndarray | None, prior: float) -> DataFrame:
    """doc_id, held_out, score, predicted, n_lines of every document."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("n_lines", pa.int64())]
    )

    def batch_columns(batch):
        texts = encoded(batch, "text")
        x, lengths, sizes = line_features(texts, WordCodes(batch.column(batch.schema.get_field_index("text"))))
        chain = np.repeat(np.arange(len(sizes)), sizes)
        scores = np.full(len(texts), prior)
        if weights is not None and len(x):
            u = np.clip(x @ weights[:N_FEATURES], -30, 30)
            p = Chains(sizes).marginals(u, weights[N_FEATURES:].reshape(2, 2))[0]
            total = np.bincount(chain, lengths, len(sizes))
            mean = np.bincount(chain, p * lengths, len(sizes)) / np.maximum(total, 1)
            scores = np.where(sizes > 0, np.clip(mean, 0.0, 1.0), prior)
        return {
            "doc_id": column(batch, "doc_id"),
            "held_out": column(batch, "held_out"),
            "score": scores.tolist(),
            "predicted": (scores >= GOOD_FROM).astype(int).tolist(),
            "n_lines": sizes.tolist(),
        }

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = chosen.withColumn("held_out", held_out(F.col("doc_id")))
    return chosen.mapInArrow(rows_kernel(batch_columns, schema), RESULT)
