"""Quality scores learned from positive and unlabelled texts.

Trusted positives and unlabelled web text are all that training sees: no text is ever taken as a
negative. A small network over measurements of the whole text minimises the non-negative unbiased
risk: with class prior p, the risk of negatives is that of the unlabelled less p times that of the
positives taken as negatives, and where a batch drives that below zero, the step goes back. The prior
is estimated beforehand from a first classifier, positives against unlabelled: its top scores hold
almost positives alone, so the ratio of unlabelled to positives there bounds the prior, least where
the estimate is safest.

Measurements are made once for all documents and written; sampling, training and scoring read these
few numbers.

The sample is drawn by a hash of id and text, rows equal in both once, the least hashes first: it holds
MOST_POSITIVES and MOST_UNLABELLED rows at most, fewer only where there are no more, and is the same
however rows are dealt.

Cases: a null or empty text is measured as no words and scored; labels that are null or that differ
for one id are no trusted positives; without a trusted positive every score is 0.5; an empty table
gives an empty result; repeated rows are scored each; columns other than id and text, and of labels
id and quality, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_texts, small_batches, strings, written

#: Bounds of the training sample: trusted positives, and unlabelled texts.
MOST_POSITIVES, MOST_UNLABELLED = 20_000, 40_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 40, 512, 0.01, 1e-4
#: A score from which a text counts as good, and the share of ids that training never sees.
THRESHOLD, FOLDS = 0.3, 5
SYMBOLS, ENDS = b"#*$%&|<>", b".!?:;,\"')"
N_FEATURES = 20


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[ord("a") : ord("z") + 1] = 1
    kind[ord("A") : ord("Z") + 1] = 2
    kind[ord("0") : ord("9") + 1] = 3
    kind[[32, 9, 11, 12, 13]] = 4
    kind[10] = 5
    kind[list(SYMBOLS)] = 6
    kind[list(b".,")] = 7
    kind[list(b"!?")] = 8
    kind[128:] = 9
    return kind


KINDS = _kinds()


def measure(text: str) -> np.ndarray:
    """N_FEATURES numbers of the whole text."""
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    count = np.bincount(KINDS[raw], minlength=10) if len(raw) else np.zeros(10)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    n, m, size = max(len(words), 1), max(len(lines), 1), max(len(raw), 1)
    marked = [len(x) - len(x.translate(None, SYMBOLS)) for x in lines]
    sizes = [x.count(b" ") + 1 for x in lines]
    rate = [a / b for a, b in zip(marked, sizes, strict=True)]
    loud = [sum(map(x.count, (b"!", b"?"))) / b for x, b in zip(lines, sizes, strict=True)]
    shout = [x.isupper() * b for x, b in zip(lines, sizes, strict=True)]
    echoes = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return np.array([
        np.log1p(len(words)), np.log1p(len(lines)), len(raw) / n / 10, len(set(words)) / n,
        echoes / n, 1 - len(set(lines)) / m, np.log1p(n / m),
        count[2] / size, count[3] / size, count[4] / size, count[6] / n, count[7] / n, count[8] / n, count[9] / size,
        max(rate, default=0), float(np.mean(rate)) if rate else 0, max(loud, default=0), sum(shout) / n,
        sum(b for a, b in zip(rate, sizes, strict=True) if a > 0.3) / n, sum(x.rstrip()[-1:] in ENDS for x in map(bytes, lines)) / m,
    ], np.float32)


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, x): a hash of id and text, and the measurements, of every row."""

    def start():
        def work(batch):
            x = np.stack([measure(t) for t in strings(batch.column(2))])
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=["doc_id", "h", "x"])

        return work

    return map_texts(_hashed(df, id_col, text_col), start, "doc_id long, h long, x array<float>")


def _hashed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, text)"""
    doc, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return df.select(doc.alias("doc_id"), F.xxhash64(doc, text, F.lit("sample")).alias("h"), text.alias("text"))


def held_out(doc_id: Column) -> Column:
    """Ids whose labels and texts training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass
class Network:
    """Standardised inputs, a hidden layer of tanh, a logit."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    @classmethod
    def fresh(cls, x: np.ndarray, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        d = x.shape[1]
        return cls(x.mean(0), x.std(0) + 1e-6, [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)])

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(z @ self.weights[0] + self.weights[1])
        return z, h, h @ self.weights[2] + self.weights[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.forward(x)[2])

    def backward(self, z: np.ndarray, h: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        """Gradients where slope is the loss's by each logit."""
        back = slope[:, None] * self.weights[2] * (1 - h * h)
        return [z.T @ back, back.sum(0), h.T @ slope, slope.sum(keepdims=True)]


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """The network of least non-negative risk; prior None: positives against unlabelled, plainly."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(np.concatenate([positive, unlabelled]), seed)
    first, second = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    steps = max(1, -(-len(unlabelled) // BATCH))
    p, t = prior if prior is not None else 0.5, 0
    for _ in range(epochs):
        a, b = np.array_split(rng.permutation(len(positive)), steps), np.array_split(rng.permutation(len(unlabelled)), steps)
        for i, j in zip(a, b, strict=True):
            if not len(j):
                continue
            i = i if len(i) else rng.integers(0, len(positive), 1)
            x = np.concatenate([positive[i], unlabelled[j]])
            z, h, logit = net.forward(x)
            up, un = _sigmoid(logit[: len(i)]), _sigmoid(logit[len(i) :])
            slope = np.zeros(len(x))
            if prior is None:
                slope[: len(i)], slope[len(i) :] = 0.5 * (up - 1) / len(i), 0.5 * un / len(j)
            else:
                negative = np.logaddexp(0, logit[len(i) :]).mean() - p * np.logaddexp(0, logit[: len(i)]).mean()
                if negative >= 0:
                    slope[: len(i)], slope[len(i) :] = (p * (up - 1) - p * up) / len(i), un / len(j)
                else:  # the unbiased part has gone below zero: step back up
                    slope[: len(i)], slope[len(i) :] = p * up / len(i), -un / len(j)
            t += 1
            for k, g in enumerate(net.backward(z, h, slope)):
                g = g + DECAY * net.weights[k] * (k % 2 == 0)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.weights[k] -= RATE * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return net


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 3) -> float:
    """Share of positives in the unlabelled, by the safest bin of top scores on the unseen half."""
    rng = np.random.default_rng(seed)
    a, b = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
    if len(a) < 8 or len(b) < 8:
        return 0.5
    net = train(positive[a[::2]], unlabelled[b[::2]], None, epochs=10, seed=seed)
    sp, su = np.sort(net.score(positive[a[1::2]])), np.sort(net.score(unlabelled[b[1::2]]))
    cuts = np.unique(np.concatenate([sp, su]))
    qp = 1 - np.searchsorted(sp, cuts) / len(sp)
    qu = 1 - np.searchsorted(su, cuts) / len(su)
    slack = lambda n: np.sqrt(np.log(4 / 0.1) / (2 * n))
    safe = qp > 0.05
    bound = (qu[safe] + slack(len(su))) / qp[safe] + slack(len(sp)) * qu[safe] / qp[safe]
    best = int(np.argmin(bound))
    return float(np.clip(qu[safe][best] / qp[safe][best], 0.02, 0.98))


def _sampled(rows: DataFrame, most: int) -> DataFrame:
    """The rows with the `most` least hashes: a number reaches the driver, no row."""
    least = rows.select("h").distinct().orderBy("h").limit(most).agg(F.max("h").alias("h")).first().h
    return rows.where(F.col("h") <= F.lit(least).cast("long"))


def _matrix(rows: DataFrame, most: int) -> np.ndarray:
    """Measurements of the sample, equal rows once: `most` at most."""
    own = (rows if "x" in rows.columns else measured_rows(rows)).groupBy("h").agg(F.min("x").alias("x"))
    x = np.array([r.x for r in own.orderBy("h").limit(most).collect()], np.float64)
    return x.reshape(-1, N_FEATURES)


def measured_rows(rows: DataFrame) -> DataFrame:
    """(h, x) of rows (doc_id, h, text)."""

    def start():
        def work(batch):
            x = np.stack([measure(t) for t in strings(batch.column(1))])
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=["h", "x"])

        return work

    return map_texts(rows.select("h", "text"), start, "h long, x array<float>")


def _learn(positive: np.ndarray, unlabelled: np.ndarray) -> Network | None:
    if not len(positive) or not len(unlabelled):
        return None
    return train(positive, unlabelled, class_prior(positive, unlabelled))


def fit(rows: DataFrame, labels: DataFrame, most_positives: int = MOST_POSITIVES, most_unlabelled: int = MOST_UNLABELLED) -> Network | None:
    """The model of labels (doc_id, quality) and rows with doc_id, h and either x, measured already, or
    text, of which then only the sampled rows are measured. None without a trusted positive.
    """
    seen = rows.where(~held_out(F.col("doc_id")))
    named = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
    # Bounded by the parameter, so broadcast: no text moves for it, however many documents there are.
    trusted = named.where("lo = 1 AND hi = 1").orderBy(F.xxhash64(F.col("doc_id"), F.lit("sample")), "doc_id").limit(most_positives).select("doc_id")
    good = seen.join(F.broadcast(trusted), "doc_id", "left_semi")
    return _learn(_matrix(_sampled(good, most_positives), most_positives), _matrix(_sampled(seen, most_unlabelled), most_unlabelled))


def score(features: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of written measurements."""

    def run(batches):
        for b in batches:
            x = np.array(b.column("x").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, N_FEATURES)
            s = net.score(x) if net else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=["doc_id", "score"])

    out = features.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures df, learns from labels (doc_id, quality) and scores every row."""
    features = written(measured(df, id_col, text_col))
    return score(features, fit(features, labels))


def accepted(df: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of df (doc_id, text, any others) that the model predicts to be good, as they are."""
    small_batches(df.sparkSession)
    net = fit(_hashed(df, "doc_id", text_col), labels)
    at = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for b in cut(batch):
                x = np.stack([measure(t) for t in strings(b.column(at))]).astype(np.float64)
                yield b.filter(pa.array((net.score(x) if net else np.full(len(x), 0.5)) >= THRESHOLD))

    return df.mapInArrow(run, df.schema)
