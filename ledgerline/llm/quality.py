"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded and cut into chunks that overlap by one
filter width less a byte, so that every window of ``WIDTH`` bytes lies in a
chunk and the whole document is covered.  The learned filters slide over each
chunk, a ReLU follows, each filter's maximum over the chunk is its feature, and
the document's features are the means over its chunks of these maxima (weighted
by the windows a chunk holds) and their largest value; one logistic unit
combines them into a probability.

Training is plain gradient descent (Adam) with derivatives written out, in
numpy on the driver, on at most ``SAMPLE`` labelled documents of each label, of
at most ``SAMPLE_BYTES`` bytes each (those of the smallest id hashes).  Scoring runs in a pandas UDF over whole texts,
chunk by chunk, with the network's few thousand numbers in the closure.

A text shorter than one window is padded with zero bytes; null counts as
empty.  With no labelled rows, or rows of one label only, every score is the
share of label 1 (0.5 with none).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMBEDDING, WIDTH, FILTERS, CHUNK = 8, 6, 16, 512
SAMPLE, SAMPLE_BYTES = {0: 600, 1: 1400}, 20_000
EPOCHS, BATCH, RATE, DECAY = 6, 32, 0.01, 1e-4
THRESHOLD = 0.3
_STEP = CHUNK - WIDTH + 1


def _chunks(data: bytes) -> Iterator[np.ndarray]:
    """The overlapping chunks of a text; all but the last are ``CHUNK`` bytes."""
    b = np.frombuffer(data.ljust(WIDTH, b"\0"), dtype=np.uint8)
    for at in range(0, max(1, len(b) - WIDTH + 1), _STEP):
        yield b[at:at + CHUNK]


@dataclass
class Network:
    """The weights: byte embedding, filters with biases, and the logistic unit."""
    embed: np.ndarray      # 256 x EMBEDDING
    filters: np.ndarray    # WIDTH x EMBEDDING x FILTERS
    bias: np.ndarray       # FILTERS
    out: np.ndarray        # 2 * FILTERS
    prior: np.ndarray      # 1

    @classmethod
    def start(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        f = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
        return cls(f(256, EMBEDDING, scale=0.5), f(WIDTH, EMBEDDING, FILTERS, scale=(2 / (WIDTH * EMBEDDING)) ** 0.5),
                   np.zeros(FILTERS, np.float32), f(2 * FILTERS, scale=0.1), np.zeros(1, np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.prior]

    def maxima(self, data: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """Per chunk: the filters' maxima, where they are, the chunks, and the windows in each."""
        chunks = list(_chunks(data))
        tops, places = np.empty((len(chunks), FILTERS), np.float32), np.empty((len(chunks), FILTERS), np.int64)
        for i, chunk in enumerate(chunks):
            e, n = self.embed[chunk], len(chunk) - WIDTH + 1
            z = e[:n] @ self.filters[0]
            for k in range(1, WIDTH):
                z += e[k:k + n] @ self.filters[k]
            places[i] = z.argmax(axis=0)
            tops[i] = z[places[i], np.arange(FILTERS)]
        windows = np.array([len(c) - WIDTH + 1 for c in chunks], dtype=np.float32)
        return np.maximum(tops + self.bias, 0), places, chunks, windows / windows.sum()

    def logit(self, data: bytes) -> float:
        """Chunk by chunk: a text's memory is that of one chunk's features."""
        total, largest, windows = np.zeros(FILTERS, np.float64), np.zeros(FILTERS, np.float32), 0
        for chunk in _chunks(data):
            e, n = self.embed[chunk], len(chunk) - WIDTH + 1
            z = e[:n] @ self.filters[0]
            for k in range(1, WIDTH):
                z += e[k:k + n] @ self.filters[k]
            top = np.maximum(z.max(axis=0) + self.bias, 0)
            total += top * n
            windows += n
            np.maximum(largest, top, out=largest)
        return float((total / windows) @ self.out[:FILTERS] + largest @ self.out[FILTERS:] + self.prior[0])

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit((text or "").encode("utf-8", "surrogatepass")), -50, 50))))

    def gradients(self, data: bytes, label: int) -> list[np.ndarray]:
        """Derivatives of the log loss of one document."""
        tops, places, chunks, share = self.maxima(data)
        best = tops.argmax(axis=0)
        mean, largest = share @ tops, tops[best, np.arange(FILTERS)]
        logit = mean @ self.out[:FILTERS] + largest @ self.out[FILTERS:] + self.prior[0]
        d = np.float32(1 / (1 + np.exp(-np.clip(logit, -50, 50))) - label)
        g = [np.zeros_like(w) for w in self.weights()]
        g[3][:FILTERS], g[3][FILTERS:], g[4][0] = d * mean, d * largest, d
        back = share[:, None] * (d * self.out[:FILTERS])[None, :]
        back[best, np.arange(FILTERS)] += d * self.out[FILTERS:]
        back[tops <= 0] = 0
        g[2][:] = back.sum(axis=0)
        for i, chunk in enumerate(chunks):
            for k in range(WIDTH):
                b = chunk[places[i] + k]                             # the byte under each filter
                g[1][k] += self.embed[b].T * back[i]
                np.add.at(g[0], b, (self.filters[k] * back[i]).T)
        return g


def fit(texts: list[bytes], labels: list[int], seed: int = 7) -> Network:
    """A network for the given documents; the same input gives the same one."""
    net, rng, n = Network.start(seed), np.random.default_rng(seed), len(texts)
    ones = sum(labels)
    if not 0 < ones < n:
        share = (ones + 1) / (n + 2)
        net.out[:], net.prior[:] = 0, np.log(share / (1 - share))
        return net
    m, v = ([np.zeros_like(w) for w in net.weights()] for _ in range(2))
    t, steps = 0, EPOCHS * -(-n // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            batch = order[at:at + BATCH]
            total = [np.zeros_like(w) for w in net.weights()]
            for i in batch:
                for a, b in zip(total, net.gradients(texts[i], labels[i])):
                    a += b
            t += 1
            rate = RATE * (1 - (t - 1) / steps)
            for w, g, a, b in zip(net.weights(), total, m, v):
                g = g / len(batch) + DECAY * w
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
    return net


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", sample: Mapping[int, int] | None = None, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """``(id, text, label, h)``: per label the ``sample`` labelled documents of the
    smallest id hashes, those over ``most_bytes`` left out.  Labels come only
    from rows whose id is not held out (``held_out``)."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where(
        "id is not null and label in (0, 1)").where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sizes = texts.select("id", F.octet_length("text").alias("n")).groupBy("id").agg(F.max("n").alias("n")).where(F.col("n") <= most_bytes)
    rows = known.join(sizes, "id").select("id", "label", F.md5(F.col("id").cast("string")).alias("h"))
    picked = [rows.where(F.col("label") == y).orderBy("h").limit(most) for y, most in (sample or SAMPLE).items()]
    ids = picked[0].unionByName(picked[1]).select("id", "label", "h")
    return texts.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label"), F.first("h").alias("h"))


def held_out(doc_id: Column) -> Column:
    """True for the ids that never train: CRC-32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, **columns: str) -> Network:
    """A network from the labelled documents; a bounded sample goes to the driver."""
    rows = sorted(training_rows(docs, labels, **columns).select("h", "text", "label").collect())
    return fit([r["text"].encode("utf-8", "surrogatepass") for r in rows], [r["label"] for r in rows])


def score_column(text: Column, net: Network) -> Column:
    """The network's probabilities for a text column."""
    @F.pandas_udf("double")
    def quality(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([net.score(t) for t in texts], dtype="float64")
    return quality(text)


def classify(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, score, predicted)`` for every row; a null id is not held out."""
    rows = docs.select(F.col(id_col).alias("id"), score_column(F.col(text_col), net).alias("score"))
    return rows.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
