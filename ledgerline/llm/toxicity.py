"""Toxic passages: maximum-scoring segments of token log-odds.

1. Counts.  For every word, the documents that hold it are counted: all of them
   (the prior), the labelled toxic and the labelled clean ones; likewise for
   stems, a word's first ``STEM`` letters.  Words and stems fall into 2**18 hash
   buckets each, so the driver gets a bounded table at every size (``learn``).
2. Log-odds.  A stem's log-odds ratio between the classes has a Dirichlet prior in
   proportion to the corpus counts; a word's has one, too, and is drawn to its
   stem's value as far as its own counts leave it unsure.  Each is moved
   ``SHRINK`` standard deviations towards zero, so rare words weigh nothing.
   ``DRIFT`` is taken off every word: a text without evidence scores below zero.
   A toxic word within ``NEAR`` words of its last place is no new evidence.
3. Segments.  One linear scan finds all maximal scoring segments of a text:
   none can be lengthened or cut for a higher sum, and none overlap.
4. Calibration.  In clean text, segments of score s or more are taken to come at
   the rate ``k * words * exp(-lam * s)``: ``lam`` solves
   ``sum p(score) * exp(lam * score) = 1`` over the words of clean labelled
   documents that gave no counts, ``k`` is the rate of segments in them.  The rate
   is a segment's number of finds expected by chance (its E-value); segments up
   to ``SIGNIFICANT`` are the toxic passages.  The r best segments of a text
   together have a chance of at most ``E_r**r / r!``; the text's evidence is the
   largest minus log of that over r.  A logistic curve over evidence, fitted on
   the same held-back documents, gives the score.

Labels come only from ids whose CRC-32 (as text) is not a multiple of 5; of
those a quarter (by another hash) calibrates, the others count.  Per class at most
``SAMPLE`` ids are learned from, those of the lowest hash buckets, so labels can
be broadcast and no text is shuffled.  Labels, ids, languages and sources are no
inputs of a score.

Words are runs of letters of any script, lower-cased, cut every 32 letters.
A null or empty text has no words, no passages, and the score of no evidence.
An id labelled both ways counts as toxic; repeated rows count as often as they
come; rows without an id are scored but never learned from.  Without toxic or
without clean labels there is nothing to tell apart: every text gets the share
of toxic labels (0 without any), and no passages.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.quality import held_out
from ledgerline.session import materialize

BUCKETS = 1 << 18
STEM = 5
PRIOR_WORDS = 20_000.0     # weight of the corpus counts as a prior, in words
SPREAD = 1.0               # standard deviation of words' log-odds about their stem's
SHRINK = 2.0               # standard deviations that log-odds are moved towards zero
DRIFT = 0.5                # taken off every word's score
NEAR = 20
UNIT = 1000                # scores are whole thousandths
SIGNIFICANT = 0.01         # the most chance finds a passage may be expected to be
MOST_EVIDENCE = 200.0      # evidence beyond this counts as this in the logistic curve
THRESHOLD = 0.5
SAMPLE, PARTS = 200_000, 4096
WORD = re.compile(r"[^\W\d_]{1,32}")
CACHE = 1 << 19


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


class _Buckets(dict):
    """Word -> its bucket and its stem's in one number, remembered per task; emptied
    when it holds ``CACHE`` words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        low = word.lower()
        b = self[word] = _bucket(low) * BUCKETS + _bucket("^" + low[:STEM])
        return b


# ---------------------------------------------------------------- segments
def segments(scores: np.ndarray) -> list[tuple[int, int, int]]:
    """All maximal scoring segments ``(start, end, sum)``, end exclusive, in order.

    Each positive score comes as a candidate; a candidate is joined to the
    nearest earlier one that starts on a lower running sum, if it ends on a
    higher one, and again with what that makes.  Every candidate keeps a link to
    that earlier one, so the scan is linear.
    """
    total = np.cumsum(scores)
    places = np.flatnonzero(scores > 0)
    low, high = (total[places] - scores[places]).tolist(), total[places].tolist()
    start: list[int] = []
    end: list[int] = []
    lo: list[int] = []
    hi: list[int] = []
    lower: list[int] = []          # index of the nearest earlier candidate on a lower sum, or -1
    for p, a, b in zip(places.tolist(), low, high):
        s = p
        j = len(lo) - 1
        while True:
            while j >= 0 and lo[j] >= a:
                j = lower[j]
            if j < 0 or hi[j] >= b:
                break
            s, a = start[j], lo[j]                       # join: drop j and all after it
            del start[j:], end[j:], lo[j:], hi[j:], lower[j:]
            j -= 1
        start.append(s)
        end.append(p + 1)
        lo.append(a)
        hi.append(b)
        lower.append(j)
    return [(s, e, h - a) for s, e, a, h in zip(start, end, lo, hi)]


# ---------------------------------------------------------------- the model
@dataclass(frozen=True)
class Odds:
    """Log-odds ratios and their variances, per bucket."""
    word: np.ndarray
    word_var: np.ndarray
    stem: np.ndarray
    stem_var: np.ndarray

    def parts(self) -> tuple[list[float], ...]:
        """Per bucket the weight and weighted value of a word's own counts, and of its stem's."""
        own, drawn = 1 / self.word_var, 1 / (self.stem_var + SPREAD ** 2)
        return own.tolist(), (own * self.word).tolist(), drawn.tolist(), (drawn * self.stem).tolist()


NOTHING = round(-UNIT * DRIFT)         # the score of a word that is no evidence


class Scores(dict):
    """Word -> score, remembered per task like ``_Buckets``."""

    def __init__(self, odds: Odds | None) -> None:
        super().__init__()
        self.own, self.own_sum, self.drawn, self.drawn_sum = odds.parts() if odds else ([], [], [], [])

    def __missing__(self, word: str) -> int:
        """A word's whole score, where it is new evidence."""
        if len(self) >= CACHE:
            self.clear()
        low = word.lower()
        w, s = _bucket(low), _bucket("^" + low[:STEM])
        weight = self.own[w] + self.drawn[s]
        mean = (self.own_sum[w] + self.drawn_sum[s]) / weight
        sure = max(abs(mean) - SHRINK / weight ** 0.5, 0.0)
        score = self[word] = round(UNIT * ((sure if mean > 0 else -sure) - DRIFT))
        return score

    def of(self, text: str | None) -> np.ndarray:
        """The scores of a text's words: a toxic one within ``NEAR`` words of its last place is no new evidence."""
        words = WORD.findall(text) if text else []
        scores = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        last: dict[int, int] = {}
        for i in np.flatnonzero(scores > 0).tolist():
            bucket = _bucket(words[i].lower())
            if i - last.get(bucket, -NEAR - 1) <= NEAR:
                scores[i] = NOTHING
            last[bucket] = i
        return scores


def log_odds(prior: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds ratio and variance per bucket from counts over all, toxic and clean documents."""
    a = PRIOR_WORDS * (prior + 1.0) / (prior.sum() + len(prior))
    t, c = toxic + a, clean + a
    nt, nc = t.sum(), c.sum()
    return np.log(t / (nt - t)) - np.log(c / (nc - c)), 1 / t + 1 / c


@dataclass(frozen=True)
class Model:
    odds: Odds | None          # None: nothing was learned
    lam: float = 0.0           # per thousandth
    k: float = 1.0
    slope: float = 0.0
    offset: float = 0.0
    share: float = 0.0         # of toxic labels, where nothing was learned

    def found(self, text: str | None, known: Scores) -> tuple[float, list[tuple[int, int, float]]]:
        """A text's evidence and its significant segments, as ``(first word, end, E-value)``."""
        if self.odds is None:
            return 0.0, []
        scores = known.of(text)
        found = segments(scores)
        if not found:
            return 0.0, []
        log_e = np.log(self.k * len(scores)) - self.lam * np.array([s for _, _, s in found], dtype=float)
        r = np.arange(1, len(found) + 1)
        evidence = float(np.max(np.cumsum(np.log(r)) - r * np.sort(log_e)))
        limit = np.log(SIGNIFICANT)
        return max(evidence, 0.0), [(a, b, float(np.exp(e))) for (a, b, _), e in zip(found, log_e) if e <= limit]

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        if self.odds is None:
            return np.full(len(evidence), self.share)
        return 1 / (1 + np.exp(-(self.slope * np.minimum(evidence, MOST_EVIDENCE) + self.offset)))


def decay(values: np.ndarray, share: np.ndarray) -> float:
    """The positive root ``lam`` of ``sum share * exp(lam * values) = 1`` (mean below 0, some value above 0)."""
    top = values.max()
    log_sum = lambda lam: float(np.log(np.sum(share * np.exp(lam * (values - top)))) + lam * top)
    low, high = 0.0, 1.0 / UNIT
    while log_sum(high) <= 0:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if log_sum(mid) <= 0 else (low, mid)
    return (low + high) / 2


def logistic(evidence: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (0 or more) and offset by Newton steps, with a small pull of the slope to zero."""
    x = np.stack([evidence, np.ones(len(evidence))], axis=1)
    beta = np.zeros(2)
    pull = np.array([0.01, 0.001])
    for _ in range(100):
        p = 1 / (1 + np.exp(-(x @ beta)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (weight * (label - p)) - pull * beta)
        size = float(np.max(np.abs(step)))
        beta = beta + step * min(1.0, 4.0 / max(size, 1e-300))
        if size < 1e-10:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


# ---------------------------------------------------------------- Spark jobs
def _counts(rows: DataFrame, text_col: str, class_col: str | None = None) -> np.ndarray:
    """Documents per bucket: an array of classes (one, or 0 and 1) x (words, stems) x BUCKETS."""
    classes = 2 if class_col else 1
    chosen = rows.select(F.col(text_col).alias("text"), (F.col(class_col) if class_col else F.lit(0)).cast("int").alias("y"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, sums = _Buckets(), np.zeros((classes, 2, BUCKETS), dtype=np.int64)
        for rows in batches:
            for text, y in zip(rows["text"], rows["y"]):
                held = np.array([known[w] for w in set(WORD.findall(text))] if text else [], dtype=np.int64)
                sums[y, 0, np.unique(held // BUCKETS)] += 1
                sums[y, 1, np.unique(held % BUCKETS)] += 1
        flat = sums.reshape(-1)
        held = np.flatnonzero(flat)
        yield pd.DataFrame({"b": held, "n": flat[held]})

    out = np.zeros(classes * 2 * BUCKETS)
    sums = chosen.mapInPandas(count, "b long, n long").groupBy("b").agg(F.sum("n").alias("n")).toPandas()
    out[sums["b"].to_numpy(dtype=np.int64)] = sums["n"]
    return out.reshape(classes, 2, BUCKETS)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             most: int = SAMPLE) -> DataFrame:
    """``(text, y, calibrates)`` of the rows that are learned from."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
             .where(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y")))
    known = materialize(known.withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), F.lit(PARTS))), "labels")
    sizes = known.groupBy("y", "part").agg(F.count(F.lit(1)).alias("n")).orderBy("y", "part").collect()      # at most 2 * PARTS
    upto = {}
    for y in (0, 1):
        total = np.cumsum([r["n"] for r in sizes if r["y"] == y])
        parts = [r["part"] for r in sizes if r["y"] == y]
        upto[y] = PARTS if not len(total) or total[-1] <= most else parts[int(np.searchsorted(total, most, side="right"))]
    known = known.where(F.col("part") < F.when(F.col("y") == 0, upto[0]).otherwise(upto[1])).select("id", "y")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(known), "id").select("text", "y", (F.pmod(F.xxhash64("id"), F.lit(4)) == 0).alias("calibrates"))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Log-odds and calibration from the labelled documents that are not held out."""
    rows = labelled(docs, labels, id_col, text_col, label_col)
    clean, toxic = _counts(rows.where(~F.col("calibrates")), "text", "y")
    share = float(rows.agg(F.avg("y")).first()[0] or 0.0)
    if not toxic.sum() or not clean.sum():
        return Model(None, share=share)
    prior = _counts(docs, text_col)[0]
    odds = Odds(*log_odds(prior[0], toxic[0], clean[0]), *log_odds(prior[1], toxic[1], clean[1]))
    held_back = rows.where("calibrates")

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Words per score, and segments as the null score."""
        known, words, n = Scores(odds), {}, 0
        for batch in batches:
            for text in batch["text"]:
                scores = known.of(text)
                n += len(segments(scores))
                for s, m in zip(*np.unique(scores, return_counts=True)):
                    words[int(s)] = words.get(int(s), 0) + int(m)
        yield pd.DataFrame({"score": pd.array([*words, None], dtype="Int64"), "n": [*words.values(), n]})

    cells = {s: n for s, n in held_back.where("y = 0").select("text").mapInPandas(scored, "score long, n long")
             .groupBy("score").agg(F.sum("n").alias("n")).collect()}
    n = cells.pop(None, 0)
    # one word more of the highest score, so that a small clean part has a root
    top = int(UNIT * 10)
    cells[top] = cells.get(top, 0) + 1
    values, counts = (np.array(v, dtype=float) for v in zip(*sorted(cells.items())))
    p = counts / counts.sum()
    if p @ values >= 0:
        return Model(None, share=share)
    model = Model(odds, decay(values, p), (n + 1) / counts.sum())

    @F.pandas_udf("double")
    def evidence(texts: pd.Series) -> pd.Series:
        known = Scores(odds)
        return pd.Series([model.found(t, known)[0] for t in texts], dtype="float64")

    # evidence in steps of 1/8, so the fit gets a bounded table of counts
    step = F.rint(F.least(evidence("text"), F.lit(MOST_EVIDENCE)) * 8).alias("x")
    table = held_back.select("y", step).groupBy("y", "x").agg(F.count(F.lit(1)).alias("n")).orderBy("y", "x").collect()
    y, x, n = (np.array([r[i] for r in table], dtype=float) for i in range(3))
    slope, offset = logistic(x / 8, y, n) if len(set(y)) == 2 else (1.0, float(np.log(SIGNIFICANT)))
    return Model(odds, model.lam, model.k, slope, offset)


def find_passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, score, predicted, evidence, passages)`` for every row.

    ``passages`` lists the significant segments as ``(start, end, e_value)`` in
    code points of the text, end exclusive, in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, evidence double, passages array<struct<start:int,end:int,e_value:double>>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        known = Scores(model.odds)
        for texts in batches:
            evidence, passages = np.zeros(len(texts)), []
            for i, text in enumerate(texts):
                evidence[i], found = model.found(text, known)
                at = [m.span() for m in WORD.finditer(text)] if found else []
                passages.append([{"start": at[a][0], "end": at[b - 1][1], "e_value": e} for a, b, e in found])
            yield pd.DataFrame({"score": model.probability(evidence), "evidence": evidence, "passages": passages})

    rows = docs.select(F.col(id_col).alias("id"), judge(F.col(text_col)).alias("j"))
    return rows.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "j.score",
                       (F.col("j.score") >= THRESHOLD).cast("int").alias("predicted"), "j.evidence", "j.passages")
