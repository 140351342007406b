import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.llm import queries
from ledgerline.llm import toxicity as T


def all_maximal(scores):
    """By definition: the highest sum (the shortest, then first, of equal ones), then left and right of it."""
    out = []

    def part(a, b):
        best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] > 0:
            i, j = -best[2], -best[2] - best[1]
            part(a, i)
            out.append((i, j, best[0]))
            part(j, b)
    part(0, len(scores))
    return sorted(out)


def test_segments_are_the_maximal_ones():
    rng = random.Random(3)
    for _ in range(400):
        scores = [rng.choice([-5, -3, -2, -1, -1, 1, 2, 4, 7]) + rng.random() / 1000 for _ in range(rng.randrange(0, 22))]
        found = T.segments(np.array(scores))
        assert [f[:2] for f in found] == [e[:2] for e in all_maximal(scores)]
        assert [f[2] for f in found] == pytest.approx([e[2] for e in all_maximal(scores)])
    assert T.segments(np.array([], dtype=np.int64)) == []
    assert T.segments(np.array([1, 1, -1, 3])) == [(0, 4, 4)]


def test_long_alternating_scores_are_linear():
    found = T.segments(np.tile(np.array([3, -4]), 500_000))
    assert len(found) == 500_000 and found[0] == (0, 1, 3)


def test_decay_solves_its_equation():
    values, share = np.array([-500.0, 2000.0, 5000.0]), np.array([0.98, 0.015, 0.005])
    lam = T.decay(values, share)
    assert lam > 0 and np.sum(share * np.exp(lam * values)) == pytest.approx(1)


def test_log_odds_match_the_formula():
    prior, toxic, clean = (np.zeros(T.BUCKETS) for _ in range(3))
    prior[:3], toxic[:3], clean[:3] = (10, 1000, 5), (9, 50, 0), (0, 900, 1)
    ratio, variance = T.log_odds(prior, toxic, clean)
    a = T.PRIOR_WORDS * 11 / (1015 + T.BUCKETS)
    t, c = 9 + a, a
    nt, nc = 59 + T.PRIOR_WORDS, 901 + T.PRIOR_WORDS
    assert ratio[0] == pytest.approx(np.log(t / (nt - t)) - np.log(c / (nc - c))) and variance[0] == pytest.approx(1 / t + 1 / c)


def test_repeated_words_are_no_new_evidence():
    flat = lambda x: np.full(T.BUCKETS, x)
    known = T.Scores(T.Odds(flat(3.0), flat(0.01), flat(0.0), flat(100.0)))
    apart = ["".join(chr(97 + int(d)) for d in str(i)) for i in range(100, 100 + T.NEAR)]
    scores = known.of(" ".join(["rude", "one", "RUDE", *apart, "rude"]))
    assert scores[0] == scores[-1] == known["rude"] > 0 and scores[2] == T.NOTHING
    assert known.of(None).tolist() == known.of("").tolist() == known.of("12 _").tolist() == []


def test_labels_are_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    n = {r.y: r["count"] for r in T.labelled(docs, labels, most=500).groupBy("y").count().collect()}
    assert all(400 < n[y] <= 500 for y in (0, 1))
    assert T.labelled(docs, labels).count() == labels.where(~T.held_out(F.col("doc_id"))).count()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    plain = ["stone", "river", "walk", "green", "lamp", "seven", "table", "over", "under", "with", "music", "paper"]
    rude = ["grubface", "snotling", "wortbag", "mudbrain"]
    rows, labels = [], []
    for i in range(1200):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 120))]
        toxic = i % 4 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = rng.sample(rude, 2)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_documents_and_passages(spark, corpus):
    docs, labels = corpus
    out = T.find_passages(docs, T.learn(docs, labels)).join(labels, "doc_id").join(docs, "doc_id").where("held_out").collect()
    assert len(out) > 150
    assert sum(r.predicted == r.toxic for r in out) >= 0.98 * len(out)
    for r in out:
        if r.toxic and r.passages:
            assert any("face" in r.text[p.start:p.end] or "ling" in r.text[p.start:p.end] or "bag" in r.text[p.start:p.end]
                       or "brain" in r.text[p.start:p.end] for p in r.passages)


def test_odd_rows(spark, corpus):
    docs, labels = corpus
    model = T.learn(docs.unionByName(spark.createDataFrame([(None, "x"), (9999, None)], "doc_id long, text string")),
                    labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (1, 7), (8, 0)], "doc_id long, toxic int")))
    odd = [(1, None), (1, None), (None, ""), (2, "grubface snotling mudbrain wortbag"), (3, "stone " * 200_000), (4, "é" * 1_000_000),
           (5, "\0\n 12 __"), (6, "grubface " * 50_000)]
    rows = spark.createDataFrame(odd, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("j", F.lit(1))
    out = T.find_passages(rows, model).collect()
    assert len(out) == len(odd) and all(0 <= r.score <= 1 for r in out)
    none = out[0].score
    assert [r.score for r in out[:3]] == [none] * 3 and out[6].score == none
    assert next(r for r in out if r.doc_id == 2).predicted == 1 and next(r for r in out if r.doc_id == 3).predicted == 0


def test_nothing_to_learn_from(spark, corpus):
    docs, labels = corpus
    for known in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1")):
        model = T.learn(docs, known)
        out = T.find_passages(docs.limit(3), model).collect()
        assert all(r.passages == [] and r.score == (1.0 if known.where("toxic = 1").limit(1).count() else 0.0) for r in out)
    assert T.find_passages(docs.limit(0), T.learn(docs.limit(0), labels)).count() == 0


def test_query(spark):
    out = queries.op11_toxicity(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert out.count() == docs.count()
    assert {"doc_id", "held_out", "score", "predicted"} <= set(out.columns)
