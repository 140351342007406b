import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import quality as Q


def loss(net, data, label):
    z = net.logit(data)
    return np.log1p(np.exp(-z)) if label else np.log1p(np.exp(z))


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    net = Q.Network.start(1)
    for name in ("embed", "filters", "bias", "out", "prior"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.bias[:] = 0.1
    data = bytes(rng.integers(97, 110, Q.CHUNK * 2 + 40).astype(np.uint8))
    grads = net.gradients(data, 1)
    for w, g in zip(net.weights(), grads):
        flat = w.reshape(-1)
        for i in rng.choice(flat.size, min(6, flat.size), replace=False):
            old, step = flat[i], 1e-5
            flat[i] = old + step
            up = loss(net, data, 1)
            flat[i] = old - step
            down = loss(net, data, 1)
            flat[i] = old
            assert abs((up - down) / (2 * step) - g.reshape(-1)[i]) < 2e-3


def test_chunks_cover_every_window():
    for n in (0, 1, Q.WIDTH, Q.CHUNK, Q.CHUNK + 1, Q.CHUNK * 3 + 7):
        data = bytes(i % 251 for i in range(n)).ljust(Q.WIDTH, b"\0")
        chunks = [bytes(c) for c in Q._chunks(data)]
        windows = [c[i:i + Q.WIDTH] for c in chunks for i in range(len(c) - Q.WIDTH + 1)]
        assert windows == [data[i:i + Q.WIDTH] for i in range(len(data) - Q.WIDTH + 1)]


def plain_score(net, text):
    """The network by definition: every window of the whole padded text, one by one."""
    data = (text or "").encode().ljust(Q.WIDTH, b"\0")
    count = len(data) - Q.WIDTH + 1
    values = [[max(0.0, float(net.bias[f]) + sum(float(net.embed[data[i + k]] @ net.filters[k][:, f]) for k in range(Q.WIDTH))) for f in range(Q.FILTERS)]
              for i in range(count)]
    tops, at = [], 0
    while at < count:                                    # chunks share no window
        part = values[at:at + Q.CHUNK - Q.WIDTH + 1]
        tops.append((len(part), [max(v[f] for v in part) for f in range(Q.FILTERS)]))
        at += len(part)
    mean = [sum(n * t[f] for n, t in tops) / count for f in range(Q.FILTERS)]
    largest = [max(t[f] for _, t in tops) for f in range(Q.FILTERS)]
    z = sum(a * float(b) for a, b in zip(mean + largest, net.out)) + float(net.prior[0])
    return 1 / (1 + np.exp(-z))


def test_scores_equal_a_plain_convolution(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    net = Q.train(docs, labels)
    texts = ["", None, "abc", "é" * 300, "x" * Q.CHUNK, "ab " * 400] + [r.text[:3000] for r in docs.orderBy("doc_id").limit(6).collect()]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in Q.classify(frame, net).collect()}
    for i, t in enumerate(texts):
        assert abs(got[i] - plain_score(net, t)) < 1e-4


def test_held_out_accuracy(spark):
    """Trained without the held-out fold, right on at least 95 % of it."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    net = Q.train(docs, labels)
    test = docs.join(labels, "doc_id").where(F.expr("crc32(cast(doc_id as string)) % 5 = 0")).select("text", "quality").collect()
    right = [(net.score(r.text) >= Q.THRESHOLD) == r.quality for r in test]
    good = [net.score(r.text) >= Q.THRESHOLD for r in test if r.quality]
    assert len(test) > 200 and np.mean(right) >= 0.95 and np.mean(good) >= 0.97
    short = net.score("x" * 5), net.score(""), net.score(None)
    assert all(0 <= s <= 1 for s in short) and short[1] == short[2]


def test_rows_nulls_and_fold(spark):
    net = Q.Network.start()
    rows = [(1, "a text", "x"), (None, None, "y"), (1, "a text", "x"), (5, "", "z"), (6, "é" * 50000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = Q.classify(docs, net).collect()
    assert len(got) == 5
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= Q.THRESHOLD)


def test_training_never_sees_the_held_out_fold(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(None, 1), (3, None)], "doc_id long, quality int")
    rows = Q.training_rows(docs, labels, sample={0: 10, 1: 15}).collect()
    assert all(zlib.crc32(str(r.id).encode()) % 5 for r in rows)
    assert sum(r.label == 0 for r in rows) == 10 and sum(r.label for r in rows) == 15


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    net = Q.train(docs, labels)
    assert net.score("anything") == 0.5 and Q.classify(docs, net).count() == 0
    assert abs(Q.fit([b"a"] * 8, [1] * 8).score("b") - 0.9) < 1e-6
