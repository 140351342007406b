import hashlib
import random
import re
from fractions import Fraction

from pyspark.sql import functions as F

from ledgerline.llm import mixing as M


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def hash60(i, t):
    key = str(i) if i is not None else "text:" + t if t is not None else ""
    return int(hashlib.md5(key.encode()).hexdigest()[:15], 16)


def brute(rows, weights=(3, 1, 2), ratio=Fraction(3, 2), most=2):
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = {n: sum(size(r[1]) for r in rows if r[2] == n) for n in names}
    w = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    target, free, left = {}, list(names), ratio * sum(sizes.values())
    while free:
        share = {n: left * w[n] / sum(w[x] for x in free) for n in free}
        over = [n for n in free if share[n] > most * sizes[n]]
        if not over:
            target.update(share)
            break
        for n in over:
            target[n] = Fraction(most * sizes[n])
            left -= target[n]
            free.remove(n)
    out = []
    for n in names:
        docs = [r for r in rows if r[2] == n]
        epochs = target[n] // sizes[n] if sizes[n] else 0
        rest, run, extra = target[n] - epochs * sizes[n], 0, set()
        for h in sorted({hash60(r[0], r[1]) for r in docs}):
            words = sum(size(r[1]) for r in docs if hash60(r[0], r[1]) == h)
            if run + words > rest:
                if run + words - rest < rest - run:
                    extra.add(h)
                break
            run += words
            extra.add(h)
        for i, t, _ in docs:
            out.append((i if i is not None else -1, size(t), sizes[n], round(float(target[n]), 6), int((epochs + (hash60(i, t) in extra)) * size(t)) if size(t) else 0))
    return sorted(out)


def rows_of(seed, n=400):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" * rng.randrange(1, 9) for _ in range(int(rng.expovariate(1 / 30)))), rng.choice(["a", "b", "b", "b", "ü", "Z", None, "empty"]))
            for i in range(n)]
    rows = [(i, None if s == "empty" else t, s) for i, t, s in rows]
    return rows + [(None, "x y z", "a"), (None, None, "b"), (7, "one two", "b"), (7, "one two", "b"), (n, "w " * 5000, "one\tlong")]


def test_mix_equals_sorting(spark):
    for seed in (1, 2):
        rows = rows_of(seed)
        frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, h int")
        got = M.mix(frame).select(F.coalesce("doc_id", F.lit(-1)), "size", "source_size", "target", "taken").collect()
        assert sorted((*r[:3], round(r[3], 6), r[4]) for r in got) == brute(rows)


def test_every_source_is_near_its_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = M.mix(docs).join(docs.select("doc_id", "source"), "doc_id")
    largest = got.agg(F.max("size")).first()[0]
    for r in got.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max(F.col("taken") / F.col("size")).alias("m")).collect():
        assert abs(r.t - r.g) <= largest / 2 and r.m <= 2


def test_selected_rows_agree_with_the_mix(spark):
    rows = rows_of(3)
    frame = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, mix_h int")
    taken = M.mix(frame).agg(F.sum("taken")).first()[0]
    out = M.select_mixed(frame)
    assert out.columns == ["doc_id", "text", "source", "mix_copies"]
    assert sum(size(r.text) * r.mix_copies for r in out.collect()) == taken


def test_empty_table(spark):
    assert M.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
