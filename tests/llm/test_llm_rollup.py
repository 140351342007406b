import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import bpe, queries
from ledgerline.llm import token_rollup as T
from ledgerline.session import ensure_checkpoint_dir

PATH = f"{T.VOCABULARIES}/byte_bpe_50k.tiktoken"


@pytest.fixture
def rollup(spark):
    return T.Rollup(spark, f"{ensure_checkpoint_dir(spark)}/rollup-test-{uuid.uuid4().hex}")


def totals(rollup):
    return {tuple(r)[:3]: (r.docs, r.tokens) for r in rollup.totals().collect()}


def test_batches_add_up_in_any_order_and_count_once(spark, rollup):
    rows = spark.createDataFrame([("a", "en", 5, 7, 1), ("a", None, 3, 4, 1), (None, "de", 2, 9, 1), ("a", "en", 5, 7, 1)],
                                 "source string, lang string, t1 long, t2 long, sign int")
    rollup.commit(3, T.revisions(rows.where("source is null"), "v1", "t1", "v2", "t2"))
    for _ in range(2):
        rollup.commit(1, T.inserts(rows, "v1", "t1"))
    rollup.commit(2, T.deletes(rows.where("lang is null"), "v1", "t1"))
    rollup.commit(4, T.inserts(rows.limit(0), "v1", "t1"))
    assert totals(rollup) == {("a", "en", "v1"): (2, 10), (None, "de", "v2"): (1, 9)}


def test_a_batch_can_be_committed_anew(spark, rollup):
    rows = spark.createDataFrame([("a", "en", 5)], "source string, lang string, t long")
    rollup.commit(1, T.inserts(rows, "v1", "t"))
    rollup.commit(1, T.inserts(rows.withColumn("t", F.lit(6)), "v1", "t"))
    assert totals(rollup) == {("a", "en", "v1"): (1, 6)}


def test_a_lost_commit_changes_nothing(spark, rollup):
    rows = spark.createDataFrame([("a", "en", 5), ("b", "en", 5)], "source string, lang string, t long")
    rollup.commit(1, T.inserts(rows, "v1", "t"))
    before = totals(rollup)
    torn = spark.createDataFrame([("a", "en", "v1", 9, 900, 1, 2, 3), ("b", "en", "v1", 9, 900, 1, 2, 3)], rollup._rows().schema)
    torn.write.mode("append").parquet(rollup.root)          # two of an attempt's three rows
    assert totals(rollup) == before
    rollup.commit(1, T.inserts(rows.limit(1), "v1", "t"))
    assert sum(n for n, _ in totals(rollup).values()) == 1


def test_no_batches_and_empty_batches(spark, rollup):
    assert totals(rollup) == {}
    rows = spark.createDataFrame([("a", "en", 5)], "source string, lang string, t long")
    rollup.commit(1, T.inserts(rows.limit(0), "v1", "t"))
    assert totals(rollup) == {}
    rollup.commit(1, T.inserts(rows, "v1", "t"))
    rollup.commit(1, T.inserts(rows.limit(0), "v1", "t"))
    assert totals(rollup) == {}


def test_long_runs_count_as_their_pieces(spark):
    with open(PATH, "rb") as f:
        encoding = T._encoding(f.read())
    texts = [" " * n + end for n in (1999, 2000, 2001, 5000, 50_000) for end in ("", "x", "\n", " x  y")] + ["\n" * 9000 + "a", "\u3000\t" * 4000 + "é"]
    for t in texts:
        assert bpe.encode(encoding, t) == encoding.encode_ordinary(t)
    huge = [" " * 1_000_000 + "x", "\n" * 1_000_000, "a" * 1_000_000, "= " * 1_000_000]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(huge)], "i int, text string")
    got = {r.i: r.n for r in frame.select("i", T.token_count(spark, F.col("text"), PATH).alias("n")).collect()}
    assert got[0] == 1_000_000 and all(got[i] > 0 for i in got)


def test_counts_equal_the_tokenizer(spark):
    with open(PATH, "rb") as f:
        encode = T._encoding(f.read()).encode_ordinary
    texts = ["plain words", "", None, "é😀 <|endoftext|> 123", "x" * 50000, "a\n\n  b"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: r.n for r in frame.select("text", T.token_count(spark, F.col("text"), PATH).alias("n")).collect()}
    assert got == {t: len(encode(t)) if t else 0 for t in texts}


def test_query_equals_a_full_count(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    encode = {}
    for v in ("byte_bpe_50k", "byte_bpe_multi_50k"):
        with open(f"{T.VOCABULARIES}/{v}.tiktoken", "rb") as f:
            encode[v] = T._encoding(f.read()).encode_ordinary
    n, tokens, seen = Counter(), Counter(), set()
    for r in sorted(docs, key=lambda r: r.doc_id):
        if r.text in seen:
            continue
        seen.add(r.text)
        v = "byte_bpe_50k" if r.lang == "en" else "byte_bpe_multi_50k"
        n[r.source, r.lang, v] += 1
        tokens[r.source, r.lang, v] += len(encode[v](r.text))
    got = {tuple(r)[:3]: (r.docs, r.tokens) for r in queries.op8_token_rollup(spark, "/root/testdata/sf0.001").collect()}
    assert got == {k: (n[k], tokens[k]) for k in n}
