"""Token counts kept as additive rollups of signed changes.

A change is ``(source, lang, tokenizer, sign, tokens)``: a document that comes
(+1), goes (-1), or is counted anew (-1 with the old count, +1 with the new).
``Rollup.commit`` sums a batch of changes by source, language and tokenizer
version and adds the sums as a new attempt of that batch; every row tells how
many rows its attempt has.  ``Rollup.totals`` adds up, of each batch, the newest
attempt that is there in full.  So a job lost at any time changes nothing, and
committing a batch again, after a failure or twice by mistake, takes the place of
what was counted before.  Batches may be committed in any order, one writer at a
time.  A store without batches has no totals; a batch without changes adds none.

Counting itself is byte-pair encoding with a vocabulary file whose path is a
parameter; the driver reads it and sends it to the tasks (a vocabulary is below
1 MB).  A null text has 0 tokens.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe
from ledgerline.session import materialize

VOCABULARIES = "/opt/tokenizers"
KEYS = ("source", "lang", "tokenizer")
_LOADED: dict[str, tiktoken.Encoding] = {}


def _encoding(vocabulary: bytes) -> tiktoken.Encoding:
    """The encoding of a vocabulary file, built once per Python worker."""
    key = hashlib.sha256(vocabulary).hexdigest()
    if key not in _LOADED:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
        _LOADED[key] = bpe.encoding(key, ranks)
    return _LOADED[key]


def token_count(spark: SparkSession, text: Column, path: str) -> Column:
    """The number of tokens of a text column under the vocabulary file at ``path``."""
    with open(path, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = _encoding(vocabulary.value)
        for texts in batches:
            yield pd.Series([len(bpe.encode(encoding, t)) if t else 0 for t in texts], dtype="int64")
    return tokens(text)


class Rollup:
    """Totals per source, language and tokenizer version under ``root``, a folder
    that all executors share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _rows(self) -> DataFrame:
        schema = "source string, lang string, tokenizer string, docs long, tokens long, batch int, attempt int, of long"
        try:
            return self.spark.read.schema(schema).parquet(self.root)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def attempts(self) -> DataFrame:
        """``(batch, attempt)``: of each batch the newest attempt that is there in full."""
        held = self._rows().groupBy("batch", "attempt").agg(F.count(F.lit(1)).alias("n"), F.max("of").alias("of"))
        return held.where("n = of").groupBy("batch").agg(F.max("attempt").alias("attempt"))

    def commit(self, batch: int, changes: DataFrame) -> None:
        sums = changes.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens"))
        none = self.spark.range(1).select(*[F.lit(None).cast("string").alias(k) for k in KEYS], F.lit(0).cast("long").alias("docs"), F.lit(0).cast("long").alias("tokens"))
        rows = materialize(sums.unionByName(none), "rollup-sums")         # one row of zeros, so an empty batch has a row
        last = self._rows().where(F.col("batch") == int(batch)).agg(F.max("attempt")).first()[0] or 0
        rows.select("*", F.lit(int(batch)).alias("batch"), F.lit(last + 1).alias("attempt"), F.lit(rows.count()).alias("of")).write.mode("append").parquet(self.root)

    def totals(self) -> DataFrame:
        """``(source, lang, tokenizer, docs, tokens, batches)``; groups whose
        documents are all gone are left out."""
        sums = self._rows().join(self.attempts(), ["batch", "attempt"]).where("docs <> 0 or tokens <> 0")
        return sums.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"), F.count_distinct("batch").alias("batches")).where("docs <> 0 or tokens <> 0")


def inserts(rows: DataFrame, tokenizer: str, tokens: str) -> DataFrame:
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(1).alias("sign"), F.col(tokens).alias("tokens"))


def deletes(rows: DataFrame, tokenizer: str, tokens: str) -> DataFrame:
    return inserts(rows, tokenizer, tokens).withColumn("sign", F.lit(-1))


def revisions(rows: DataFrame, old: str, old_tokens: str, new: str, new_tokens: str) -> DataFrame:
    return deletes(rows, old, old_tokens).unionByName(inserts(rows, new, new_tokens))
