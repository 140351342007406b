"""Mixing sources to target weights with hash-threshold histograms.

Words are the runs of characters other than U+0020 and U+0009-U+000D; a
document's size is its number of words (null text: 0).  The sources, by code
point and null last, get the weights in turn and share ``ratio`` times all
words; a target stops at ``max_epochs`` times its source's size and the excess
goes to the others by weight (water-filling).

Every document has a 60-bit hash of its id (of its text where the id is null).
A source takes each document ``epochs = floor(target / size)`` times and once
more those whose hash lies under the source's cut.  The cut comes from sums of
words per source and hash bucket: on the first 12 bits the running sum finds
the bucket in which the budget ends; only the documents of that bucket are
summed again on the next 12 bits, and those of the bucket found there on the
whole hash.  The hash in which the budget ends is taken if that comes nearer.  Nothing is sorted; a
smaller budget always takes a subset of a larger one.

Rows with one hash (repeated rows of one id) are taken together, so a target
is met to within half the words of one hash.  A source without words has
target 0 and its documents are taken 0 words.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
LEVEL_ENDS = (12, 24, HASH_BITS)      # leading bits that make the buckets of each level
WEIGHTS, RATIO, MAX_EPOCHS = (3, 1, 2), 1.5, 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of the id, or of the text where the id is null."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), text), F.lit(""))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, ratio: float = RATIO,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row a source.

    Sources are met in the order of cap by weight; one is capped if its share
    of what the capped ones before it leave would exceed its cap.  The windows
    run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.select("source", "source_size", (F.row_number().over(by_name) - 1).alias("i"))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("i") % len(weights) + 1).cast("int")))
    every = Window.partitionBy()
    fill = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), "i")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    dec = lambda c: c.cast("decimal(38,4)")
    cap = F.col("source_size") * max_epochs
    s = (s.withColumn("budget", F.sum("source_size").over(every) * F.lit(float(ratio)))
         .withColumn("cap", cap)
         .withColumn("left", F.col("budget") - F.coalesce(F.sum(cap).over(before), F.lit(0)))
         .withColumn("w_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("capped", dec(F.col("cap")) * dec(F.col("w_left")) <= dec(F.col("left")) * dec(F.col("weight"))))
    s = s.withColumn("k", F.row_number().over(fill))
    s = s.withColumn("free", F.min(F.when(~F.col("capped"), F.struct("k", "left", "w_left"))).over(every))
    return s.select("source", "source_size", F.when(
        F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.col("free.left") * F.col("weight") / F.col("free.w_left")).alias("target"))


def _boundary(rows: DataFrame, rest: DataFrame, level: int) -> DataFrame:
    """Per source, the bucket of this level in which the budget ends:
    ``(source, prefix, rest, words)`` with the budget left before that bucket."""
    shift = HASH_BITS - LEVEL_ENDS[level]
    sums = (rows.withColumn("prefix", F.shiftright("h", shift)).groupBy("source", "prefix").agg(F.sum("size").alias("words")))
    up_to = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    run = sums.withColumn("after", F.sum("words").over(up_to)).alias("r").join(
        rest.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).where("r.after > t.rest")
    first = run.groupBy("r.source").agg(F.min(F.struct("r.prefix", (F.col("t.rest") - F.col("r.after") + F.col("r.words")).alias("rest"), "r.words")).alias("b"))
    return first.select("source", "b.prefix", "b.rest", "b.words")


def cuts(rows: DataFrame, weights: Sequence[int] = WEIGHTS, ratio: float = RATIO, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target, epochs, cut)`` for rows ``(source, size, h)``."""
    plan = materialize(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, ratio, max_epochs)
                       .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")),
                       "mix-targets")
    rest = plan.select("source", (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"))
    bound = None
    for level in range(len(LEVEL_ENDS)):
        if bound is not None:      # only the documents of the boundary buckets go on
            shift = HASH_BITS - LEVEL_ENDS[level - 1]
            rows = materialize(rows.alias("x").join(bound.alias("b"), F.col("x.source").eqNullSafe(F.col("b.source"))
                               & (F.shiftright("x.h", shift) == F.col("b.prefix"))).select("x.source", "x.size", "x.h"), "mix-boundary")
            rest = bound.select("source", "rest")
        bound = materialize(_boundary(rows, rest, level), "mix-bound")
    cut = bound.select(F.col("source").alias("s"), (F.col("prefix") + F.when(F.col("words") - F.col("rest") < F.col("rest"), 1).otherwise(0)).alias("cut"))
    return materialize(plan.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
                       .select("source", "source_size", "target", "epochs", F.coalesce("cut", F.lit(0)).alias("cut")), "mix-cuts")


def with_copies(rows: DataFrame, cut_table: DataFrame, source: str = "source", h: str = "h") -> DataFrame:
    """``rows`` with ``mix_source_size``, ``mix_target`` and ``mix_copies`` (times the row is taken)."""
    c = cut_table.select(*[F.col(x).alias(f"mix_{x}") for x in cut_table.columns])
    return rows.join(c, F.col(source).eqNullSafe(F.col("mix_source")), "left").withColumn(
        "mix_copies", F.col("mix_epochs") + (F.col(h) < F.col("mix_cut")).cast("long")).drop("mix_source", "mix_epochs", "mix_cut")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), document_hash(F.col(id_col), F.col(text_col)).alias("h"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, ratio: float = RATIO, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(id_col, size, source_size, target, taken)`` for every row of ``docs``;
    ``taken`` counts the words the mix takes of the row, repeats included."""
    rows = materialize(sized(docs, id_col, text_col, source_col), "mix-sizes")
    out = with_copies(rows, cuts(rows, weights, ratio, max_epochs))
    return out.select(F.col("id").alias(id_col), "size", F.col("mix_source_size").alias("source_size"),
                      F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("size")).alias("taken"))


def select_mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 weights: Sequence[int] = WEIGHTS, ratio: float = RATIO, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The rows of ``docs`` that the mix takes at least once, with all their
    columns and ``mix_copies``, how often; same cuts as ``mix``."""
    kept = reduce(lambda d, c: d.drop(c), ("mix_h", "mix_source_size", "mix_target", "mix_copies"), docs)
    cut_table = cuts(materialize(sized(kept, id_col, text_col, source_col).drop("id"), "mix-sizes"), weights, ratio, max_epochs)
    out = with_copies(kept.withColumn("mix_h", document_hash(F.col(id_col), F.col(text_col))), cut_table, source_col, "mix_h")
    return out.where("mix_copies > 0").drop("mix_h", "mix_source_size", "mix_target")
