"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints differ in at most ``tau`` bits only if, for any split of the
64 bits into ``m`` parts with thresholds that sum to ``tau - m + 1``, they
differ in at most ``t_i`` bits on some part ``i`` (a part of threshold -1 is
never looked at).  The steps, each a Spark job over distinct fingerprints:

1. ``bit_correlations``: how often each two bits are set together, over all
   fingerprints; correlated bits go into the same part (``group_bits``), which
   keeps the other parts selective.
2. ``distance_counts``: how many fingerprints lie within 0..tau bits of a
   bounded set of query fingerprints on each part, counted over all
   fingerprints.  From these estimated candidate counts ``allocate`` finds the
   thresholds of each number of parts by dynamic programming, and the cheapest
   number of parts is taken.  Estimates steer the cost, never the result.
3. ``links``: every fingerprint is indexed under its bits on each part and
   probes all values within the part's threshold; pairs are verified on the
   whole fingerprint inside the join.
4. ``connected_components`` over the links.

Only components are asked for, so ``groups`` doesn't write all links of a large
group of variants: ``pivot_links`` first ties fingerprints that agree on half of
their bits to the smallest of them, where that is within ``tau`` bits, at most
six links a fingerprint.  The probes of step 3 then emit only links between two
of the components so made, once for each two components.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.graph import connected_components
from ledgerline.llm.simhash import fingerprint_column
from ledgerline.session import materialize

BITS = 64
PARTS = range(2, 9)       # numbers of parts that are weighed against each other
QUERIES = 64              # fingerprints whose neighbourhoods estimate the candidate counts
PROBE_COST, CANDIDATE_COST = 1.0, 0.02


@dataclass(frozen=True)
class Part:
    """Some of the 64 bits and how many of them a probe may differ in."""
    bits: tuple[int, ...]
    threshold: int

    def flips(self) -> list[int]:
        """The bit patterns within the threshold of this part, as signed longs."""
        return [_signed(sum(1 << b for b in c))
                for k in range(self.threshold + 1) for c in combinations(self.bits, k)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bit_correlations(fingerprints: DataFrame) -> np.ndarray:
    """The 64 x 64 correlations of the bits of column ``fp``, over all rows."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((BITS, BITS), dtype=np.int64), 0
        for batch in batches:
            fp = batch["fp"].to_numpy(dtype=np.int64)
            bits = np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float64)
            total += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        yield pd.DataFrame({"k": np.arange(BITS * BITS + 1), "n": np.append(total.ravel(), n)})

    rows = fingerprints.select("fp").mapInPandas(count, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    if not rows:
        return np.zeros((BITS, BITS))
    both = np.zeros(BITS * BITS + 1)
    for r in rows:
        both[r["k"]] = r["n"]
    n, both = max(1.0, both[-1]), both[:-1].reshape(BITS, BITS)
    mean = np.diag(both) / n
    scale = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return np.where((scale[:, None] > 1e-5) & (scale[None, :] > 1e-5),
                    (both / n - np.outer(mean, mean)) / np.outer(scale, scale), 0.0)


def group_bits(corr: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """The bits in ``m`` parts of nearly equal width: each part starts with the
    free bit least tied to the other free ones and takes those most tied to it."""
    free, strength, out = list(range(BITS)), np.abs(corr), []
    for i in range(m):
        width = len(free) // (m - i)
        part = [min(free, key=lambda b: (strength[b, free].sum(), b))]
        while len(part) < width:
            part.append(max((b for b in free if b not in part), key=lambda b: (strength[b, part].sum(), -b)))
        out.append(tuple(sorted(part)))
        free = [b for b in free if b not in part]
    return out


def distance_counts(fingerprints: DataFrame, parts: list[tuple[int, ...]], tau: int) -> tuple[np.ndarray, int]:
    """Per part, the estimated number of ordered pairs within 0..tau bits on
    it, and the number of fingerprints.  ``QUERIES`` fingerprints (those of the
    smallest hashes) are compared with all rows, in blocks."""
    queries = np.array([r["fp"] for r in fingerprints.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(QUERIES).collect()],
                       dtype=np.int64).view(np.uint64)
    masks = np.array([sum(1 << b for b in p) for p in parts], dtype=np.uint64)
    width = tau + 1

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((len(masks), width), dtype=np.int64), 0
        for batch in batches:
            fp = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            n += len(fp)
            for at in range(0, len(fp), 4096):
                x = fp[at:at + 4096, None] ^ queries[None, :]
                for i, mask in enumerate(masks):
                    d = np.bitwise_count(x & mask).ravel()
                    total[i] += np.bincount(d[d <= tau], minlength=width)[:width]
        yield pd.DataFrame({"k": np.arange(len(masks) * width + 1), "n": np.append(total.ravel(), n)})

    rows = fingerprints.select("fp").mapInPandas(count, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(len(masks) * width + 1)
    for r in rows:
        flat[r["k"]] = r["n"]
    n, counts = int(flat[-1]), flat[:-1].reshape(len(masks), width)
    counts[:, 0] = np.maximum(0, counts[:, 0] - len(queries))     # a query meets itself
    return np.cumsum(counts, axis=1) * (n / max(1, len(queries))), n


def allocate(parts: list[tuple[int, ...]], candidates: np.ndarray, n: int, tau: int) -> tuple[float, list[Part]]:
    """Thresholds of least estimated cost that sum to ``tau - m + 1``, by
    dynamic programming over the parts (state: the sum so far)."""
    m = len(parts)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i, bits in enumerate(parts):
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, tau + 1):
                probes = sum(comb(len(bits), k) for k in range(t + 1))
                c = cost + (n * probes * PROBE_COST + candidates[i, t] * CANDIDATE_COST if t >= 0 else 0.0)
                if spent + t not in step or c < step[spent + t][0]:
                    step[spent + t] = (c, [*chosen, t])
        best = step
    cost, chosen = best[tau - m + 1]
    return cost, [Part(b, t) for b, t in zip(parts, chosen) if t >= 0]


def plan(fingerprints: DataFrame, tau: int) -> list[Part]:
    """The parts to probe for links of at most ``tau`` bits."""
    corr = bit_correlations(fingerprints)
    splits = [group_bits(corr, m) for m in PARTS if m <= tau + 1] or [group_bits(corr, 1)]
    counts, n = distance_counts(fingerprints, [p for s in splits for p in s], tau)
    options, at = [], 0
    for s in splits:
        options.append(allocate(s, counts[at:at + len(s)], n, tau))
        at += len(s)
    return min(options, key=lambda o: o[0])[1]


def _masked(bits: Iterable[int]) -> Column:
    return F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))


def _near(a: str, b: str, tau: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= tau


def pivot_links(fingerprints: DataFrame, tau: int) -> DataFrame:
    """Some of the links ``(a, b)`` of column ``node`` within ``tau`` bits of
    ``fp``, at most one per fingerprint and two quarters of the bits: to the
    smallest fingerprint that agrees on both quarters."""
    quarters = [range(i, i + BITS // 4) for i in range(0, BITS, BITS // 4)]
    keys = [F.struct(F.lit(i).alias("part"), _masked([*x, *y]).alias("value")) for i, (x, y) in enumerate(combinations(quarters, 2))]
    keyed = fingerprints.select("node", "fp", F.explode(F.array(*keys)).alias("k")).select("node", "fp", "k.part", "k.value")
    first = keyed.groupBy("part", "value").agg(F.min(F.struct("fp", "node")).alias("p"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = keyed.join(first.select("part", "value", F.col("p.fp").alias("q"), F.col("p.node").alias("b")), ["part", "value"])
    return pairs.where((F.col("fp") != F.col("q")) & _near("fp", "q", tau)).select(F.col("node").alias("a"), "b")


def links(fingerprints: DataFrame, tau: int, parts: list[Part]) -> DataFrame:
    """All pairs ``(a, b)`` of different values of column ``node`` that have an
    ``fp`` each which differ in at most ``tau`` bits; ``fp`` must be distinct."""
    def of_part(i: int, part: Part, flips: list[int]) -> Column:
        return F.transform(F.array(*[F.lit(x) for x in flips]),
                           lambda x: F.struct(F.lit(i).alias("part"), _masked(part.bits).bitwiseXOR(x).alias("value")))

    def keyed(probe: bool) -> DataFrame:
        keys = [of_part(i, p, p.flips() if probe else [0]) for i, p in enumerate(parts)]
        return fingerprints.select("node", "fp", F.explode(F.concat(*keys)).alias("k")).select("node", "fp", "k.part", "k.value")

    x, y = keyed(True).alias("x"), keyed(False).alias("y")
    pairs = x.join(y, (F.col("x.part") == F.col("y.part")) & (F.col("x.value") == F.col("y.value"))
                   & (F.col("x.fp") < F.col("y.fp")) & (F.col("x.node") != F.col("y.node")) & _near("x.fp", "y.fp", tau))
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def groups(fingerprints: DataFrame, ties: DataFrame, tau: int) -> DataFrame:
    """``(node, fp, component)`` for the distinct ``fp`` of ``fingerprints``:
    the smallest ``node`` reachable over links within ``tau`` bits and over the
    pairs ``(a, b)`` of ``ties``."""
    def united(pairs: DataFrame, nodes: DataFrame, node: str) -> DataFrame:
        ends = connected_components(pairs).select(F.col("node").alias("end"), F.col("component").alias("to"))
        return nodes.join(ends, nodes[node] == ends["end"], "left").withColumn("component", F.coalesce("to", node)).drop("end", "to")

    near = materialize(united(pivot_links(fingerprints, tau).unionByName(ties), fingerprints, "node"), "pivots")
    rest = links(near.select(F.col("component").alias("node"), "fp"), tau, plan(fingerprints, tau))
    return united(rest, near, "component")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """``(id_col, fp, component_id)`` for every row of ``docs``.

    ``fp`` is the signed fingerprint, ``component_id`` the smallest id whose
    fingerprint is reachable over links of at most ``max_bits`` bits.  Null
    and empty texts have fingerprint zero and link like others.  A row with a
    null id links with nothing (null component); rows that share an id are
    each returned and each link.  Other columns of ``docs`` are not read.
    """
    rows = materialize(docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle_words).alias("fp")), "fingerprints")
    known = rows.where("id is not null")
    classes = materialize(known.groupBy("fp").agg(F.min("id").alias("node")), "classes")
    # rows of one id may have several fingerprints: they hang together
    same = known.groupBy("id").agg(F.min("fp").alias("f"), F.max("fp").alias("t")).where("f <> t").select("id")
    ties = (known.join(same, "id").join(classes, "fp").select(F.col("id").alias("a"), F.col("node").alias("b")))
    ends = groups(classes, ties, max_bits).select("fp", F.col("component").alias("component_id"))
    return rows.join(ends, "fp", "left").select(
        F.col("id").alias(id_col), "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
