"""Embedding near-duplicates by sorted projection passes.

1. ``classes``: equal vectors of one label become one numbered class (with its
   smallest id and its number of copies).
2. Passes: each pass has ``HASH_BITS`` random hyperplanes through the mean
   direction of the label; the sides on which a vector lies, concatenated, are
   its key.  All classes are ordered
   by (label, dimension, key) with a range-partitioned sort, numbered, and cut
   into blocks of ``WINDOW``.  A class is compared with those up to ``WINDOW``
   places after it; a block gets its own rows and the next block's, so a task
   never holds more than two windows.  Verified pairs (cosine of at least the
   limit, in double precision) become links; a block emits a spanning forest
   of its links, not all pairs.
3. The links of all passes are united into connected components.  Passes come
   in rounds, each as long as all rounds before it, until a round finds no link
   between two components: a pair that a pass meets rarely, since the label is
   large or crowded, calls for more passes, so their number follows the data.
4. ``counted``: windows are bounded, so a class may have partners it never
   met.  Within each component all classes are compared, in tiles of about
   ``TILE`` by ``TILE``, each a task of its own; only the number of links per
   class leaves a tile.  So every link inside a component counts, however
   large the component.

Vectors that are null, zero or hold null or non-finite numbers, and rows with a
null label or id, link with nothing.  Vectors of different dimension never
link.  Rows that share an id are separate vectors, and each is returned; classes are
linked, not ids, and components in which one id has vectors are one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.graph import connected_components
from ledgerline.session import materialize

PASSES, HASH_BITS, WINDOW, BLOCK, TILE = 5, 48, 64, 512, 512
LIMIT = 0.98


def usable(vector: Column) -> Column:
    """True for vectors that can link: finite numbers, not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def classes(vectors: DataFrame) -> DataFrame:
    """``(label, h1, h2, id, copies, vec, node)`` of equal usable vectors, written and
    numbered by ``node``; a class is told by its label and 128 bits of hash."""
    found = vectors.groupBy("label", "h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.any_value("vec").alias("vec"))
    return materialize(found.withColumn("node", F.monotonically_increasing_id()), "classes")


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)          # very large or small numbers keep their squares finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _planes(which: int, dim: int) -> np.ndarray:
    return np.random.default_rng([which, dim]).standard_normal((dim, HASH_BITS))


def centred(nodes: DataFrame) -> DataFrame:
    """``(label, dim, mean)``: the mean of the unit vectors of each label and
    dimension.  It steers which vectors are near in the order, never results."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (label, dim), rows in batch.groupby(["label", batch["vec"].map(len)]):
                yield pd.DataFrame({"label": label, "dim": np.int32(dim), "at": np.arange(dim, dtype=np.int32),
                                    "sum": _unit(rows["vec"]).sum(axis=0), "n": np.int64(len(rows))})
    label = nodes.schema["label"].dataType.simpleString()
    parts = nodes.select("label", "vec").mapInPandas(sums, f"label {label}, dim int, at int, sum double, n long")
    means = parts.groupBy("label", "dim", "at").agg(F.round(F.sum("sum") / F.sum("n"), 6).alias("m"))
    return means.groupBy("label", "dim").agg(F.array_sort(F.collect_list(F.struct("at", "m"))).getField("m").alias("mean"))


def keyed(nodes: DataFrame, first: int, passes: int) -> DataFrame:
    """``(pass, label, dim, key, node)``: every class once per pass, from pass
    ``first`` on; ``nodes`` hold the ``mean`` of their label."""
    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = 1 << np.arange(HASH_BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            for dim, rows in batch.groupby(batch["vec"].map(len)):
                x = _unit(rows["vec"]) - np.array(rows["mean"].tolist())
                for p in range(first, first + passes):
                    yield pd.DataFrame({"pass": np.int32(p), "label": rows["label"], "dim": np.int32(dim),
                                        "key": ((x @ _planes(p, dim)) > 0) @ bits, "node": rows["node"]})
    label = nodes.schema["label"].dataType.simpleString()
    return nodes.select("label", "node", "vec", "mean").mapInPandas(keys, f"pass int, label {label}, dim int, key long, node long")


def ranked(keys: DataFrame) -> DataFrame:
    """``keys`` with ``rank``, its place in the order of all passes."""
    order = ["pass", "label", "dim", "key", "node"]
    rows = materialize(keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "sorted")
    task = F.shiftright("at", 33)                       # the high bits number the sorted partitions
    sizes = rows.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    before = materialize(sizes.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before")), "offsets")
    return rows.withColumn("task", task).join(before, "task").select(
        "pass", "label", "dim", "node", (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank"))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Links that join what the links ``(a, b)`` of ``n`` nodes join."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((x, y))
    return out


def window_links(nodes: DataFrame, ranks: DataFrame, limit: float) -> DataFrame:
    """``(a, b)``: per block of the order, links that span the verified pairs."""
    size = max(BLOCK, WINDOW)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank", ignore_index=True)
        own = rows["rank"].to_numpy() // size == rows["block"].iloc[0]
        out = []
        for _, g in rows.groupby(["pass", "label", "dim"], sort=False):
            mine = int(own[g.index].sum())                # own rows come first
            if len(g) < 2 or not mine:
                continue
            x, rank, node = _unit(g["vec"]), g["rank"].to_numpy(), g["node"].to_numpy()
            left, right = [], []
            for at in range(0, mine, WINDOW):
                these, those = slice(at, min(at + WINDOW, mine)), slice(at, at + 2 * WINDOW)
                gap = rank[None, those] - rank[these, None]
                a, b = np.nonzero((x[these] @ x[those].T >= limit) & (gap > 0) & (gap <= WINDOW))
                left.append(a + at)
                right.append(b + at)
            out += [(node[i], node[j]) for i, j in _forest(np.concatenate(left), np.concatenate(right), len(g))]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    block, first = F.floor(F.col("rank") / size).cast("long"), F.pmod(F.col("rank"), F.lit(size)) < WINDOW
    blocks = ranks.select("*", F.explode(F.when(first, F.array(block, block - 1)).otherwise(F.array(block))).alias("block"))
    rows = blocks.join(nodes.select("node", "vec"), "node")
    return rows.groupBy("block").applyInPandas(compare, "a long, b long")


def components(nodes: DataFrame, limit: float, passes: int) -> DataFrame:
    """``(node, component)`` as ``connected_components`` gives them, from
    rounds of passes until one joins no two components."""
    means = materialize(centred(nodes), "label-means")
    placed = materialize(nodes.withColumn("dim", F.size("vec")).join(means, ["label", "dim"]).select("label", "node", "vec", "mean"), "placed")
    parts, done = None, 0
    while True:
        size = max(passes, done)
        links = window_links(nodes, ranked(keyed(placed, done, size)), limit)
        if parts is not None:
            for end in ("a", "b"):
                links = links.join(parts.select(F.col("node").alias(end), F.col("component").alias("_c")), end, "left").withColumn(
                    end, F.coalesce("_c", end)).drop("_c")
            links = materialize(links.where("a <> b").distinct(), "new-links")
            if links.isEmpty():
                return parts
            links = links.unionByName(parts.select(F.col("node").alias("a"), F.col("component").alias("b")))
        parts = materialize(connected_components(links), "components")
        done += size


def counted(nodes: DataFrame, parts: DataFrame, limit: float) -> DataFrame:
    """``(node, links)``: vectors in other classes that each class links with,
    from all pairs within its component, tile by tile."""
    members = materialize(parts.unionByName(parts.select(F.col("component").alias("node"), "component").distinct()), "members")
    tiles = members.groupBy("component").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    rows = members.join(tiles, "component").join(nodes.select("node", "copies", "vec"), "node")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other"))
    rows = rows.select("component", F.least("own", "other").alias("t1"), F.greatest("own", "other").alias("t2"), "own", "node", "copies", "vec")

    def tile(g: pd.DataFrame) -> pd.DataFrame:
        x, own, copies = _unit(g["vec"]), g["own"].to_numpy(), g["copies"].to_numpy()
        t1, t2 = g["t1"].iloc[0], g["t2"].iloc[0]
        n = np.zeros(len(g), dtype=np.int64)
        left, right = np.nonzero(own == t1)[0], np.nonzero(own == t2)[0]
        for at in range(0, len(left), 1024):
            rows = left[at:at + 1024]
            near = x[rows] @ x[right].T >= limit
            if t1 == t2:
                near[np.arange(len(rows)), at + np.arange(len(rows))] = False
            else:
                n[right] += copies[rows] @ near
            n[rows] += near @ copies[right]
        return pd.DataFrame({"node": g["node"], "links": n})

    return rows.groupBy("component", "t1", "t2").applyInPandas(tile, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def shared_ids(rows: DataFrame) -> DataFrame:
    """``(a, b)``: components that are one since an id has vectors in both."""
    ends = rows.where(F.col("component_id").isNotNull()).groupBy("id").agg(F.min("component_id").alias("a"), F.max("component_id").alias("z")).where("a <> z")
    return rows.join(ends, "id").select("a", F.col("component_id").alias("b")).where("a <> b").distinct()


def near_duplicates(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    limit: float = LIMIT, passes: int = PASSES) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` for every row of ``embeddings``.

    A row with a null id has a null component and is not kept; any other
    vector that links with nothing is its own component and is kept.
    ``passes`` is the length of the first round.
    """
    vec = F.col(vector_col)
    able = usable(vec) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vec.alias("vec"), able.alias("able"))
    rows = rows.withColumn("h1", F.when(F.col("able"), F.xxhash64(F.lit(1), "vec"))).withColumn("h2", F.when(F.col("able"), F.xxhash64(F.lit(2), "vec")))
    nodes = classes(rows.where("able"))
    parts = components(nodes, limit, passes)
    links = materialize(counted(nodes, parts, limit), "link-counts")
    own = nodes.join(parts, "node", "left").join(links, "node", "left").select(
        "label", "h1", "h2", "id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    own = materialize(own, "class-links")
    least = own.groupBy("component").agg(F.min("id").alias("component_id"), F.count("*").alias("classes")).where("classes > 1")
    own = own.join(least, "component", "left").select("label", "h1", "h2", "n_links", F.coalesce("component_id", "id").alias("component_id"))
    own = materialize(own, "class-results")
    out = rows.select("id", "label", "h1", "h2").join(own, ["label", "h1", "h2"], "left")
    out = materialize(out.withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))), "rows")
    joined = connected_components(shared_ids(out)).withColumnRenamed("node", "component_id")
    out = out.join(joined, "component_id", "left").withColumn("component_id", F.coalesce("component", "component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.coalesce(F.col("component_id") == F.col("id"), F.lit(False)).alias("kept"))
