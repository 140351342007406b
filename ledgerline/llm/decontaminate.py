"""Benchmark decontamination with SimHash windows and multi-index Hamming blocks.

Words are runs of letters, marks and digits of the lower-cased text; shingles
are five words.  A document holds an item of ``L`` words if some window of
``L`` words of it has a weighted Jaccard similarity of 0.8 or more with the
item (shingles weigh as often as they occur) and a SimHash fingerprint within
``RADIUS`` bits of the item's.  Where none does, an item cut off by the start or
end of the document counts: a shorter window there shares shingles with the last
or first ones of the item, as many as the window has (a document shorter than
the item: with all), and those cut off count against the similarity.  The steps, all DataFrame expressions:

1. ``segments``: a bitmap of the items' shingle hashes is looked up at every
   word of every document; stretches of words around hits are kept (with an
   overlap of the longest item, so no window is cut).  The bitmap lets false
   hits through but never loses one.
2. ``windows``: hits are joined with the items.  A window of similarity ``s``
   must share ``2 s / (1 + s)`` of its shingles with the item; all windows of
   the item's length with that many hits are listed, each distinct text once.
   At the start and end of a document the shorter windows with ``m`` of ``n``
   shingles are listed too, if ``s (n + m) / (1 + s)`` of them are hits.
3. ``matches``: a window's fingerprint and the item's are cut into ``BLOCKS``
   blocks; the items are indexed under every value within ``BLOCK_RADIUS``
   bits of each block.  Fingerprints within ``BLOCKS * (BLOCK_RADIUS + 1) - 1``
   bits agree that far on one block at least, so none within ``RADIUS`` is
   lost.  Candidates are verified on the fingerprint, then on the shingles.

Null and empty texts hold nothing; items of fewer than five words have no
shingle and are never found; a null item text counts as empty.  Repeated
document rows give one result row per id and item; rows with a null id share
one.  Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialize

SHINGLE, SIMILARITY = 5, 0.8
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1          # 23 of 64 bits
BITMAP_PER_SHINGLE, BITMAP_MOST = 256, 1 << 24     # bits
STRIDE = 256


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def _each_shingle(words: str, what: str) -> str:
    """An array of ``what`` for each shingle; ``w0``..``w4`` are its words."""
    for k in range(SHINGLE):
        what = what.replace(f"w{k}", f"{words}[i + {k}]")
    return f"if(size({words}) < {SHINGLE}, array(), transform(sequence(0, size({words}) - {SHINGLE}), i -> {what}))"


def shingle_hashes(words: str) -> Column:
    return F.expr(_each_shingle(words, "xxhash64(w0, w1, w2, w3, w4)"))


def shingle_texts(words: str) -> Column:
    return F.expr(_each_shingle(words, "concat_ws(' ', w0, w1, w2, w3, w4)"))


def fingerprint(hashes: str) -> Column:
    """Bit ``b`` is set if it is set in over half of the hashes."""
    return F.expr(f"""aggregate(sequence(0, 63), 0L, (fp, b) -> fp | shiftleft(
        if(2 * aggregate({hashes}, 0, (n, h) -> n + cast(shiftright(h, b) & 1L as int)) > size({hashes}), 1L, 0L), b))""")


def prepared_items(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, words, n, need, hashes, fp)``: items of five words or more;
    ``n`` shingles, of which a window must share ``need``."""
    items = benchmark.select(F.col(item_col).alias("item_id"), words_of(F.col(text_col)).alias("words")).distinct()
    items = items.where(F.size("words") >= SHINGLE).select("*", shingle_hashes("words").alias("hashes"))
    share = 2 * SIMILARITY / (1 + SIMILARITY)
    return items.select("item_id", "words", F.size("hashes").alias("n"), F.ceil(F.size("hashes") * share - 1e-9).cast("int").alias("need"),
                        "hashes", fingerprint("hashes").alias("fp"))


def _bitmap(items: DataFrame) -> tuple[str, int]:
    """The items' shingle hashes as a bitmap of a bounded size: an array
    literal of longs, and its number of bits.  Each hash sets two bits."""
    hashes = items.select(F.explode("hashes").alias("h")).distinct()
    bits = 1 << max(12, ceil(BITMAP_PER_SHINGLE * max(1, hashes.count())).bit_length())
    bits = min(bits, BITMAP_MOST)
    probes = hashes.selectExpr(f"explode(array(h & {bits - 1}L, shiftrightunsigned(h, 32) & {bits - 1}L)) as bit")
    rows = probes.selectExpr("cast(shiftright(bit, 6) as int) as at", "shiftleft(1L, cast(bit & 63 as int)) as b").groupBy("at").agg(F.bit_or("b").alias("b")).collect()
    words = ["0"] * (bits // 64)
    for r in rows:
        words[r["at"]] = str(r["b"])
    return f"cast(split('{','.join(words)}', ',') as array<bigint>)", bits


def segments(docs: DataFrame, items: DataFrame, longest: int, id_col: str, text_col: str) -> DataFrame:
    """``(seg, doc_id, at, last, words)``: stretches of ``STRIDE + longest`` words
    that hold a shingle in the bitmap, ``at`` words into the document; ``last``
    ones end where the document ends."""
    table, bits = _bitmap(items)
    stride = max(STRIDE, longest)
    bit = lambda b: f"(shiftright({table}[cast(shiftright({b}, 6) as int)], cast({b} & 63 as int)) & 1L) = 1L"
    in_map = f"{bit(f'(h & {bits - 1}L)')} and {bit(f'(shiftrightunsigned(h, 32) & {bits - 1}L)')}"
    rows = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    # no filter on computed columns here: pushed down, it would compute them again at each use
    rows = rows.select("*", shingle_hashes("words").alias("hashes"))
    rows = rows.select("doc_id", "words", F.expr(f"filter(transform(hashes, (h, i) -> if({in_map}, i, -1)), i -> i >= 0)").alias("hits"))
    rows = rows.select("doc_id", "words", F.expr(
        f"explode(array_distinct(flatten(transform(hits, i -> array(i div {stride}, greatest(0, i - {longest}) div {stride})))))").alias("k"))
    rows = rows.select("doc_id", (F.col("k") * stride).cast("int").alias("at"),
                       F.expr(f"k * {stride} + {stride + longest} >= size(words)").alias("last"), F.expr(f"slice(words, cast(k * {stride} as int) + 1, {stride + longest})").alias("words"))
    return rows.select(F.monotonically_increasing_id().alias("seg"), "*")


def windows(segs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, start, n, part, window)``: windows with enough shingles of an
    item of ``n`` shingles.  ``part`` is 0 for windows of its length and whole
    texts, 1 for shorter ones at the end and 2 for those at the start."""
    shingles = items.select("item_id", "n", "need", F.explode(F.array_distinct("hashes")).alias("h"))
    spots = segs.select("seg", (F.col("at") == 0).alias("first"), "last", (F.size("words") - (SHINGLE - 1)).alias("size"),
                        F.posexplode(shingle_hashes("words")).alias("pos", "h"))
    found = spots.join(shingles, "h").groupBy("seg", "first", "last", "size", "item_id", "n", "need").agg(F.array_sort(F.collect_list("pos")).alias("p"))
    fewest = f"cast(ceil(n * {SIMILARITY} - 1e-9) as int)"         # a shorter window has at least that many shingles
    found = found.where(F.expr(f"size(p) >= if(first or last, {fewest}, need)"))
    # starts for which hit j is the first in the window and hit j + need - 1 lies in it, too
    upto = "get(p, j + need - 1)"
    lowest = f"greatest(0, get(p, j - 1) + 1, {upto} - n + 1)"
    whole = f"""flatten(transform(p, (x, j) -> if({upto} is not null and {lowest} <= x,
        transform(sequence({lowest}, x), s -> struct(s as s, n as m, 0 as part)), array())))"""
    # between two hits the shorter windows at an end hold equally many
    enough = f">= ceil((n + m) * {SIMILARITY / (1 + SIMILARITY)} - 1e-9)"
    shorter = lambda least, most: f"if({least} <= {most}, sequence({least}, {most}), array())"
    at_end = shorter(f"greatest(size - x, {fewest})", "least(size - coalesce(get(p, j - 1) + 1, 0), n - 1)")
    at_start = shorter(f"greatest(x + 1, {fewest})", "least(coalesce(get(p, j + 1), size), n - 1)")
    ends = f"""concat(
        if(last, flatten(transform(p, (x, j) -> transform(filter({at_end}, m -> size(p) - j {enough}),
            m -> struct(size - m as s, m as m, if(first and m = size, 0, 1) as part)))), array()),
        if(first, flatten(transform(p, (x, j) -> transform(filter({at_start}, m -> j + 1 {enough} and not (last and m = size)),
            m -> struct(0 as s, m as m, 2 as part)))), array()))"""
    found = found.selectExpr("seg", "n", f"inline(array_distinct(concat({whole}, {ends})))").distinct()
    held = found.join(segs, "seg").where(F.expr(f"s + m + {SHINGLE - 1} <= size(words)"))
    return held.select("doc_id", (F.col("at") + F.col("s")).alias("start"), "n", "part",
                       F.expr(f"array_join(slice(words, s + 1, m + {SHINGLE - 1}), ' ')").alias("window"))


def matches(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``(n, part, window, item_id, similarity, bits)`` for distinct ``(n, part, window)``:
    all items of ``n`` shingles within the radius that are similar enough."""
    flips = [sum(1 << b for b in c) for k in range(BLOCK_RADIUS + 1) for c in combinations(range(BLOCK_BITS), k)]
    block = f"shiftright(fp, b * {BLOCK_BITS}) & {(1 << BLOCK_BITS) - 1}L"
    own = texts.select("n", "part", "window", F.split("window", " ").alias("words"))
    own = own.select("*", shingle_hashes("words").alias("hashes"))
    own = materialize(own.select("n", "part", "window", "words", fingerprint("hashes").alias("fp")), "window-fingerprints")
    own = own.select("*", F.expr(f"inline(transform(sequence(0, {BLOCKS - 1}), b -> struct(b as block, {block} as value)))"))
    index = items.select("item_id", "n", F.col("fp").alias("item_fp"), F.expr(
        f"inline(flatten(transform(sequence(0, {BLOCKS - 1}), b -> transform(array({', '.join(map(str, flips))}), x -> struct(b as block, ({block}) ^ x as value)))))"))
    index = materialize(index, "item-index")      # stored, so a broadcast is decided by its own size
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    near = own.select("n", "part", "window", "fp", "block", "value").join(index, ["n", "block", "value"]).where(bits <= RADIUS)
    near = near.select("n", "part", "window", "item_id", bits.alias("bits")).distinct()
    near = near.join(items.select("item_id", F.col("words").alias("item_words")), "item_id").withColumn("words", F.split("window", " "))
    near = near.select("*", shingle_texts("words").alias("x"), shingle_texts("item_words").alias("y"))
    near = near.withColumn("y", F.expr("case part when 1 then slice(y, 1, size(x)) when 2 then slice(y, n - size(x) + 1, size(x)) else y end"))
    shared = F.expr("""if(size(array_distinct(x)) = size(x) and size(array_distinct(y)) = size(y), size(array_intersect(x, y)),
        aggregate(array_distinct(x), 0, (t, v) -> t + least(size(filter(x, u -> u = v)), size(filter(y, u -> u = v)))))""")
    near = near.select("n", "part", "window", "item_id", "bits", F.size("x").alias("n1"), F.col("n").alias("n2"), shared.alias("shared"))
    near = near.select("n", "part", "window", "item_id", "bits", (F.col("shared") / (F.col("n1") + F.col("n2") - F.col("shared"))).alias("similarity"))
    return materialize(near, "candidates").where(F.col("similarity") >= SIMILARITY)


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, item_id, similarity, bits, start_word)``: one row per
    document and item it holds, with its most similar, first window, one of
    the item's length if there is any."""
    items = materialize(prepared_items(benchmark), "items")
    longest = items.agg(F.coalesce(F.max(F.size("words")), F.lit(0))).first()[0]
    segs = materialize(segments(docs, items, longest, id_col, text_col), "segments")
    spans = materialize(windows(segs, items), "windows")
    found = matches(spans.select("n", "part", "window").distinct(), items)
    best = spans.join(found, ["n", "part", "window"]).groupBy("doc_id", "item_id").agg(
        F.max(F.struct((F.col("part") == 0).alias("whole"), "similarity", (-F.col("start")).alias("s"), (-F.col("bits")).alias("b"))).alias("x"))
    return best.select(F.col("doc_id").alias(id_col), "item_id", "x.similarity", (-F.col("x.b")).cast("int").alias("bits"),
                       (-F.col("x.s")).cast("int").alias("start_word"))
