"""Two tokenizers side by side: which tokens of one cover which of the other.

1. ``distinct_texts`` shuffles by the full text and counts its copies (map-side
   first), so that a text is tokenised once however often it comes.
2. ``align`` encodes each distinct text with both tokenizers (A a byte-level BPE
   file, B a sentencepiece file) and cuts the tokens into groups at the byte
   offsets where tokens of both end.  All A-B occurrence pairs of a group are
   links.  A text's id pairs are kept with their numbers of links, so a long group
   costs its distinct ids, not its square.
   A's ids come from the file's vocabulary by its merge order, which is its order
   of ids (checked); a file that has another order is encoded by its own library.
3. ``pair_counts``: how many documents hold an id pair, copies counted, and whether
   that is the highest of the pair's A id.
4. ``measure`` brings the counts back to the texts.  Pairs in at least one of
   ``PAIRS`` of all (text, pair) rows are at most ``PAIRS`` pairs: they are broadcast.
   The others, none of which can be hot, meet by a shuffle on the pair.
5. ``align_documents`` joins measures to ids by the text's SHA-256, texts with at
   least one of ``TEXTS`` of all documents by a broadcast in the same way.

The tokenizers' paths are parameters; the driver reads the files (below 2 MB
each) and sends them to the tasks.

A null or empty text, and one whose A or B token bytes are not its own with a
space before it (a literal U+2581, say), has no tokens: zeros and an empty digest.
Repeated rows of a document are documents of their own; null ids are kept.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe
from ledgerline.session import materialize

VOCABULARIES = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
PAIRS, TEXTS = 100_000, 10_000
PACK = 1 << 31             # an id pair as one long: A id * PACK + B id
WIDE_GROUP = 256           # links of a group from which distinct ids are counted first
CHUNK = 1 << 20            # characters encoded at once
_LOADED: dict[str, "Tokenizers"] = {}


def byte_alphabet() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable Latin-1 as itself, the others in order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers with the bytes of every token."""

    def __init__(self, file_a: bytes, file_b: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"        # Spark's tasks are the parallelism
        import sentencepiece
        import tokenizers
        self.a = tokenizers.Tokenizer.from_str(file_a.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        letters = byte_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters.get(c, 0) for c in entry)
        self.ranked = self._ranked(file_a, letters)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.size_a, self.size_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        # ids written with what follows them: another of the same side, the other side, the next group
        ids = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.width = len(ids)
        self.written = [i + end for end in (",", "|", ";") for i in ids]

    def _ranked(self, file_a: bytes, letters: dict[str, int]) -> bpe.tiktoken.Encoding | None:
        """A as ranks, if its ids are in the order of its merges and it cuts texts by the known pattern."""
        form = json.loads(file_a)
        ids, cut = self.a.get_vocab(with_added_tokens=False), form.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in form["model"]["merges"]]
        order = [ids["".join(m)] for m in merges]
        merged = set(order)
        whole = order == sorted(set(order)) and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
        own = {entry: i for entry, i in ids.items() if all(c in letters for c in entry) and (len(entry) == 1 or i in merged)} if whole else {}
        if form.get("normalizer") or not all(c in own and own[c] < order[0] for c in letters):
            return None
        return bpe.encoding(FILE_A, {self.bytes_a[i]: i for i in own.values()})

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        if self.ranked:
            return [bpe.encode(self.ranked, t) for t in texts]
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Both id sequences per text; None where the tokens are not the text's bytes."""
        out = []
        for t, x, y in zip(texts, self.encode_a([" " + t for t in texts]), self.b.encode(texts, num_threads=1)):
            own = (" " + t).encode("utf-8", "surrogatepass")
            same = b"".join([self.bytes_a[i] for i in x]) == own and b"".join([self.bytes_b[i] for i in y]) == own
            out.append((np.array(x, dtype=np.int64), np.array(y, dtype=np.int64)) if same else None)
        return out

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of A and of B per group."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        upto = []
        for ends, others in ((ends_a, ends_b), (ends_b, ends_a)):
            cut = np.zeros(ends[-1] + 1, dtype=bool)
            cut[others] = True
            upto.append(np.flatnonzero(cut[ends]) + 1)
        return np.diff(upto[0], prepend=0), np.diff(upto[1], prepend=0)

    def digest(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> str:
        """SHA-256 of the groups written as ``a1,a2|b1;a3|b2,b3``."""
        code = np.empty(len(a) + len(b), dtype=np.int64)
        last_a, last_b = np.cumsum(in_a), np.cumsum(in_b)
        code[np.arange(len(a)) + np.repeat(last_b - in_b, in_a)] = a
        code[np.arange(len(b)) + np.repeat(last_a, in_b)] = b
        code[last_a + last_b - in_b - 1] += self.width
        code[last_a + last_b - 1] += 2 * self.width
        return hashlib.sha256("".join([self.written[c] for c in code])[:-1].encode()).hexdigest()


def id_pairs(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked id pairs of a text and their numbers of links."""
    links = in_a * in_b
    first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    narrow = links <= WIDE_GROUP
    of = np.repeat(np.flatnonzero(narrow), links[narrow])                       # the group of each link
    nth = np.arange(len(of)) - np.repeat(np.cumsum(links[narrow]) - links[narrow], links[narrow])
    pairs = [a[first_a[of] + nth // in_b[of]] * PACK + b[first_b[of] + nth % in_b[of]]]
    times = [np.ones(len(of), dtype=np.int64)]
    for g in np.flatnonzero(~narrow):
        ua, na = np.unique(a[first_a[g]:first_a[g] + in_a[g]], return_counts=True)
        ub, nb = np.unique(b[first_b[g]:first_b[g] + in_b[g]], return_counts=True)
        pairs.append((ua[:, None] * PACK + ub).reshape(-1))
        times.append((na[:, None] * nb).reshape(-1))
    held, place = np.unique(np.concatenate(pairs), return_inverse=True)
    return held, np.bincount(place, weights=np.concatenate(times), minlength=len(held)).astype(np.int64)


def loaded(file_a: bytes, file_b: bytes) -> Tokenizers:
    """The tokenizers of two files, built once per Python worker."""
    key = hashlib.sha256(file_a + file_b).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Tokenizers(file_a, file_b)
    return _LOADED[key]


# ---------------------------------------------------------------- Spark jobs
def distinct_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(text, copies)`` of all texts that are neither null nor empty."""
    return docs.select(F.col(text_col).alias("text")).where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))


def _files(spark: SparkSession, folder: str) -> object:
    contents = []
    for name in (FILE_A, FILE_B):
        with open(os.path.join(folder, name), "rb") as f:
            contents.append(f.read())
    return spark.sparkContext.broadcast(tuple(contents))


ALIGNED = ("key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<long>")


def align(texts: DataFrame, folder: str = VOCABULARIES) -> DataFrame:
    """Each distinct text's tokens, groups and id pairs; texts without tokens are left out."""
    files = _files(texts.sparkSession, folder)

    def one(both: Tokenizers, text: str, copies: int, ids: tuple) -> tuple:
        a, b = ids
        in_a, in_b = both.groups(a, b)
        held, times = id_pairs(a, b, in_a, in_b)
        return (hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), copies, len(a), len(b), len(in_a),
                int(in_a @ in_b), both.digest(a, b, in_a, in_b), held, times)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = loaded(*files.value)
        names = [c.split()[0] for c in ALIGNED.split(", ")]
        for batch in batches:
            size = batch["text"].str.len().cumsum()
            for _, part in batch.groupby(size // CHUNK):
                found = zip(part["text"], part["copies"], both.encode(part["text"].tolist()))
                yield pd.DataFrame([one(both, t, n, ids) for t, n, ids in found if ids], columns=names)

    return texts.mapInPandas(encode, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, count, texts, best)``: documents and distinct texts that hold an id
    pair, and whether ``count`` is the highest of its A id (ties included)."""
    pairs = (aligned.select("copies", F.explode("pairs").alias("pair")).groupBy("pair")
             .agg(F.sum("copies").alias("count"), F.count(F.lit(1)).alias("texts")))
    pairs = materialize(pairs, "pair-counts")
    a = F.shiftright("pair", 31)
    top = pairs.groupBy(a.alias("a")).agg(F.max("count").alias("top"))
    return pairs.join(top, a == F.col("a")).select("pair", "count", "texts", (F.col("count") == F.col("top")).alias("best"))


def measure(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``(key, n_best, count_sum)`` of every aligned text."""
    links = aligned.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("key", "l.pairs", "l.times")
    total = counts.agg(F.sum("texts")).first()[0] or 0
    hot = F.col("texts") * PAIRS >= total
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")]
    few = F.broadcast(counts.where(hot).select("pair", "count", "best"))
    met = links.join(few, links["pairs"] == few["pair"], "left")
    parts = met.where("pair is not null").groupBy("key").agg(*sums)
    rest = met.where("pair is null").select("key", "pairs", "times")
    others = counts.where(~hot).select("pair", "count", "best")
    parts = parts.unionByName(rest.join(others, rest["pairs"] == others["pair"]).groupBy("key").agg(*sums))
    return parts.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = VOCABULARIES) -> DataFrame:
    """``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row."""
    aligned = materialize(align(distinct_texts(docs, text_col), folder), "aligned")
    counts = materialize(pair_counts(aligned), "pair-table")
    texts = aligned.select("key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    texts = materialize(texts.join(measure(aligned, counts), "key"), "measures")
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(F.when(F.col(text_col) != "", F.col(text_col)), 256)).alias("k"))
    total = texts.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") * TEXTS >= total
    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    value = F.struct("groups_sha256", *sums)
    few = F.broadcast(texts.where(hot).select("key", value.alias("few")))
    met = rows.join(few, rows["k"] == few["key"], "left").select("id", "k", "few")
    # rows that need no other text get a key of their own, so that they spread over the reducers
    spread = F.unhex(F.md5(F.monotonically_increasing_id().cast("string")))
    met = met.withColumn("k", F.when(F.col("few").isNull() & F.col("k").isNotNull(), F.col("k")).otherwise(spread))
    others = texts.where(~hot).select("key", value.alias("others"))
    v = F.coalesce("few", "others")
    return met.join(others, met["k"] == others["key"], "left").select(
        F.col("id").alias(id_col), *[F.coalesce(v[c], F.lit(0).cast("long")).alias(c) for c in sums],
        F.coalesce(v["groups_sha256"], F.lit("")).alias("groups_sha256"))

