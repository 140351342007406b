import random
import re
from collections import Counter

from ledgerline.llm import decontaminate as D

WORD = re.compile(r"[^\W_]+")


def words(t):
    return WORD.findall((t or "").lower())


def brute(docs, items):
    best = {}
    for d, t in docs:
        w = words(t)
        shingles = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        for i, it in items:
            iw = words(it)
            if len(iw) < 5:
                continue
            want = Counter(tuple(iw[k:k + 5]) for k in range(len(iw) - 4))
            n = sum(want.values())
            for s in range(len(shingles) - n + 1):
                got = Counter(shingles[s:s + n])
                shared = sum(min(c, got[x]) for x, c in want.items())
                if shared / (2 * n - shared) >= 0.8:
                    best[d, i] = max(best.get((d, i), 0), shared / (2 * n - shared))
    return {k: round(v, 9) for k, v in best.items()}


def corpus(seed=6):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([5, 9, 20, 40, 59])))) for i in range(12)]
    items += [(50, "a b a b a b a b a b a b"), (51, "too short"), (52, None), (53, ""), (54, items[3][1])]
    docs = []
    for d in range(60):
        w = rng.choices(vocab, k=rng.choice([0, 3, 30, 300, 700]))
        if d % 2:
            it = rng.choice(items)[1] or ""
            it = it.split()
            for _ in range(rng.randrange(3)):
                if it:
                    it[rng.choice([0, -1, len(it) // 2])] = rng.choice(vocab)
            if rng.random() < 0.3:
                it.insert(len(it) // 2, "extra")
            at = rng.randrange(len(w) + 1)
            w[at:at] = it
        sep = rng.choice([" ", ", ", "\n", " - "])
        text = sep.join(w)
        docs.append((d, text.upper() if d % 3 == 0 else text))
    docs += [(100, None), (101, ""), (102, "a b " * 200), (103, items[4][1]), (103, items[4][1]), (104, ("x " * 251) + items[3][1] + " y" * 300)]
    return docs, items


def test_matches_equal_brute_force(spark):
    docs, items = corpus()
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, item_id int, seg int")
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, words string")
    got = D.find_contamination(frame, bench).collect()
    want = brute(docs, items)
    assert len(want) > 12 and any(v < 1 for v in want.values())
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == want and len(got) == len(want)
    assert all(r.bits <= D.RADIUS for r in got)


def test_items_cut_off_by_the_ends_of_a_document(spark):
    w = ["c%d" % i for i in range(30)]
    fill = ["f%d" % i for i in range(600)]
    docs = {1: w[:-2], 2: w[2:], 3: fill + w[:-3], 4: w[3:] + fill, 5: w[1:-1], 6: fill[:255] + w[:-3],
            7: w[:-6], 8: fill[:300] + w[:-3] + fill[300:], 9: w[:-5]}
    frame = spark.createDataFrame([(d, " ".join(x)) for d, x in docs.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(w)), (2, " ".join(w[:-3])), (3, "u v w x y z")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start_word) for r in D.find_contamination(frame, bench).collect()}
    cut = {(1, 1): (24, 0), (2, 1): (24, 0), (3, 1): (23, 600), (4, 1): (23, 0), (5, 1): (24, 0), (6, 1): (23, 255), (9, 1): (21, 0)}
    want = {k: (round(n / 26, 9), at) for k, (n, at) in cut.items() if n / 26 >= 0.8}
    assert {k: v for k, v in got.items() if k[1] == 1} == want
    assert (8, 2) in got and (3, 2) in got and not any(i == 3 for _, i in got)


def test_blocks_cover_the_radius():
    """Any two codes within RADIUS bits agree to BLOCK_RADIUS bits on some block."""
    assert D.BLOCKS * D.BLOCK_BITS == 64 and D.RADIUS < D.BLOCKS * (D.BLOCK_RADIUS + 1)


def test_null_ids_and_empty_tables(spark):
    _, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(None, items[4][1]), (None, items[4][1])], "doc_id long, text string")
    assert [r.doc_id for r in D.find_contamination(docs, bench).where("item_id = 4").collect()] == [None]
    assert D.find_contamination(docs.limit(0), bench).count() == 0
    assert D.find_contamination(docs, bench.limit(0)).count() == 0


def test_windows_of_long_items_equal_brute_force(spark):
    """Long items with edits, whole, moved and cut off by either end, one with repeated shingles."""
    rng = random.Random(11)
    long = ["l%d" % rng.randrange(900) for _ in range(320)]
    round_ = ["r%d" % (k % 9) for k in range(150)]
    fill = ["f%d" % k for k in range(500)]
    edited = [w if k % 97 else "new" for k, w in enumerate(long)]
    docs = [(1, fill + edited + fill), (2, long[:-20] + fill), (3, fill + long[25:]), (4, long[:160] + ["in"] * 6 + long[160:]),
            (5, round_ * 2), (6, fill + round_[:120]), (7, long[15:-15]), (8, long[:200] + fill + long[200:])]
    bench = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(round_))], "item_id long, text string")
    frame = spark.createDataFrame([(d, " ".join(t)) for d, t in docs], "doc_id long, text string")
    items = D.materialize(D.prepared_items(bench), "items")
    segs = D.materialize(D.segments(frame, items, 320, "doc_id", "text"), "segments")
    got = {(r.doc_id, r.start, r.n, r.part, len(r.window.split()) - 4) for r in D.windows(segs, items).collect()}
    want = set()
    for d, t in docs:
        shingles = [tuple(t[k:k + 5]) for k in range(len(t) - 4)]
        for it in (long, round_):
            of = {tuple(it[k:k + 5]) for k in range(len(it) - 4)}
            n, hits = len(it) - 4, [x in of for x in shingles]
            held = lambda s, m, share: sum(hits[s:s + m]) >= share - 1e-9
            want |= {(d, s, n, 0, n) for s in range(len(hits) - n + 1) if held(s, n, n * 1.6 / 1.8)}
            for m in range(1, min(n, len(hits) + 1)):
                if m < n * 0.8 - 1e-9 or m >= n:
                    continue
                whole = m == len(hits)
                want |= {(d, s, n, 0 if whole else part, m) for s, part in ((len(hits) - m, 1), (0, 2)) if held(s, m, (n + m) * 0.8 / 1.8)}
    assert got == want and {p for _, _, _, p, _ in want} == {0, 1, 2}
    assert {(r.doc_id, r.item_id) for r in D.find_contamination(frame, bench).collect()} >= {(2, 1), (3, 1), (4, 1), (5, 2), (7, 1)}
