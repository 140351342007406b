"""Secret scan: fixed patterns, and character Markov models for the rest.

Fixed patterns, each matched leftmost and without overlaps over the whole
text; matches that are too short are dropped afterwards:

* ``assign``: a key word, ``:`` or ``=`` and a value of 6 or more characters;
* ``access``: ``AKIA`` and capitals or digits, 20 or more characters;
* ``hex``: lower-case hex digits, 24 or more.

Every other run of ``MIN_RUN`` or more token characters that overlaps none of
these is judged by two first-order Markov models over characters, one of random
strings and one of ordinary identifiers.  The sum of the log-likelihood ratios
of its transitions must reach ``MIN_RATIO`` per character for the run to count
(kind ``random``).  Ratios are held as integers, thousandths of a nat, so sums
don't depend on their order.  A shorter run carries too few transitions to tell.

The random model learns from labelled samples; the ordinary one from samples and
from every word of every document (``transitions``, one aggregation to ``STATES`` x
``STATES`` counts), fixed patterns taken out.  ``ordinary_forms`` adds what code makes
of words, from the same counts: capitals, words joined by ``_ - /`` or as in
``camelCase``, numbers behind words, and rules such as ``=====``.

Everything on this path is a DataFrame expression: matches and the pieces
between them give the positions (in code points, end exclusive), a fold over
the characters gives the ratio, and the whole scan is one pass without shuffle.

Null text counts as empty and has no spans.  Rows are judged one by one, so
null or repeated ids and extra columns change nothing.  With no
samples and no words every ratio is 0 and only the fixed patterns find anything.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
# The patterns, the group whose length counts, and that length.
PATTERNS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1                 # 0: any other character, or the start
MIN_RUN, MIN_RATIO = 20, 500
RUN = "[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN
SAMPLE_DOCS = 400                          # documents (of the smallest id hashes) that give random samples
TOKEN = "[A-Za-z0-9+/_=-]+"
# what the fixed patterns find, in one expression
FOUND = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}""")
MIX = 0.2                                  # of a transition's chance that comes from the character alone; half as much of that from 1 / STATES
JOINTS, RULES = "_-/", "=-_+/"
_SPAN = "struct<start:int,kind:int,stop:int>"


def _q(s: str) -> str:
    return "r'" + s.replace("'", "\\x27") + "'"


# ------------------------------------------------------------------ training
def labelled_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = SAMPLE_DOCS) -> DataFrame:
    """``(sample, random)``, all random, from the ``bound`` documents of the smallest
    id hashes: the values that the fixed patterns find, and the Base64 form of each
    word's SHA-256 digest."""
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit("")))
    rows = docs.select(key.alias("h"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    cut = rows.select("h").orderBy("h").limit(bound).agg(F.max("h")).first()[0]
    rows = rows.where(F.col("h") <= F.lit(cut)).select("t")
    found = [F.expr(f"filter(regexp_extract_all(t, {_q(p)}, {g}), x -> char_length(x) >= {n})") for p, g, n in PATTERNS.values()]
    values = rows.select(F.explode(F.concat(*found)).alias("sample")).distinct()
    words = rows.select(F.explode(F.split("t", r"[\x20\x09-\x0D]+")).alias("sample")).distinct()
    digests = words.select(F.base64(F.unhex(F.sha2("sample", 256))).alias("sample"))
    return values.unionByName(digests).withColumn("random", F.lit(True))


def words_of(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(sample, n)``: every distinct run of token characters outside of the fixed
    patterns, in all documents, and how often it comes."""
    rest = F.expr(f"regexp_replace(`{text_col}`, {_q(FOUND)}, ' ')")
    return docs.select(F.explode(F.regexp_extract_all(rest, F.lit(TOKEN), F.lit(0))).alias("sample")).groupBy("sample").agg(F.count(F.lit(1)).alias("n"))


Counts = dict[tuple[int, int], float]


def transitions(samples: DataFrame) -> Counts:
    """Counts of transitions between states, from and to 0 at the ends, of ``(sample, n)``."""
    chars = samples.where("sample <> ''").selectExpr("n", f"transform(filter(split(sample, ''), c -> c <> ''), c -> instr('{ALPHABET}', c)) as c")
    steps = chars.selectExpr("n", "explode(zip_with(concat(array(0), c), concat(c, array(0)), (p, q) -> struct(p, q))) as s")
    rows = steps.groupBy("s.p", "s.q").agg(F.sum("n").alias("n")).collect()              # at most STATES * STATES
    return {(r["p"], r["q"]): float(r["n"]) for r in rows}


def ordinary_forms(n: Counts) -> Counts:
    """``n`` and what code makes of its words."""
    state = ALPHABET.index
    upper = {0: 0} | {state(c) + 1: state(c.upper()) + 1 for c in ALPHABET if c.islower()}
    letters = set(upper) - {0}
    digits = [state(c) + 1 for c in "0123456789"]
    out: Counts = {}

    def add(p: int, q: int, k: float) -> None:
        out[p, q] = out.get((p, q), 0.0) + k

    starts = {q: k for (p, q), k in n.items() if p == 0}
    ends = {p: k for (p, q), k in n.items() if q == 0}
    total, small = sum(ends.values()), max(1.0, sum(k for q, k in starts.items() if q in letters))
    for (p, q), k in n.items():
        add(p, q, k)
        if p in upper and q in upper:
            add(upper[p], upper[q], k)
    for joint in (state(c) + 1 for c in JOINTS):
        for states, place in ((ends, 0), (starts, 1)):
            for x, k in states.items():
                for y in {x, upper.get(x, x)}:
                    add(*((y, joint) if place == 0 else (joint, y)), k / 4)
    for p, k in ends.items():
        for q, m in starts.items():
            if p in letters and q in letters:
                add(p, upper[q], k * m / small / 2)
        if p in letters:
            for d in digits:
                add(p, d, k / 200)
                add(upper[p], d, k / 200)
    for d in digits if total else ():
        add(d, 0, total / 200)
        for e in digits:
            add(d, e, total / 2000)
    for c in RULES if total else ():
        add(state(c) + 1, state(c) + 1, total / 20)
    return out


def _smoothed(n: Counts) -> list[float]:
    """P(cur | prev), mixed with P(cur), itself mixed with 1 / STATES."""
    of_cur, of_prev = [0.0] * STATES, [0.0] * STATES
    for (p, q), k in n.items():
        of_cur[q] += k
        of_prev[p] += k
    total = sum(of_cur)
    alone = [(1 - MIX / 2) * (k / total if total else 1 / STATES) + MIX / 2 / STATES for k in of_cur]
    return [(1 - MIX) * (n.get((p, q), 0.0) / of_prev[p] if of_prev[p] else alone[q]) + MIX * alone[q] for p in range(STATES) for q in range(STATES)]


def train(samples: DataFrame, words: DataFrame | None = None) -> list[int]:
    """The ratios ``ln P(cur | prev, random) / P(cur | prev, ordinary)`` in
    thousandths, ``STATES`` x ``STATES`` numbers, from ``(sample, random)`` and
    ordinary ``(sample, n)``."""
    random = transitions(samples.where("random").select("sample", F.lit(1).cast("long").alias("n")))
    ordinary = samples.where("not random").select("sample", F.lit(1).cast("long").alias("n"))
    ordinary = transitions(ordinary if words is None else ordinary.unionByName(words.select("sample", "n")))
    return [round(1000 * log(a / b)) for a, b in zip(_smoothed(random), _smoothed(ordinary_forms(ordinary)))]


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[int]:
    """The ratios from a corpus."""
    return train(labelled_samples(docs, id_col, text_col), words_of(docs, text_col))


# ------------------------------------------------------------------ scanning
def _located(kind: str, passes: str) -> Column:
    """Spans of one kind from the matches ``h_kind`` and the pieces between them."""
    k = KINDS.index(kind)
    start = f"a.at + char_length(p_{kind}[i])"
    stop = f"{start} + char_length(h_{kind}[i])"
    return F.expr(f"""
        if(size(h_{kind}) = 0, cast(array() as array<{_SPAN}>),
           aggregate(sequence(0, size(h_{kind}) - 1), named_struct('at', 0, 'out', cast(array() as array<{_SPAN}>)),
             (a, i) -> named_struct('at', {stop}, 'out',
               if({passes}, array_append(a.out, named_struct('start', {start}, 'kind', {k}, 'stop', {stop})), a.out)),
             a -> a.out))""")


def _ratio(s: str, model: list[int]) -> str:
    """The summed ratios of the string expression ``s``."""
    table = f"cast(split('{','.join(map(str, model))}', ',') as array<int>)"
    state = f"instr('{ALPHABET}', c)"
    return (f"aggregate(split({s}, ''), named_struct('p', 0, 'sum', 0L), (a2, c) -> if(c = '', a2, "
            f"named_struct('p', {state}, 'sum', a2.sum + {table}[a2.p * {STATES} + {state}])), a2 -> a2.sum)")


# Base spans stay; a random run goes if a base span overlaps it.  ``all`` is
# sorted, so a run waits in ``w`` until the next span shows it is free.
_MERGE = f"""
    aggregate(array_sort(concat(base, runs)),
      named_struct('out', cast(array() as array<{_SPAN}>), 'w', cast(null as {_SPAN}), 'until', 0),
      (a, s) -> if(s.kind = {len(KINDS) - 1},
        named_struct('out', if(a.w is null, a.out, array_append(a.out, a.w)), 'w', if(s.start < a.until, null, s), 'until', a.until),
        named_struct('out', array_append(if(a.w is null or s.start < a.w.stop, a.out, array_append(a.out, a.w)), s),
                     'w', cast(null as {_SPAN}), 'until', greatest(a.until, s.stop))),
      a -> if(a.w is null, a.out, array_append(a.out, a.w)))"""


def find_spans(docs: DataFrame, model: list[int], text_col: str = "text", base_col: str = "base_spans",
               spans_col: str = "spans") -> DataFrame:
    """``docs`` with two arrays of ``struct(start, kind, stop)``, sorted: the
    spans of the fixed patterns, and all spans.  ``kind`` indexes ``KINDS``."""
    own = [F.col(f"`{c}`") for c in docs.columns if c not in (base_col, spans_col)]
    row = docs.select(F.struct(*own).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    patterns = {**{k: p for k, (p, _, _) in PATTERNS.items()}, "random": RUN}
    hits = row.select("row", "t", *[F.expr(f"regexp_extract_all(t, {_q(p)}, 0)").alias(f"h_{k}") for k, p in patterns.items()])
    hits = hits.select("*", *[F.expr(f"if(size(h_{k}) = 0, array(''), split(t, {_q(p)}, -1))").alias(f"p_{k}") for k, p in patterns.items()],
                       F.expr(f"if(size(h_assign) = 0, array(''), regexp_extract_all(t, {_q(patterns['assign'])}, 2))").alias("v_assign"))
    found = hits.select(
        "row", F.array_sort(F.concat(
            _located("assign", f"size(v_assign) > i and char_length(v_assign[i]) >= {PATTERNS['assign'][2]}"),
            _located("access", f"char_length(h_access[i]) >= {PATTERNS['access'][2]}"),
            _located("hex", f"char_length(h_hex[i]) >= {PATTERNS['hex'][2]}"))).alias("base"),
        _located("random", f"{_ratio('h_random[i]', model)} >= {MIN_RATIO} * char_length(h_random[i])").alias("runs"))
    return found.select("row.*", F.col("base").alias(base_col),
                        F.expr(f"if(size(runs) = 0, base, {_MERGE})").alias(spans_col))


def span_list(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, s -> concat(array({names})[s.kind], ':', s.start, ':', s.stop)), ',')")


def scan(docs: DataFrame, model: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_assign, n_access, n_hex, n_random, base_sha256, spans)`` for every row."""
    found = find_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model)
    count = lambda of, k: F.expr(f"cast(size(filter({of}, s -> s.kind = {k})) as bigint)")
    return found.select(F.col("id").alias(id_col), *[count("base_spans", i).alias(f"n_{k}") for i, k in enumerate(KINDS[:-1])],
                        count("spans", len(KINDS) - 1).alias("n_random"),
                        F.sha2(span_list("base_spans"), 256).alias("base_sha256"), span_list("spans").alias("spans"))


def redact(docs: DataFrame, model: list[int], text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every stretch of text that spans cover replaced by ``mark``;
    texts without spans, null ones included, stay as they are."""
    base, spans = "_base_spans", "_spans"
    while {base.lower(), spans.lower()} & {c.lower() for c in docs.columns}:
        base, spans = base + "_", spans + "_"
    found = find_spans(docs, model, text_col, base, spans)
    gaps = f"""aggregate({spans}, named_struct('at', 0, 'gaps', cast(array() as array<struct<a:int,b:int>>)),
                (x, s) -> named_struct('at', greatest(x.at, s.stop), 'gaps',
                  if(s.start < x.at, x.gaps, array_append(x.gaps, named_struct('a', x.at, 'b', s.start)))),
                x -> array_append(x.gaps, named_struct('a', x.at, 'b', 2147483647)))"""
    text = f"if(size({spans}) = 0, `{text_col}`, array_join(transform({gaps}, g -> substring(`{text_col}`, g.a + 1, g.b - g.a)), '{mark}'))"
    return found.select(*[F.expr(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
