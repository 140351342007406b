"""The registered queries of the training-data operators and their DuckDB SQL.

Each query applies one operator to its whole table, with production
parameters.  Operators without SQL (a hash, a tokenizer, a trained network or
an HTML parser that SQL lacks) are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (alignment, decontaminate, embedding_dedup, html_text, mixing, preference, quality, secrets,
                            simhash_dedup, token_rollup, toxicity, url_filter, whitening)
from ledgerline.session import ensure_checkpoint_dir, materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.learn(docs))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op7_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no rated replies: pairs come from ``preference.reply_pairs``."""
    convs = preference.conversations(_table(spark, sf_dir, "conversations"))
    return preference.format_pairs(preference.reply_pairs(convs), ["conv_id", "rejected_id"])


def op8_token_rollup(spark: SparkSession, sf_dir: str, vocabularies: str = token_rollup.VOCABULARIES) -> DataFrame:
    """Totals after three batches, the second committed twice: every document
    comes with its count; exact copies go, the smallest id stays; documents not
    in English are counted anew with the vocabulary for many languages."""
    docs = _table(spark, sf_dir, "documents")
    text, foreign = F.col("text"), ~F.coalesce(F.col("lang") == "en", F.lit(False))
    counted = materialize(docs.select(
        "doc_id", "source", "lang", foreign.alias("foreign"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("h"),
        token_rollup.token_count(spark, text, f"{vocabularies}/byte_bpe_50k.tiktoken").alias("t1"),
        token_rollup.token_count(spark, F.when(foreign, text), f"{vocabularies}/byte_bpe_multi_50k.tiktoken").alias("t2")), "token-counts")
    first = materialize(counted.groupBy("h").agg(F.min("doc_id").alias("keep")), "first-copies")
    rows = counted.join(first, "h", "left")
    copy = F.coalesce(F.col("doc_id") != F.col("keep"), F.lit(False))
    rollup = token_rollup.Rollup(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-rollup-{uuid.uuid4().hex}")
    rollup.commit(1, token_rollup.inserts(counted, "byte_bpe_50k", "t1"))
    for _ in range(2):
        rollup.commit(2, token_rollup.deletes(rows.where(copy), "byte_bpe_50k", "t1"))
    rollup.commit(3, token_rollup.revisions(rows.where(~copy & F.col("foreign")), "byte_bpe_50k", "t1", "byte_bpe_multi_50k", "t2"))
    return rollup.totals()


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.simhash_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``passages``: start:end of the significant toxic passages, comma-joined."""
    docs = _table(spark, sf_dir, "documents")
    found = toxicity.find_passages(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))
    spans = F.array_join(F.transform("passages", lambda p: F.concat_ws(":", p["start"], p["end"])), ",")
    return found.withColumn("passages", spans)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str, vocabularies: str = alignment.VOCABULARIES) -> DataFrame:
    return alignment.align_documents(_table(spark, sf_dir, "documents"), folder=vocabularies)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_html_extraction": op4_html_extraction,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_preference_format": op7_preference_format,
    "op8_token_rollup": op8_token_rollup,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_toxicity": op11_toxicity,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

# The mix by definition: documents in hash order, running sums, the document
# in which the budget ends taken if that comes nearer.
OP5_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'text:' || text, '')), 1, 15))::bigint as h
  from documents),
s0 as (select source, sum(size)::hugeint as n, row_number() over (order by source nulls last) - 1 as i from d group by source),
s as (select *, [3, 1, 2][(i % 3 + 1)::int] as w, 2 * n as cap, sum(n) over () * 1.5::double as budget from s0),
o as (select *, row_number() over (order by n::double / w, i) as k,
             coalesce(sum(cap) over (order by n::double / w, i rows between unbounded preceding and 1 preceding), 0) as used,
             sum(w) over () - coalesce(sum(w) over (order by n::double / w, i rows between unbounded preceding and 1 preceding), 0) as wl from s),
c as (select *, cap * wl * 2 <= (sum(n) over () * 3 - 2 * used) * w as capped from o),
f as (select min(k) as k from c where not capped),
t as (select c.source, c.n, case when c.capped then c.cap::double
             else (select (budget - used) from c c2, f where c2.k = f.k) * c.w / (select wl from c c2, f where c2.k = f.k) end as target from c),
e as (select *, case when n > 0 then floor(target / n)::bigint else 0 end as ep from t),
g as (select source, h, sum(size) as words from d group by source, h),
r as (select g.source, g.h, g.words, sum(g.words) over (partition by g.source order by g.h) as after_, e.target - e.ep * e.n as rest
      from g join e on g.source is not distinct from e.source),
b as (select source, min(h) as h, min_by(words, h) as words, min_by(rest - after_ + words, h) as rest from r where after_ > rest group by source),
cut as (select source, h + case when words - rest < rest then 1 else 0 end as cut from b)
select d.doc_id, d.size, e.n::bigint as source_size, e.target as target,
       (d.size * (e.ep + case when d.h < coalesce(cut.cut, 0) then 1 else 0 end))::bigint as taken
from d join e on d.source is not distinct from e.source left join cut on d.source is not distinct from cut.source
"""


def _op1_sql() -> str:
    """Base spans by position sums over pieces and matches; the models as counts
    of transitions; a run's ratio as a sum over its transitions."""
    quoted = {k: p.replace("'", "''") for k, (p, _, _) in secrets.PATTERNS.items()} | {"random": secrets.RUN}
    n = secrets.STATES
    values = " union ".join(f"select unnest(list_filter(regexp_extract_all(t, '{quoted[k]}', {g}), lambda x: len(x) >= {m})) as x from s"
                            for k, (_, g, m) in secrets.PATTERNS.items())
    found = " union all ".join(
        f"select r, {i} as k, generate_subscripts(h, 1) as i, unnest(h) as h, unnest(p[:len(h)]) as p, unnest(v) as v from ("
        f"select r, regexp_extract_all(t, '{quoted[k]}') as h, string_split_regex(t, '{quoted[k]}') as p, "
        f"regexp_extract_all(t, '{quoted[k]}', {2 if k == 'assign' else 0}) as v from d)" for i, k in enumerate(secrets.KINDS))
    least = "case k " + " ".join(f"when {i} then {secrets.PATTERNS[k][2]}" for i, k in enumerate(secrets.KINDS[:3])) + " end"
    name = "case k " + " ".join(f"when {i} then '{k}'" for i, k in enumerate(secrets.KINDS)) + " end"
    steps = f"""unnest(list_transform(range(1, len(c) + 1), lambda i: {{
        'p': case when i = 1 then 0 else position(c[i - 1] in '{secrets.ALPHABET}') end, 'q': position(c[i] in '{secrets.ALPHABET}')}}))"""
    ends = f"""unnest(list_transform(range(1, len(c) + 2), lambda i: {{'p': case when i = 1 then 0 else position(c[i - 1] in '{secrets.ALPHABET}') end,
        'q': case when i = len(c) + 1 then 0 else position(c[i] in '{secrets.ALPHABET}') end}}))"""
    at = lambda chars: ", ".join(str(secrets.ALPHABET.index(c) + 1) for c in chars)
    small, up = (lambda x: f"{x} between {at('a')} and {at('z')}"), (lambda x: f"case when {x} = 0 then 0 else {x} - {secrets.ALPHABET.index('a')} end")
    digits = f"(select unnest([{at('0123456789')}]) as d)"
    forms = f"""
  select p, q, n::double as n from pairs
  union all select {up('p')}, {up('q')}, n from pairs where (p = 0 or {small('p')}) and (q = 0 or {small('q')})
  union all select p, j, n / 4 from pairs, joints where q = 0
  union all select {up('p')}, j, n / 4 from pairs, joints where q = 0 and {small('p')}
  union all select j, q, n / 4 from pairs, joints where p = 0
  union all select j, {up('q')}, n / 4 from pairs, joints where p = 0 and {small('q')}
  union all select e.p, {up('s.q')}, e.n * s.n / greatest(1.0, (select sum(n) from pairs where p = 0 and {small('q')}))::double / 2
            from pairs e, pairs s where e.q = 0 and s.p = 0 and {small('e.p')} and {small('s.q')}
  union all select p, d, n / 200 from pairs, {digits} where q = 0 and {small('p')}
  union all select {up('p')}, d, n / 200 from pairs, {digits} where q = 0 and {small('p')}
  union all select d, 0, (select sum(n) from pairs where q = 0) / 200 from {digits}
  union all select x.d, y.d, (select sum(n) from pairs where q = 0) / 2000 from {digits} x, {digits} y
  union all select r, r, (select sum(n) from pairs where q = 0) / 20 from (select unnest([{at(secrets.RULES)}]) as r)"""
    taken_out = secrets.FOUND.replace("'", "''")
    mixed = lambda x: f"""({1 - secrets.MIX}::double * case when p{x} > 0 then {x} / p{x} else alone_{x} end + {secrets.MIX}::double * alone_{x})"""
    alone = lambda x: f"({1 - secrets.MIX / 2}::double * case when n{x} > 0 then q{x} / n{x} else {1 / n}::double end + {secrets.MIX / 2 / n}::double)"
    listed = lambda which: f"coalesce(string_agg({name} || ':' || a || ':' || b, ',' order by a, k){which}, '')"
    return f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, md5(coalesce(cast(doc_id as varchar), text, '')) as h from documents),
s as (select t from d where h <= (select max(h) from (select h from d order by h limit {secrets.SAMPLE_DOCS}))),
samples as (select x from ({values})
            union all select to_base64(unhex(sha256(x))) from (select distinct unnest(string_split_regex(t, '[\\x20\\x09-\\x0D]+')) as x from s)),
chance as (select z.p as p, z.q as q, count(*) as a from (select {ends} as z from (select string_split(x, '') as c from samples where x <> '')) group by all),
words as (select x, count(*) as k from (select unnest(regexp_extract_all(regexp_replace(t, '{taken_out}', ' ', 'g'), '{secrets.TOKEN}')) as x from d) group by x),
pairs as (select z.p as p, z.q as q, sum(k)::double as n from (select k, {ends} as z from (select k, string_split(x, '') as c from words)) group by all),
joints as (select unnest([{at(secrets.JOINTS)}]) as j),
usual as (select p, q, sum(n) as b from ({forms}) group by p, q),
cells as (select p, q, coalesce(a, 0)::double as a, coalesce(b, 0)::double as b
  from (select p, q from (select unnest(range({n})) as p) x, (select unnest(range({n})) as q) y) g left join chance using (p, q) left join usual using (p, q)),
sums as (select *, sum(a) over (partition by p) as pa, sum(b) over (partition by p) as pb, sum(a) over (partition by q) as qa, sum(b) over (partition by q) as qb,
                sum(a) over () as na, sum(b) over () as nb from cells),
singles as (select *, {alone('a')} as alone_a, {alone('b')} as alone_b from sums),
model as (select p, q, round(1000 * ln({mixed('a')} / {mixed('b')}))::bigint as ratio from singles),
found as ({found}),
placed as (select *, (sum(len(p)) over o + coalesce(sum(len(h)) over (partition by r, k order by i rows between unbounded preceding and 1 preceding), 0))::bigint as a
           from found window o as (partition by r, k order by i)),
base as (select r, k, a, a + len(h) as b from placed where len(v) >= {least}),
scores as (select r, i, sum(ratio) as total from (select r, i, {steps} as z from (select r, i, string_split(h, '') as c from placed where k = 3)) join model on p = z.p and q = z.q group by all),
runs as (select x.r, x.k, x.a, x.a + len(x.h) as b from placed x join scores y using (r, i) where x.k = 3 and total >= {secrets.MIN_RATIO} * len(x.h)),
spans as (from base union all select * from runs where not exists (select 1 from base where base.r = runs.r and base.a < runs.b and runs.a < base.b))
select doc_id, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access, count(*) filter (k = 2) as n_hex, count(*) filter (k = 3) as n_random,
  sha256({listed(' filter (k < 3)')}) as base_sha256, {listed('')} as spans
from d left join spans using (r) group by r, doc_id"""


def _op10_sql() -> str:
    low = f"translate(coalesce(url, ''), '{url_filter._UPPER}', '{url_filter._LOWER}')"
    hit = lambda t: f"regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::int"
    strict = " + ".join(hit(t) for t, w in url_filter.VOCABULARY.items() if w >= url_filter.STRICT)
    soft = " + ".join(hit(t) for t, w in url_filter.VOCABULARY.items() if w < url_filter.STRICT)
    weight = " + ".join(f"{w}::double * {hit(t)}" for t, w in url_filter.VOCABULARY.items())
    fits = lambda h, p: f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')"
    return f"""
with u as (select page_id, {low} as low, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest from pages),
p as (select page_id, low, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{url_filter._UPPER}', '{url_filter._LOWER}') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, {strict} as strict_hits, {soft} as soft_hits, {weight} as weight from u),
r as (select *, case when {fits('example.net', '/en/')} then 'example.net/en/'
                     when {fits('example.com', '/de/')} then 'example.com/de/'
                     when {fits('org', '/fr/')} then 'org/fr/'
                     when {fits('net', '/')} then 'net/' end as rule from p)
select page_id, host, path, rule,
       case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block'
            when strict_hits > 0 or soft_hits >= {url_filter.SOFT_LIMIT} then 'block' else 'allow' end as verdict,
       strict_hits, soft_hits, round(weight, 6) as hit_weight
from r"""


# Turn by turn: both sides share the turns before the one where they part, and that
# one too if both replies are equal.
OP7_SQL = r"""
with t as (select distinct conv_id, turn, role, text from conversations where conv_id is not null),
n as (select *, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as pos from t),
a as (select conv_id, pos, text, row_number() over (partition by conv_id order by pos) - 1 as k, count(*) over (partition by conv_id) as m from n where role = 'assistant'),
e as (select conv_id, max(pos) as last, max_by(text, pos) as reply,
             max(pos) filter (k = conv_id // 2 % m) as parts, max_by(text, pos) filter (k = conv_id // 2 % m) as own from a group by conv_id),
p as (select x.conv_id, y.conv_id as rejected_id, x.last, y.reply,
             case when y.conv_id is null then 0 when coalesce(x.own, '') = coalesce(y.reply, '') then x.parts else x.parts - 1 end as same,
             y.conv_id is not null and coalesce(x.own, '') <> coalesce(y.reply, '') as differs
      from e x left join e y on y.conv_id = xor(x.conv_id, 1)),
r as (select p.*, n.pos, n.role, replace(coalesce(n.role, ''), '<|', '< |') as ro, replace(coalesce(n.text, ''), '<|', '< |') as tx from p join n on n.conv_id = p.conv_id and n.pos <= p.last),
w as (select *, '<|' || ro || '|>' || chr(10) || tx || '<|end|>' || chr(10) as whole from r),
o as (select *, sum(case when pos > same then length(whole) else 0 end) over (partition by conv_id order by pos) as upto from w)
select conv_id, rejected_id, same::int as prompt_turns, coalesce(string_agg(whole, '' order by pos) filter (pos <= same), '') as prompt,
       coalesce(string_agg(whole, '' order by pos) filter (pos > same), '') as chosen,
       case when any_value(differs) then '<|assistant|>' || chr(10) || any_value(replace(coalesce(reply, ''), '<|', '< |')) || '<|end|>' || chr(10) else '' end as rejected,
       coalesce(string_agg((upto - length(whole) + 5 + length(ro))::bigint || ':' || (upto - 1)::bigint, ',' order by pos) filter (pos > same and role = 'assistant'), '') as chosen_mask,
       case when any_value(differs) then '14:' || (14 + length(any_value(replace(coalesce(reply, ''), '<|', '< |'))) + 7) else '' end as rejected_mask
from o group by conv_id, rejected_id, same
"""

ORACLE_SQL: dict[str, str] = {"op1_secret_scan": _op1_sql(), "op5_mixing": OP5_SQL, "op7_preference_format": OP7_SQL, "op10_url_filter": _op10_sql()}
