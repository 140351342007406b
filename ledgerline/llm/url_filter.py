"""URL filter: host and path rules first, a weighted vocabulary for the rest.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the
end, with A-Z lower-cased; the path is what follows up to ``?``, ``#`` or the
end.  A null url, or one without ``://``, has both empty.  A rule
``host/path`` fits its host and all subdomains if the path starts with the
rule's; the longest rule that fits decides.

Where no rule fits, one Aho-Corasick automaton finds the terms of the
vocabulary in the whole lower-cased url.  A term counts if no letter a-z or
digit touches it on either side.  A term of weight 1 (strict) blocks alone;
soft terms block once their distinct number reaches ``soft_limit``.  A null or
empty url has no hits and is allowed.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The rules of the query, as (verdict, host/path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

# The vocabulary by weight; strict terms weigh 1, soft ones less.
STRICT = 1.0
_TERMS = {
    1.0: "porn porno xxx hentai camgirls escorts milf warez keygen malware phishing onlinecasino payday viagra cialis xanax sportsbook cardsharing",
    0.7: "adult sexy nude erotic erotica nsfw fetish hookup webcam casino casinos poker gambling gamble blackjack roulette crack cracked nulled replica counterfeit",
    0.5: "dating singles betting bet bets wager slots slot jackpot lottery bingo torrent torrents serial pills pharmacy loan loans forex",
    0.3: "cheap bonus gratis win wins winner prize prizes spins chips dealer deals discount freebies giveaway",
}
VOCABULARY: dict[str, float] = {term: weight for weight, terms in _TERMS.items() for term in terms.split()}
SOFT_LIMIT = 2
_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_TOUCHING = frozenset(string.ascii_lowercase + string.digits)


def read_vocabulary(spark: SparkSession, path: str, most: int = 1_000_000) -> dict[str, float]:
    """A vocabulary table ``(term, weight)`` at a path that Spark reads: lower-cased terms,
    the largest weight of each; rows without a term or weight are left out.  The
    automaton is built in every task, so more than ``most`` terms are an error."""
    rows = spark.read.parquet(path).select(F.lower(F.trim("term")).alias("term"), F.col("weight").cast("double").alias("weight"))
    rows = rows.where("term <> '' and weight is not null").groupBy("term").agg(F.max("weight").alias("weight")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{path}: more than {most} terms")
    return {r["term"]: r["weight"] for r in rows}


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = F.split(F.coalesce(url, F.lit("")), "://", 2)
    rest = F.when(F.size(parts) == 2, parts[1]).otherwise("")
    return (lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, name in sorted(rules, key=lambda r: len(r[1])):      # the longest is asked first
        of_host, slash, of_path = name.partition("/")
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(slash + of_path)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def term_hits(text: Column, vocabulary: Mapping[str, float]) -> Column:
    """``struct(strict, soft, weight)``: distinct terms found and their weights' sum."""
    terms = dict(vocabulary)

    @F.pandas_udf("strict int, soft int, weight double")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = ahocorasick.Automaton()
        for term in terms:
            machine.add_word(term, term)
        machine.make_automaton()

        def found(s: str | None) -> tuple[int, int, float]:
            hit = {t for end, t in machine.iter(s) if (end + 1 == len(s) or s[end + 1] not in _TOUCHING)
                   and (end < len(t) or s[end - len(t)] not in _TOUCHING)} if s and terms else ()
            strict = sum(terms[t] >= STRICT for t in hit)
            return strict, len(hit) - strict, float(sum(sorted(terms[t] for t in hit)))

        for urls in batches:
            yield pd.DataFrame([found(s) for s in urls], columns=["strict", "soft", "weight"])
    return hits(lower_ascii(text))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES,
               vocabulary: Mapping[str, float] = VOCABULARY, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """``(id_col, host, path, rule, verdict, strict_hits, soft_hits, hit_weight)``
    for every row; other columns of ``pages`` are not read."""
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = urls.select("id", host.alias("host"), path.alias("path"), term_hits(F.col("url"), vocabulary).alias("hits"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    by_terms = F.when((F.col("hits.strict") > 0) | (F.col("hits.soft") >= soft_limit), "block").otherwise("allow")
    return rows.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, by_terms).alias("verdict"),
                       F.col("hits.strict").alias("strict_hits"), F.col("hits.soft").alias("soft_hits"),
                       F.round("hits.weight", 6).alias("hit_weight"))
