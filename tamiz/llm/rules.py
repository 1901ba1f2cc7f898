"""Quality rules kept as a ledger of failure bits.

Method: rule bitmask ledger. Every rule is judged once per document; its outcome is one bit of
`fail_bits`, next to the measurements it was judged on. A policy is a named, versioned mask: it
rejects a document if any of its bits is set, so policies are applied, changed and compared
without measuring again, and an ablation (what would a policy reject without one of its rules)
is an aggregation of the bits. Only DataFrame expressions; nothing is shuffled to judge documents.

Nulls and empty texts have no words and fail `too_short`. Repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import SPACES, texts
from tamiz.queries.base import table
from tamiz.runtime import computed_once

WINDOW = 8
SYMBOLS = "#*$%&|<>"

# Rules in the order of their bits, each over the measurements. All are false on clean prose.
RULES: dict[str, str] = {
    "too_short": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars > 14 * n_words",
    "shouting": "4 * n_shouts > n_words",
}


@dataclass(frozen=True)
class Policy:
    """The rules that reject, under a name and a version."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(rule) for rule in self.rules)


BASE = Policy("base", 1, ("too_short", "repeated_words"))
PROSE = Policy("prose", 2, tuple(RULES))
POLICIES = (BASE, Policy("prose", 1, (*BASE.rules, "symbols", "repeated_lines")), PROSE)


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """How many words lie in windows of `size` words that occur more than once in the array.

    Windows are compared by a 64-bit hash of their words. Only if some hash repeats are they
    sorted; then the starts of repeated windows, in order, each cover the words up to the
    next start, `size` at most.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(1)))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, size)))
    pairs = F.sort_array(
        F.transform(starts, lambda i: F.struct(F.xxhash64(F.slice(words, i, size)).alias("h"), i.alias("i")))
    )

    def twins(sorted_pairs: Column) -> Column:
        def same(pair: Column, at: Column) -> Column:
            return F.coalesce(pair["h"] == F.get(sorted_pairs, at)["h"], F.lit(False))

        return F.filter(sorted_pairs, lambda p, k: same(p, k - 1) | same(p, k + 1))

    # Each array is bound once by a transform over a single element: a lambda is not inlined.
    def covered(found: Column) -> Column:
        places = F.sort_array(F.transform(found, lambda p: p["i"]))
        return F.transform(
            F.array(places),
            lambda at: F.aggregate(
                F.transform(at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(size)), F.lit(size))),
                F.lit(0).cast("long"),
                lambda a, b: a + b,
            ),
        )[0]

    counted = F.transform(F.array(pairs), lambda ps: covered(twins(ps)))[0]
    some = F.transform(F.array(hashes), lambda hs: F.size(F.array_distinct(hs)) < F.size(hs))[0]
    return F.when(F.size(words) < size, F.lit(0).cast("long")).when(some, counted).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the kept columns and the measurements of every whole text."""
    text = F.col("text")
    split = texts(docs, *keep).select(
        "*",
        F.array_remove(F.split(text, SPACES), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    words, lines = F.col("_words"), F.col("_lines")
    shout = F.length(text) - F.length(F.translate(text, "!", ""))
    return split.select(
        "doc_id",
        *keep,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
        shout.cast("long").alias("n_shouts"),
    )


def ledger(docs: DataFrame, *keep: str) -> DataFrame:
    """The measurements with `fail_bits`: bit k is set if rule k fails."""
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES.values())]
    joined = bits[0]
    for bit in bits[1:]:
        joined = joined.bitwiseOR(bit)
    return measure(docs, *keep).withColumn("fail_bits", joined.cast("int"))


def passes(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0


def ablations(judged: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Per policy and rule: documents, rejected ones, those the rule fails, and those it alone
    rejects, which an otherwise equal policy without it would keep. One row per distinct
    combination of bits leaves each task."""
    combos = judged.groupBy("fail_bits").agg(F.count("*").alias("n"))
    cases = F.array(
        *[
            F.struct(
                F.lit(p.name).alias("policy"),
                F.lit(p.version).alias("version"),
                F.lit(rule).alias("rule"),
                F.lit(p.mask).alias("mask"),
                F.lit(1 << list(RULES).index(rule)).alias("bit"),
            )
            for p in policies
            for rule in p.rules
        ]
    )
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))

    def documents(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0))).cast("long")

    return (
        combos.select("fail_bits", "n", F.inline(cases))
        .groupBy("policy", "version", "rule")
        .agg(
            F.sum("n").cast("long").alias("documents"),
            documents(hit != 0).alias("rejected"),
            documents(hit.bitwiseAND(F.col("bit")) != 0).alias("failed"),
            documents(hit == F.col("bit")).alias("rejected_alone"),
        )
    )


def keep_passing(docs: DataFrame, policy: Policy = PROSE) -> DataFrame:
    """The documents that pass, with all their columns."""
    columns = docs.columns
    whole = docs.select("doc_id", "text", F.struct(*columns).alias("_whole"))
    # A border, so that the filter does not copy the rules into itself.
    judged = computed_once(ledger(whole, "_whole"), {"fail_bits": F.col("fail_bits")})
    return judged.filter(passes(policy)).select("_whole.*")


def op6_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged by all rules once; kept by the current policy."""
    return ledger(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(BASE)).alias("base_failed"),
        passes(PROSE).alias("kept"),
        "fail_bits",
    )


# The same in SQL: words are numbered, windows compared as joined words.
OP6_SQL = r"""
WITH w AS (
    SELECT rowid, doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
lines AS (
    SELECT rowid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT rowid, unnest(string_split(text, chr(10))) AS line FROM w)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rowid),
windows AS (
    SELECT rowid, i, array_to_string(list_slice(words, i, i + 7), ' ') AS piece
    FROM (SELECT rowid, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
twice AS (
    SELECT rowid, i FROM (SELECT *, count(*) OVER (PARTITION BY rowid, piece) AS n FROM windows) WHERE n > 1),
covered AS (
    SELECT rowid, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT rowid, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY rowid),
m AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           length(text) - length(replace(text, '!', '')) AS n_shouts
    FROM w LEFT JOIN lines USING (rowid) LEFT JOIN covered USING (rowid)),
f AS (
    SELECT *, ((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
               + 4 * (10 * n_symbols > n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
               + 16 * (word_chars > 14 * n_words)::INT + 32 * (4 * n_shouts > n_words)::INT)::INT AS fail_bits
    FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM f
"""
