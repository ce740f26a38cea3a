"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text; the ledger keeps the measurements and one failure bit a rule. Policies are
versioned masks over those bits, so that a verdict, another policy's verdict or an ablation never reads a text again.

Defined results: null, empty and blank texts have no words and all measures zero (they fail ``too_few_words``); repeated
rows give repeated ledger rows; an empty table gives an empty ledger; other columns, whatever their names, are not read.
A text of any length is measured as a whole, inside its own row: no shuffle, so hot sources or copies can't skew it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, table, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: name -> failing condition over the measurements; the position is the bit.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 20",
    "too_repetitive": "100 * n_repeat_words > 30 * n_words",
    "symbol_heavy": "100 * n_symbols > 30 * n_words",
    "duplicate_lines": "n_dup_lines > 3 AND 100 * n_dup_lines > 30 * n_lines",
    "odd_word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
    "shouting": "100 * n_bangs > 40 * n_words",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
#: Versioned policies: the rules whose failure removes a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "too_repetitive"),
    "v1": ("too_few_words", "too_repetitive", "symbol_heavy", "duplicate_lines"),
    "v2": tuple(RULES),
}


def mask(policy: str) -> int:
    return sum(BITS[rule] for rule in POLICIES[policy])


def _repeat_words(w: str) -> str:
    """SQL for the number of words inside windows that occur twice or more in the array ``w``.

    transform(array(x), v -> ...)[0] binds x once: a plain reference would be evaluated again for every element.
    """
    covered = (
        f"transform(array(sort_array(transform(filter(s, (e, j) -> get(s, j - 1).k = e.k OR get(s, j + 1).k = e.k), e -> e.p))), "
        f"p -> aggregate(transform(p, (x, j) -> least({WINDOW}, coalesce(get(p, j + 1) - x, {WINDOW}))), 0, (a, x) -> a + x))[0]"
    )
    by_key = f"transform(array(sort_array(transform(g, (x, i) -> struct(x AS k, i AS p)))), s -> {covered})[0]"
    return (
        f"CASE WHEN size({w}) <= {WINDOW} THEN 0 ELSE "
        f"transform(array(transform(array(transform({w}, x -> xxhash64(x))), "
        f"h -> transform(sequence(1, size(h) - {WINDOW - 1}), i -> xxhash64(slice(h, i, {WINDOW}))))[0]), "
        f"g -> CASE WHEN size(array_distinct(g)) = size(g) THEN 0 ELSE {by_key} END)[0] END"
    )


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the key and every measurement, all as long."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).alias("doc_id"), t.alias("_t"), words(F.col(text)).alias("_w"))
    lines = "filter(split(_t, '\\n'), x -> btrim(x, concat(' \\t', char(10), char(11), char(12), char(13))) != '')"
    counted = f"transform(array({lines}), l -> struct(size(l) AS n, size(l) - size(array_distinct(l)) AS d))[0]"
    rows = base.select(
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", BLANKS, "")).cast("long").alias("word_chars"),
        _removed(F.col("_t"), SYMBOLS).cast("long").alias("n_symbols"),
        _removed(F.col("_t"), "!").cast("long").alias("n_bangs"),
        F.expr(counted).alias("_l"),
        F.expr(_repeat_words("_w")).cast("long").alias("n_repeat_words"),
    )
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", F.col("_l.d").cast("long").alias("n_dup_lines"), "n_repeat_words",
        F.col("_l.n").cast("long").alias("n_lines"), "n_bangs",
    )


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The measurements and ``failures``, a bitmask with one bit for each failed rule."""
    bits = [F.when(F.expr(rule), F.lit(BITS[name])).otherwise(F.lit(0)) for name, rule in RULES.items()]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(docs, key, text).withColumn("failures", total.cast("int"))


def apply_policy(led: DataFrame, policy: str = "v2") -> DataFrame:
    return led.withColumn("kept", F.col("failures").bitwiseAND(F.lit(mask(policy))) == 0)


def ablation(led: DataFrame, policy: str = "v2") -> DataFrame:
    """For each rule of a policy: rows that fail it, and rows that only it removes. One aggregation of bit tests."""
    m = mask(policy)
    hit = F.col("failures").bitwiseAND(F.lit(m))
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.bit_or("failures").alias("any_failure")]
    for rule in POLICIES[policy]:
        aggs += [F.count_if(hit.bitwiseAND(F.lit(BITS[rule])) != 0).alias(f"failed_{rule}"), F.count_if(hit == BITS[rule]).alias(f"only_{rule}")]
    wide = led.agg(*aggs)
    pairs = ", ".join(f"'{r}', {BITS[r]}, failed_{r}, only_{r}" for r in POLICIES[policy])
    return wide.select("n_rows", F.expr(f"stack({len(POLICIES[policy])}, {pairs}) AS (rule, bit, failed, failed_alone)"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = apply_policy(ledger(table(spark, sf_dir, "documents")))
    base = F.col("failures").bitwiseAND(F.lit(mask("base"))) != 0
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failures",
    )


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
g AS (
  SELECT rid, i, array_to_string(w[i:i+7], ' ') AS k
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
r AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM g),
rep AS (
  SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM r WHERE c > 1) GROUP BY rid),
l AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_bangs,
         CAST(coalesce(l.n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(l.n_lines, 0) AS BIGINT) AS n_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (rid) LEFT JOIN l USING (rid)),
f AS (
  SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (100 * n_symbols > 30 * n_words)::INT
    + 8 * (n_dup_lines > 3 AND 100 * n_dup_lines > 30 * n_lines)::INT + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT
    + 32 * (100 * n_bangs > 40 * n_words)::INT AS INT) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) != 0 AS base_failed, failures = 0 AS kept, failures
FROM f
"""
