"""Operator 13, quality rules as a ledger of failure bits.

One pass measures every text and evaluates every rule once. The ledger keeps,
a row per document, the measurements and one bit per failed rule; it is written to
shared storage. Policies are versions of a bit mask. A verdict is one AND of the
ledger's bits with the mask, and ablations need neither texts nor rules again: they
count the ledger's distinct bit patterns (partial aggregation, at most one row per
pattern and task) and take each rule's bit out of each mask.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import by_bytes, landed, table
from touchline.llm.words import WORD, numbered, paired


class Rule(NamedTuple):
    """A rule fails where its condition over the measurements holds; conditions are exact in integers and read alike in Spark and DuckDB."""

    name: str
    fails: str


#: A rule's position is its bit: new ones go to the end, none is ever taken out or moved.
RULES = [
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("shouting", "2 * n_upper_words > n_words"),
    Rule("exclamations", "5 * n_exclaims > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines and n_dup_lines >= 3"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 12 * n_words"),
    Rule("few_letters", "5 * n_letter_words < 4 * n_words"),
    Rule("digits", "10 * n_digits > 3 * word_chars"),
    Rule("bullets", "10 * n_bullet_lines > 9 * n_lines"),
    Rule("cut_lines", "10 * n_cut_lines > 3 * n_lines"),
    Rule("endless_word", "longest_word > 2000"),
    Rule("fragments", "n_lines >= 20 and n_words < 2 * n_lines"),
]
BIT = {r.name: n for n, r in enumerate(RULES)}
BASE = ["few_words", "repeated_words"]
#: Versions of the policy, each a list of the rules that it applies. Published versions never change.
POLICIES = {
    "1": BASE,
    "2": [*BASE, "symbols", "shouting", "repeated_lines", "few_letters"],
    "3": [*BASE, "symbols", "shouting", "exclamations", "repeated_lines", "short_words", "long_words", "few_letters", "digits", "cut_lines", "endless_word", "fragments"],
}
POLICY = "3"

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words", "n_letter_words",
    "n_exclaims", "n_digits", "n_bullet_lines", "n_cut_lines", "longest_word",
]

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS, _DIGITS = b"#*$%&|<>", b"0123456789"
#: Whatever is no letter and no space; bytes of characters beyond ASCII count as letters.
_OTHER = bytes(b for b in range(128) if not chr(b).isalpha() and b not in _SPACE)
_BULLETS = tuple(x.encode() for x in "-*•")
_CUT = ("...".encode(), "…".encode())


def mask(rules: list[str]) -> int:
    """The bit mask of rules given by name."""
    return sum(1 << BIT[r] for r in rules)


def _covered(documents: list[list[bytes]]) -> np.ndarray:
    """Words of each document inside windows of three words that it holds twice or more."""
    ids, starts = numbered(documents)
    if len(ids) < 3:
        return np.zeros(len(documents), np.int64)
    # a window over a border holds the border's own number and so is unique
    windows = paired(paired(ids[:-2], ids[1:-1]), ids[2:])
    again = np.bincount(windows)[windows] > 1
    inside = np.zeros(len(ids), bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return np.add.reduceat(inside, starts[:-1], dtype=np.int64)


def _measured(texts: list[str]) -> list[list[int]]:
    rows, documents = [], []
    for text in texts:
        data = text.encode()
        words = data.split()
        lines = [x for x in data.split(b"\n") if x.strip(_SPACE)]
        bare = [x.strip(_SPACE) for x in lines]
        documents.append(words)
        rows.append([
            len(words),
            len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")),
            len(data) - len(data.translate(None, _SYMBOLS)),
            len(lines),
            len(lines) - len(set(lines)),
            0,
            sum(map(bytes.isupper, words)),
            len(data.translate(None, _OTHER).split()),
            data.count(b"!"),
            len(data) - len(data.translate(None, _DIGITS)),
            sum(x.startswith(_BULLETS) for x in bare),
            sum(x.endswith(_CUT) for x in bare),
            max(map(len, words), default=0),
        ])
    for row, covered in zip(rows, _covered(documents).tolist()):
        row[MEASURES.index("n_repeat_words")] = covered
    return rows


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: its id, every measurement, and ``failed``, a bit per failed rule.

    All measurements are longs over the whole text. Null and empty texts have
    zeros everywhere and fail only ``few_words``. Repeated rows give
    repeated rows, null ids stay null, an empty table gives none; further columns of
    ``docs`` take no part, whatever their names. ``longest_word`` counts bytes.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in by_bytes(batches, "text"):
            values = np.array(_measured(texts), np.int64).reshape(len(texts), len(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(values[:, k]) for k in range(len(MEASURES)))], names=[id_col, *MEASURES])

    measured = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        measure, f"`{id_col}` {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES)
    )
    bits = [F.when(F.expr(r.fails), F.lit(1 << n).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for n, r in enumerate(RULES)]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured.withColumn("failed", failed)


def failing(policy: str) -> Column:
    """The bits of ``failed`` that ``policy`` looks at."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("bigint"))


def sole_rule(policy: str) -> Column:
    """The name of the one rule that rejects a document, null if none or several do."""
    bits = failing(policy)
    return F.when(F.bit_count(bits) == 1, F.element_at(F.array(*(F.lit(r.name) for r in RULES)), F.log2(bits).cast("int") + 1))


def ablation(stored: DataFrame) -> DataFrame:
    """What each rule of each policy does, from a stored ledger.

    A row per policy and rule: ``documents``, ``kept`` by the whole policy, ``fails``
    of this rule, those rejected by it ``alone``, and ``kept_without`` it. An empty
    ledger gives no row.
    """
    patterns = stored.groupBy("failed").agg(F.count("*").alias("n"))
    cases = F.array(*(
        F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(mask(rules)).cast("bigint").alias("all"), F.lit(1 << BIT[r]).cast("bigint").alias("bit"))
        for p, rules in POLICIES.items() for r in rules
    ))
    n = lambda condition: F.expr(f"coalesce(sum(n) filter (where {condition}), 0L)")
    return (
        patterns.select("failed", "n", F.explode(cases).alias("c")).select("failed", "n", "c.*").groupBy("policy", "rule")
        .agg(
            F.sum("n").alias("documents"),
            n("failed & all = 0").alias("kept"),
            n("failed & bit <> 0").alias("fails"),
            n("failed & all = bit").alias("alone"),
            n("failed & all & ~bit = 0").alias("kept_without"),
        )
    )


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query of operator 13 over all of ``documents``: the stored ledger under the policy in force."""
    stored = landed(ledger(table(spark, sf_dir, "documents")), "ledger")
    return stored.select(
        "doc_id", *MEASURES, "failed",
        (F.col("failed").bitwiseAND(F.lit(mask(BASE)).cast("bigint")) != 0).alias("base_failed"),
        (failing(POLICY) == 0).alias("kept"),
        F.coalesce(sole_rule(POLICY), F.lit("")).alias("sole_rule"),
    )


def _oracle() -> str:
    bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << n} ELSE 0 END" for n, r in enumerate(RULES))
    names = "[" + ", ".join(f"'{r.name}'" for r in RULES) + "]"
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (SELECT r, regexp_extract_all(text, '{WORD}') AS ws FROM docs)),
per_word AS (
  SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars, count(*) FILTER (WHERE regexp_matches(w, '[A-Z]') AND NOT regexp_matches(w, '[a-z]')) AS n_upper_words,
    count(*) FILTER (WHERE regexp_matches(w, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]')) AS n_letter_words, max(strlen(w)) AS longest_word FROM words GROUP BY r),
lines AS (SELECT r, line, trim(line, {space}) AS bare FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '{WORD}')),
per_line AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (WHERE bare[1] IN ('-', '*', '•')) AS n_bullet_lines,
    count(*) FILTER (WHERE ends_with(bare, '...') OR ends_with(bare, '…')) AS n_cut_lines FROM lines GROUP BY r),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM (
  SELECT r, i, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE c IS NOT NULL),
per_window AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY r),
measured AS (
  SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_upper_words, 0)::BIGINT AS n_upper_words, coalesce(n_letter_words, 0)::BIGINT AS n_letter_words, len(regexp_extract_all(text, '!'))::BIGINT AS n_exclaims,
    len(regexp_extract_all(text, '[0-9]'))::BIGINT AS n_digits, coalesce(n_bullet_lines, 0)::BIGINT AS n_bullet_lines, coalesce(n_cut_lines, 0)::BIGINT AS n_cut_lines,
    coalesce(longest_word, 0)::BIGINT AS longest_word
  FROM docs d LEFT JOIN per_word USING (r) LEFT JOIN per_line USING (r) LEFT JOIN per_window USING (r)),
judged AS (SELECT *, ({bits})::BIGINT AS failed FROM measured)
SELECT *, (failed & {mask(BASE)}) <> 0 AS base_failed, (failed & {mask(POLICIES[POLICY])}) = 0 AS kept,
  CASE WHEN bit_count(failed & {mask(POLICIES[POLICY])}) = 1 THEN {names}[log2(failed & {mask(POLICIES[POLICY])})::INT + 1] ELSE '' END AS sole_rule FROM judged"""


QUERIES = {"op13_quality_rules": op13_quality_rules}
ORACLE_SQL = {"op13_quality_rules": _oracle()}
