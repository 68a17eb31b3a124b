"""Operator 13: measurements against a plain count, verdicts and ablations against brute force."""

from __future__ import annotations

import re

import pytest
from cases import ODD, make_docs, sf  # noqa: F401
from pyspark.sql import functions as F

from touchline.llm import quality
from touchline.llm.common import table

TEXTS = [
    *ODD, "a b c a b c a b", "one two three four " * 40, "SHOUT!! LOUD!! " * 40, "word### more$$$ " * 40, "- a\n- b\n* c\n• d", "cut...\nshort…\nfull.",
    "same line\nsame line\nsame line\nsame line\nother", " spaced \n spaced \n\n\n", "1234 5678 " * 40, "ü " * 60, "A I B", "x\x1cy\x85z\xa0w",
    "\n".join(f"k{i}" for i in range(60)), "plain prose of many different words " + " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)),
]


def measured(text: str | None) -> dict:
    """The measurements by definition, one at a time."""
    text = text or ""
    words = re.findall(quality.WORD, text)
    lines = [x for x in text.split("\n") if re.search(quality.WORD, x)]
    bare = [x.strip(" \t\n\x0b\x0c\r") for x in lines]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 3000 else None
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall("[#*$%&|<>]", text)), "n_lines": len(lines),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(words) if inside is None else len(inside),
        "n_upper_words": sum(bool(re.search("[A-Z]", w)) and not re.search("[a-z]", w) for w in words),
        "n_letter_words": sum(bool(re.search("[A-Za-z]|[^\x00-\x7f]", w)) for w in words), "n_exclaims": text.count("!"), "n_digits": len(re.findall("[0-9]", text)),
        "n_bullet_lines": sum(x[:1] in "-*•" for x in bare), "n_cut_lines": sum(x.endswith(("...", "…")) for x in bare), "longest_word": max((len(w.encode()) for w in words), default=0),
    }


def failed(m: dict) -> int:
    return sum(1 << n for n, r in enumerate(quality.RULES) if eval(r.fails, {}, m))


def test_measurements_by_definition(make_docs):
    rows = {r["doc_id"]: r for r in quality.ledger(make_docs(enumerate(TEXTS))).collect()}
    assert len(rows) == len(TEXTS)
    for n, text in enumerate(TEXTS):
        want = measured(text)
        assert {m: rows[n][m] for m in quality.MEASURES} == want, repr(text)[:80]
        assert rows[n]["failed"] == failed(want), repr(text)[:80]


def test_every_rule_can_fail_and_pass(make_docs):
    bits = [r["failed"] for r in quality.ledger(make_docs(enumerate([*TEXTS, "a b c d e f " + " ".join("abcdefgh") * 20, "y" * 2500, "".join(f"w{i}... \n" for i in range(9)), "longlonglongword1 " * 60]))).select("failed").collect()]
    for n, r in enumerate(quality.RULES):
        assert {bool(b >> n & 1) for b in bits} == {True, False}, r.name


def test_policies_keep_their_base_and_their_bits():
    assert all(p[: len(quality.BASE)] == quality.BASE for p in quality.POLICIES.values())
    assert all(len(set(p)) == len(p) for p in quality.POLICIES.values())
    # bits of stored ledgers keep their meaning
    assert [r.name for r in quality.RULES][:6] == ["few_words", "repeated_words", "symbols", "shouting", "exclamations", "repeated_lines"]


def test_ablation_by_brute_force(spark, sf):
    stored = quality.ledger(table(spark, sf, "documents"))
    bits = [r["failed"] for r in stored.select("failed").collect()]
    got = {(r["policy"], r["rule"]): r.asDict() for r in quality.ablation(stored).collect()}
    assert len(got) == sum(map(len, quality.POLICIES.values()))
    for (policy, rule), row in got.items():
        whole, less = quality.mask(quality.POLICIES[policy]), quality.mask([r for r in quality.POLICIES[policy] if r != rule])
        assert row["documents"] == len(bits)
        assert row["kept"] == sum(b & whole == 0 for b in bits)
        assert row["kept_without"] == sum(b & less == 0 for b in bits)
        assert row["fails"] == sum(b & quality.mask([rule]) > 0 for b in bits)
        assert row["alone"] == sum(b & whole == quality.mask([rule]) for b in bits)


def test_repeated_rows_null_ids_and_no_rows(make_docs):
    rows = quality.ledger(make_docs([(None, "a b"), (1, "a b"), (1, "a b"), (None, None)])).collect()
    assert sorted((r["doc_id"] is None, r["n_words"]) for r in rows) == [(False, 2), (False, 2), (True, 0), (True, 2)]
    empty = quality.ledger(make_docs([(1, "a")]).filter("false"))
    assert empty.collect() == [] and quality.ablation(empty).collect() == []


@pytest.mark.parametrize("policy", sorted(quality.POLICIES))
def test_clean_documents_stay(spark, sf, policy):
    # every labelled document of good quality that the fixed base rules keep; a policy may reject one in a hundred
    good = table(spark, sf, "labels").filter("quality = 1").select("doc_id")
    stored = quality.ledger(table(spark, sf, "documents")).join(good, "doc_id").filter(F.col("failed").bitwiseAND(F.lit(quality.mask(quality.BASE))) == 0)
    kept, total = stored.filter(quality.failing(policy) == 0).count(), stored.count()
    assert total and kept >= 0.99 * total
