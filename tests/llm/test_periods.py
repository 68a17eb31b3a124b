"""Operator 12: runs against a search by definition, and rows of odd texts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from cases import ODD, make_docs, sf  # noqa: F401

from touchline.llm import periods


def by_definition(words: list) -> list[tuple[int, int, int]]:
    """All runs, each lag and each stretch by itself."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(words: list, runs: list) -> list:
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def some_words(rnd: random.Random) -> list[bytes]:
    letters = [b"%d" % x for x in range(rnd.choice([1, 2, 3, 50]))]
    words: list[bytes] = []
    for _ in range(rnd.randint(0, 4)):
        if rnd.random() < 0.6:
            unit = [rnd.choice(letters) for _ in range(rnd.choice([1, 2, 5, 15, 16, 17, 24, 31, 32, 33, 50, 64, 65, 100]))]
            words += (unit * 7)[: int(len(unit) * rnd.uniform(2, 6))]
        else:
            words += [rnd.choice(letters) for _ in range(rnd.randint(0, 200))]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_by_definition(seed):
    rnd, seen = random.Random(seed), 0
    for _ in range(40):
        documents = [some_words(rnd) for _ in range(rnd.randint(1, 8))]
        for words, found in zip(documents, periods.runs(documents)):
            want = by_definition(words)
            seen += len(want)
            assert found == want
            assert periods.collapsed(words, found) == kept_words(words, want)
    assert seen > 100


@pytest.mark.parametrize("period", [1, 7, 15, 16, 17, 31, 32, 33, 63, 64, 65, 127, 128, 129, 1000, 4096])
def test_each_scale_finds_its_periods(period):
    rnd = random.Random(period)
    unit = [b"%d" % rnd.randint(0, 10**6) for _ in range(period)]
    length = max(6, 4 * period)
    tail = [b"other%d" % i for i in range(50)]
    whole = tail + (unit * 7)[:length] + tail
    short = tail + (unit * 7)[: length - 1] + tail
    assert periods.runs([whole, short, whole]) == [[(50, length, period)], [], [(50, length, period)]]


def test_powers_of_a_unit_count_once_with_their_smallest_period():
    unit = [b"%d" % i for i in range(20)]
    assert periods.runs([unit * 40]) == [[(0, 800, 20)]]
    assert periods.runs([[b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 4, [b"a", b"b"] * 3]) == [[], [(0, 6, 1)], [(0, 8, 2)], []]


def test_borders_separate_documents():
    assert periods.runs([[b"a"] * 4, [b"a"] * 4, []]) == [[], [], []]


def test_rows_of_odd_texts(make_docs):
    texts = [*ODD, "a b " * 5 + "c", "x\x1cx " * 9, ("u v w x y z " * 30).strip()]
    rows = {r["doc_id"]: r for r in periods.find_runs(make_docs(enumerate(texts))).collect()}
    assert len(rows) == len(texts)
    for n, text in enumerate(texts):
        words = re.findall(periods.WORD, text or "")
        runs = by_definition(words) if len(words) < 2000 else [(0, len(words), 1)]
        assert rows[n]["n_words"] == len(words)
        assert [tuple(r) for r in rows[n]["runs"]] == runs, repr(text)[:80]
        assert rows[n]["collapsed"] == " ".join(kept_words(words, runs) if len(words) < 2000 else words[:1])


def planted(doc_id, text: str | None) -> list[str]:
    """The contract's change of a text's words."""
    words = re.findall(periods.WORD, text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words or doc_id is None:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_digest_by_definition(make_docs):
    rnd = random.Random(2)
    rows = [(i, " \n".join(f"w{rnd.randint(0, 30)}" for _ in range(rnd.randint(0, 300)))) for i in range(120)]
    rows += [(None, "a b c " * 8), (500, None), (501, ""), (7, rows[7][1])]
    got = periods.digest(periods.find_runs(periods.planted(make_docs(rows)))).collect()
    assert len(got) == len(rows)
    want = []
    for doc_id, text in rows:
        words = planted(doc_id, text)
        runs = by_definition(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(kept_words(words, runs))
        want.append((doc_id, len(words), len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(r["n_runs"] > 0 for r in got) > 5


def test_no_rows(make_docs):
    assert periods.digest(periods.find_runs(periods.planted(make_docs([(1, "a")]).filter("false")))).collect() == []
