"""Operator 9 against brute force; its parts; components."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from cases import ODD, make_docs  # noqa: F401
from pyspark.sql import functions as F
from touchline.llm import near_dups
from touchline.llm.common import components


def _set(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def _texts():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 7)))
    out = []
    for _ in range(12):
        base = [word() for _ in range(r.choice([8, 40, 150]))]
        for _ in range(r.choice([1, 3, 25])):
            copy = list(base)
            for _ in range(r.choice([0, 1, 3, 8])):
                copy[r.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    return out + out[:15] + [out[0].upper(), "  " + out[1].replace(" ", "\n\t")]


@pytest.mark.parametrize("words,rounds,crowd", [(2, None, 64), (5, None, 64), (2, 0, 64), (2, 0, 1), (5, 0, 1), (2, None, 2)])
def test_links(spark, make_docs, monkeypatch, words, rounds, crowd):  # noqa: F811
    monkeypatch.setattr(near_dups, "CROWD", crowd)
    if rounds == 0:  # the exact round alone
        monkeypatch.setattr(near_dups, "CENTERS", ())
    rows = [*enumerate(_texts() + ODD), (3, _texts()[3]), (3, _texts()[3]), (None, _texts()[0]), (None, None)]
    got = near_dups.link(make_docs(rows), words=words).collect()
    assert len(got) == len(rows)
    sets = [(i, _set(t, words)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    count = dict(sets)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            root = find(r["doc_id"])
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(count[r["doc_id"]]), root, root == r["doc_id"])


def test_boilerplate_makes_few_pairs(spark, monkeypatch):
    """Thousands of texts that share 60 percent of their words and no link: the rows of the last round stay linear."""
    r = np.random.RandomState(3)
    boiler = " ".join(f"b{i}" for i in range(300))
    n = 3000
    texts = [boiler + " " + " ".join(f"own{i}x{k}" for k in range(100)) + " " + " ".join(f"c{x}" for x in r.randint(0, 500, 10)) for i in range(n)]
    texts += [texts[i] + " tail" for i in range(50)]  # and some links among them
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    sketches = texts.mapInArrow(near_dups._sketch(2), "id bigint, n bigint, mark binary, left array<bigint>, right array<bigint>, odd array<bigint>").withColumnRenamed("id", "rep")
    pairs = near_dups._rare_pairs(texts, sketches, spark.createDataFrame([], "rep bigint, component bigint"), 2, 80).count()
    assert 50 <= pairs <= 4 * n
    monkeypatch.setattr(near_dups, "CROWD", 64)
    got = {x["doc_id"]: x["component_id"] for x in near_dups.link(docs, words=2).collect()}
    assert got == {i: i if i < n else i - n for i in range(n + 50)}


def test_exact_round_follows_when_it_meets_few(spark, make_docs, monkeypatch):  # noqa: F811
    """Few pairs left after the first centers are not worth another round of them; with it the result is the same."""
    rounds = []
    verified = near_dups._verified
    monkeypatch.setattr(near_dups, "_verified", lambda *a: rounds.append(1) or verified(*a))
    docs = make_docs(list(enumerate(_texts())))
    got = {}
    for easy in (16, -1):
        monkeypatch.setattr(near_dups, "EASY", easy, raising=False)
        rounds.clear()
        rows = sorted(map(tuple, near_dups.link(docs, words=2).collect()))
        got[easy] = len(rounds), rows
    (few, a), (many, b) = got.values()
    assert (few, many) == (2, 3) and a == b


def test_members_are_looked_up_once(spark, make_docs, monkeypatch):  # noqa: F811
    """However many rounds there are, a bucket member passes one semi-join at most: that of the exact round, not one for the new centers."""
    seen = []
    landed = near_dups.landed
    monkeypatch.setattr(near_dups, "landed", lambda df, name: seen.append((name, df)) or landed(df, name))
    rows = {}
    for easy in (-1, 1 << 60):  # with the second round, and without it
        monkeypatch.setattr(near_dups, "EASY", easy)
        seen.clear()
        got = sorted(map(tuple, near_dups.link(make_docs(list(enumerate(_texts()))), words=2).collect()))
        members = next(df for name, df in seen if name == "members").count()
        made = 0
        for plan in (df._jdf.queryExecution().optimizedPlan() for name, df in seen if name == "pairs"):
            for k in range(5000):
                if (node := plan.apply(k)) is None:
                    break
                if node.nodeName() == "Join" and "LeftSemi, (key#" in node.simpleString(10000):
                    made += spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, node).count()
        rows[easy] = got, made
        assert 0 < made <= members
    assert rows[-1][0] == rows[1 << 60][0]


def test_copies_make_few_pairs_with_others(spark, monkeypatch):
    """Even without the odd sketches texts of one component don't meet each other, nor texts whose common shingles begin too late."""
    monkeypatch.setattr(near_dups, "_may_link", lambda *a: F.lit(True))
    r = random.Random(9)
    base = [f"b{k}" for k in range(200)]
    texts = []
    for _ in range(150):  # near copies, one component
        copy = list(base)
        for _ in range(4):
            copy[r.randrange(200)] = f"x{r.random()}"
        texts.append(" ".join(copy))
    texts += [" ".join(base[:172] + [f"o{i}x{k}" for k in range(28)]) for i in range(40)]  # about 70 percent, no links
    texts += [" ".join(base[:190] + [f"l{i}x{k}" for k in range(5)]) for i in range(3)]  # and some links
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(4)
    sketches = docs.mapInArrow(near_dups._sketch(2), "id bigint, n bigint, mark binary, left array<bigint>, right array<bigint>, odd array<bigint>").withColumnRenamed("id", "rep")
    found = spark.createDataFrame([(i, 0) for i in range(150)], "rep bigint, component bigint")
    got = {(x["a"], x["b"]) for x in near_dups._rare_pairs(docs, sketches, found, 2, 80).collect()}
    sets = [_set(t, 2) for t in texts]
    links = {(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if j >= 150 and 100 * len(a & b) >= 80 * len(a | b)}
    assert links and links <= got
    assert not any(a < 150 and b < 150 for a, b in got)
    assert len(got - links) <= 40


def test_empty(spark, make_docs):  # noqa: F811
    assert near_dups.link(make_docs([])).count() == 0


def test_odd_sketches_bound_the_difference():
    r = np.random.RandomState(0)
    for _ in range(200):
        pool = r.randint(0, 1 << 62, 400).astype(np.uint64)
        a, b = (np.unique(r.choice(pool, r.randint(1, 400))) for _ in "ab")
        cells = sum(bin(int(x) & (2**64 - 1)).count("1") for x in near_dups._odd(a) ^ near_dups._odd(b))
        assert cells <= len(np.setxor1d(a, b))


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(200, 260)] + [(r.randrange(300, 500), r.randrange(300, 500)) for _ in range(120)] + [(7, 7), (259, 258)]
    up = {n: n for e in edges for n in e}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        p, q = find(a), find(b)
        up[max(p, q)] = min(p, q)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).filter(F.lit(True)).count() == 0


def test_keys_are_spread_over_tasks(spark, make_docs, monkeypatch):  # noqa: F811
    """Sets of one small file: their many keys are grouped by as many tasks as a shuffle has partitions, the same rows in both uses."""
    seen = {}
    landed = near_dups.landed

    def kept(df, name):
        seen.setdefault(name, df)
        return landed(df, name)

    monkeypatch.setattr(near_dups, "landed", kept)
    rows = [(i, f"w{i} of a few words that all texts have") for i in range(200)]
    near_dups.link(make_docs(rows), words=2).collect()
    plan = seen["members"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2
    tables = np.prod([s for _, s in near_dups.COLLECTIONS])
    sets = landed(seen["sets"].coalesce(1), "sets")
    keys = near_dups._keys(sets).select("rep", "key", F.spark_partition_id().alias("task"))
    tasks = keys.groupBy("task").count().collect()
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(r["count"] for r in tasks) == len(rows) * tables and max(r["count"] for r in tasks) < len(rows) * tables / 2
