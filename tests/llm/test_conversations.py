"""Operator 11: costs and audits against an exhaustive search, segments against whole conversations, odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from touchline.llm import conversations as C
from touchline.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def faults(rows: list[tuple[str, str]]) -> list[str]:
    out, seen = [], set()
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def search(rows: list[tuple[str, str]]) -> tuple[int, str, str]:
    """Cost, audit and text of the best of all edits, tried one by one with up to two inserts in each gap."""
    marks = faults(rows)
    best: list = [None]

    def go(i: int, cost: int, audit: str, initials: str, lines: tuple, inserted: int) -> None:
        if best[0] and cost > best[0][0] or not re.fullmatch("(s?((ua)+u?|u)?)?", initials):
            return
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", initials) and (best[0] is None or (cost, audit) < best[0][:2]):
                best[0] = (cost, audit, "\n".join(lines))
        else:
            role, text = rows[i]
            go(i + 1, cost + 4, audit + "D", initials, lines, 0)
            if marks[i] in ("", "truncated"):
                more = 3 if marks[i] else 0
                if role:
                    go(i + 1, cost + more, audit + "K", initials + role[0], (*lines, f"{role}:{text}"), 0)
                for new in ("user", "assistant"):
                    go(i + 1, cost + more + 3, audit + "R", initials + new[0], (*lines, f"{new}:{text}"), 0)
        if inserted < 2:
            for new in ("user", "assistant"):
                go(i, cost + 3, audit + "I", initials + new[0], (*lines, f"{new}:"), inserted + 1)

    go(0, 0, "", "", (), 0)
    return best[0]


def symbols(rows: list[tuple[str, str]]) -> str:
    return "".join(chr(65 + 4 * ("sua".find(r[:1]) if r[:1] and r[:1] in "sua" else 3) + C.FAULTS.index(f)) for (r, _), f in zip(rows, faults(rows)))


def solved(text: str) -> tuple[int, str]:
    audit, state = C.edits(text, C.START, C.ENDS)
    cost = min(c + e for c, e in zip(C.matrix(text)[C.START], C.ENDS))
    return cost, audit + "I" * (C.ENDS[state] // C.INSERT)


def some_rows(rnd: random.Random, n: int) -> list[tuple[str, str]]:
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "unknown"]
    return [(rnd.choice(roles), rnd.choice(["Yes.", "No!", "cut off", "", " \n", "Why?", "so.\t", "é…"])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_costs_and_audits_by_search(seed):
    rnd = random.Random(seed)
    for _ in range(120):
        rows = some_rows(rnd, rnd.randint(0, 5))
        assert solved(symbols(rows)) == search(rows)[:2], rows


def test_long_runs_equal_row_by_row():
    rnd = random.Random(9)
    for _ in range(20):
        text = "".join(rnd.choice("ABDEFGHIJLMOP") * rnd.choice([1, 2, 63, 64, 65, 130, 300]) for _ in range(6))
        costs = [C.ENDS]
        for c in reversed(text):
            costs.append(C._before(C.power(c, 0), costs[-1]))
        out, state = [], C.START
        for c, after in zip(text, reversed(costs[:-1])):
            state = C._row(c, state, after, out)
        assert C.edits(text, C.START, C.ENDS) == ("".join(out), state)
        assert solved(text)[0] == costs[-1][C.START]


def test_a_million_equal_rows():
    audit, _ = C.edits("E" * 10**6, C.START, C.ENDS)
    # users only: answers are inserted or every second row takes the other role
    assert len(audit.replace("I", "")) == 10**6 and audit.startswith("KRKR")


def made(spark, rows):
    extra = {c: None for c in ("conv", "pos", "part", "kind", "symbol", "audit", "digest", "place", "n", "first", "c", "r", "d", "p")}
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(v).cast("string") for c, v in extra.items()}).repartition(3)


def by_definition(rows: list[tuple]) -> dict:
    out: dict = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        pairs = [r[1:] for r in mine]
        cost, audit, text = search(pairs)
        turns = [r[0] for r in mine if r[0] is not None]
        marks = faults(pairs)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(marks.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def odd_rows() -> list[tuple]:
    rnd = random.Random(4)
    rows = []
    for conv in [*range(12), None]:
        for turn in rnd.sample([None, None, 0, 1, 1, 2, 5, 9, -3], rnd.randint(1, 5)):
            role, text = some_rows(rnd, 1)[0]
            rows.append((conv, turn, rnd.choice([role, role, None]), rnd.choice([text, text, None])))
    return rows + rows[:4]


def test_report_by_definition(spark):
    rows = odd_rows()
    got = C.report(made(spark, rows)).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == by_definition(rows)
    assert len(got) == len({r[0] for r in rows})


def test_segments_give_the_same(spark):
    """A conversation cut into many segments, other ones beside it: the same answers as in one piece."""
    rnd = random.Random(11)
    rows = [(777, t, *some_rows(rnd, 1)[0]) for t in range(400) for _ in range(2)] + odd_rows()
    keep = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = made(spark, rows)
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        segments = C.plan(df.select(F.col("conv_id").alias("conv"), "turn", "role", "text").na.fill(" ")).filter("conv = 777")
        assert segments.count() > 5
        cut = {r["conv_id"]: tuple(r) for r in C.report(df).collect()}
        fixed = {r["conv_id"]: [] for r in C.repaired(df).select("conv_id").distinct().collect()}
        for r in C.repaired(df).orderBy("position").collect():
            fixed[r["conv_id"]].append(f"{r['role']}:{r['text']}")
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert cut == {r["conv_id"]: tuple(r) for r in C.report(df).collect()}
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)
    mine = sorted(([t, " " if r is None else r, x] for c, t, r, x in rows if c == 777), key=lambda r: (r[0], r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    assert cut[777][6:8] == solved(symbols([(r, x) for _, r, x in mine]))
    assert {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in fixed.items()} == {c: r[8] for c, r in cut.items() if r[8] != EMPTY}


def test_damage_by_definition(spark):
    source = table(spark, SF, "conversations")
    want = []
    for r in source.collect():
        hit = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", r["text"])}.get(hit, r["text"])
        want += [(r["conv_id"], r["turn"], "user" if hit == 4 else r["role"], text)] * {0: 0, 3: 2}.get(hit, 1)
    assert sorted(map(tuple, C.damaged(source).collect())) == sorted(want)


def test_dropped_conversations_and_no_rows(spark):
    ids = made(spark, [(1, 0, "user", "A."), (2, 0, "user", "B."), (None, None, None, None)])
    got = {r["conv_id"]: tuple(r)[1:] for r in C.report(ids.filter("conv_id = 1"), ids).collect()}
    none = (0, 0, 0, 0, 0, 0, "", EMPTY)
    assert got == {1: (0, 0, 0, 0, 0, 3, "KI", hashlib.sha256(b"user:A.\nassistant:").hexdigest()), 2: none, None: none}
    assert C.report(ids.filter("false")).collect() == [] and C.repaired(ids.filter("false")).collect() == []
