"""Operator 11, conversation structure repair by a run-length min-plus dynamic program.

A conversation's role initials shall read ``(s?(ua)+)?``. Rows may be kept (K), given
the role user or assistant (R) or deleted (D), and empty rows of these two roles may be
inserted (I) anywhere. What a row may do depends only on its symbol: its role's initial
and its first fault. The grammar has four states, so a row is a 4x4 matrix of costs
between states, and rows in sequence are a min-plus product. Equal consecutive symbols
collapse to one run, whose product comes from cached binary powers of its symbol's
matrix. From the costs behind every run the choices are unrolled front to back, each
time the least letter that is still a cheapest one.

The product is associative, so no conversation has to fit a task: rows are sorted over
all conversations at once (range partitions, ties split by a number of the row), a
conversation's part in each partition is a segment, and a segment is summed up by its
matrix. The matrices give the costs behind each segment, every segment is unrolled by
itself for each state that it may be entered in, and following the states picks one.
Only ids, turns, digests and symbols take that way. Texts are shuffled once, to the
report, which reads a conversation's rows as a stream and holds its edits but no texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import crc32_sql, landed, table

REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: States of the grammar: nothing yet, behind s, behind u, behind a.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The state behind an inserted or re-roled row; its role is the one that the state asks for.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: A symbol is a letter from A on: four for each role initial, in this order, one for each fault.
INITIALS, FAULTS = "sua?", ("", "blank", "duplicate", "truncated")
LEGAL = ("su", "ua", "au")
FAR = 1 << 50
#: Cost of the inserts that end a conversation in each state.
ENDS = (0, 2 * INSERT, INSERT, 0)

Matrix = tuple[tuple[int, ...], ...]
_SPACE = " \t\n\x0b\x0c\r"


def _product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + b[k][j] for k, x in enumerate(row)) for j in STATES) for row in a)


def _before(a: Matrix, costs: tuple[int, ...]) -> tuple[int, ...]:
    """The costs from before ``a`` when ``costs`` hold behind it."""
    return tuple(min(x + c for x, c in zip(row, costs)) for row in a)


UNIT: Matrix = tuple(tuple(0 if i == j else FAR for j in STATES) for i in STATES)
#: Up to three inserts reach every state that inserts can reach.
INSERTS: Matrix = UNIT
for _ in range(3):
    INSERTS = _product(INSERTS, tuple(tuple(0 if i == j else INSERT if NEXT[i] == j else FAR for j in STATES) for i in STATES))


@lru_cache(maxsize=None)
def _choices(symbol: str) -> tuple[dict[int, tuple[int, int]], int | None]:
    """What an undeleted row of this symbol may do: ``(cost, state)`` of keeping by state, and the cost of a new role."""
    initial, fault = INITIALS[(ord(symbol) - 65) // 4], FAULTS[(ord(symbol) - 65) % 4]
    if fault in ("blank", "duplicate"):
        return {}, None
    cut = CUT if fault == "truncated" else 0
    keep = {s: (cut, t) for s, i, t in ((START, "s", SYSTEM), (START, "u", USER), (SYSTEM, "u", USER), (USER, "a", ASSISTANT), (ASSISTANT, "u", USER)) if i == initial}
    return keep, REROLE + cut


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> Matrix:
    """The product of ``2**k`` rows of a symbol, inserts before each of them included."""
    if k:
        return _product(power(symbol, k - 1), power(symbol, k - 1))
    keep, role = _choices(symbol)
    row = [[DELETE if i == j else FAR for j in STATES] for i in STATES]
    for i in STATES:
        if role is not None:
            row[i][NEXT[i]] = min(row[i][NEXT[i]], role)
        if i in keep:
            row[i][keep[i][1]] = min(row[i][keep[i][1]], keep[i][0])
    return _product(INSERTS, tuple(map(tuple, row)))


def _powers(symbol: str, n: int) -> Iterator[Matrix]:
    for k in range(n.bit_length()):
        if n >> k & 1:
            yield power(symbol, k)


def collapsed(symbols: str) -> list[tuple[str, int]]:
    """Symbols as runs. Blank and duplicate rows can only be deleted, whatever their role."""
    same = lambda c: c if (ord(c) - 65) % 4 in (0, 3) else "B"
    return [(c, sum(1 for _ in g)) for c, g in groupby(map(same, symbols))]


def _short(f: Callable) -> Callable:
    """``f`` with the answers for short segments kept: most conversations share theirs with others."""
    kept = lru_cache(maxsize=1 << 16)(f)

    @wraps(f)
    def ask(symbols: str, *more):
        return (kept if len(symbols) <= 64 else f)(symbols, *more)

    return ask


@_short
def matrix(symbols: str) -> Matrix:
    """The product of all rows of a segment."""
    out = UNIT
    for symbol, n in collapsed(symbols):
        for m in _powers(symbol, n):
            out = _product(out, m)
    return out


def _row(symbol: str, state: int, after: tuple[int, ...], out: list[str]) -> int:
    """Append the edits of one row and of the inserts before it; the state behind."""
    costs = _before(power(symbol, 0), after)
    keep, role = _choices(symbol)
    while True:
        if DELETE + after[state] == costs[state]:
            out.append("D")
            return state
        if INSERT + costs[NEXT[state]] == costs[state]:
            out.append("I")
            state = NEXT[state]
        elif state in keep and keep[state][0] + after[keep[state][1]] == costs[state]:
            out.append("K")
            return keep[state][1]
        else:
            out.append("R")
            return NEXT[state]


def _unrolled(symbol: str, n: int, state: int, after: tuple[int, ...], out: list[str]) -> int:
    """The same for ``n`` rows of a symbol: halves first, short stretches row by row."""
    if n > 64:
        half = n // 2
        middle = after
        for m in _powers(symbol, n - half):
            middle = _before(m, middle)
        return _unrolled(symbol, n - half, _unrolled(symbol, half, state, middle, out), after, out)
    costs = [after]
    for _ in range(n - 1):
        costs.append(_before(power(symbol, 0), costs[-1]))
    for behind in reversed(costs):
        state = _row(symbol, state, behind, out)
    return state


@_short
def edits(symbols: str, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The cheapest edits of a segment entered in ``state``, ties ASCII-least, and the state behind it."""
    runs = collapsed(symbols)
    behind = [after]
    for symbol, n in reversed(runs[1:]):
        costs = behind[-1]
        for m in _powers(symbol, n):
            costs = _before(m, costs)
        behind.append(costs)
    out: list[str] = []
    for (symbol, n), costs in zip(runs, reversed(behind)):
        state = _unrolled(symbol, n, state, costs, out)
    return "".join(out), state


def _symbol(role: Column, fault: Column) -> Column:
    initial = F.substring(role, 1, 1)
    group = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.char((F.lit(65) + 4 * group + fault).cast("bigint"))


def _ordered(rows: DataFrame) -> DataFrame:
    """``conv, pos, symbol`` of every row, written; ``pos`` rises in the order of the rows over all conversations.

    The high bits of ``pos`` are the partition that it was sorted in, so a segment's number.
    """
    bare = F.rtrim("text", F.lit(_SPACE))
    light = landed(
        rows.select(
            "conv", "turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
            F.when(bare == "", 1).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), 3).otherwise(0).alias("fault"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "rows",
    )
    order = ["conv", "turn", "role", "digest", "place"]
    # only texts that stand more than once in a conversation; the first of them is the one of the least turn
    repeated = landed(
        light.filter("fault <> 1").groupBy("conv", "role", "digest")
        .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "place")).alias("first"), F.count("*").alias("n")).filter("n > 1")
        .select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("first.place").alias("first")),
        "repeated",
    )
    known = light.join(repeated, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    fault = F.when((F.col("fault") != 1) & (F.col("place") != F.col("first")), 2).otherwise(F.col("fault"))
    marked = known.select(*order, _symbol(F.col("role"), fault).alias("symbol"))
    sorted_rows = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    return landed(sorted_rows.select("conv", F.monotonically_increasing_id().alias("pos"), "symbol"), "ordered")


def _per_row(df: DataFrame, schema: str, make: Callable[[dict], Iterator[tuple]]) -> DataFrame:
    """``df`` with its rows replaced by those that ``make`` yields for each, a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for row in batch.to_pylist() for x in make(row)]
            columns = list(zip(*found)) if found else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)
    names, types = arrow.names, arrow.types
    return df.mapInArrow(run, schema)


def plan(rows: DataFrame) -> DataFrame:
    """The edits of ``rows(conv, turn, role, text)`` as segments ``conv, part, symbols, entry, audit``, written.

    A conversation has one segment in each partition of the sorted rows that holds
    some of it; ``part`` orders them, ``entry`` is the state before one. Its audit
    covers its rows and the inserts before each; those that end the conversation are
    in its last one.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    symbols = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "symbol"))), lambda x: x["symbol"]), "")
    segments = landed(_ordered(rows).groupBy("conv", F.shiftright("pos", 33).alias("part")).agg(symbols.alias("symbols")), "segments")

    weighed = _per_row(segments, f"conv {kind}, part bigint, costs array<array<bigint>>", lambda r: iter([(r["conv"], r["part"], matrix(r["symbols"]))]))

    def behind(row: dict) -> Iterator[tuple]:
        """The costs behind each of a conversation's segments, from the last one on."""
        costs = ENDS
        for s in reversed(row["parts"]):
            yield row["conv"], s["part"], costs, s["part"] == row["parts"][0]["part"], costs is ENDS
            costs = _before(s["costs"], costs)

    gathered = weighed.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "costs"))).alias("parts"))
    after = _per_row(gathered, f"conv {kind}, part bigint, costs array<bigint>, first boolean, last boolean", behind)
    after = after.select(F.col("conv").alias("c"), F.col("part").alias("p"), "costs", "first", "last")

    def unroll(row: dict) -> Iterator[tuple]:
        """A segment's edits for every state that it may be entered in."""
        found = [edits(row["symbols"], s, tuple(row["costs"])) for s in (STATES if not row["first"] else [START])]
        audits = [a + "I" * (ENDS[s] // INSERT) * row["last"] for a, s in found]
        yield row["conv"], row["part"], row["symbols"], audits, [s for _, s in found]

    joined = segments.join(after, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).select("conv", "part", "symbols", "costs", "first", "last")
    tried = landed(_per_row(joined, f"conv {kind}, part bigint, symbols string, audits array<string>, exits array<int>", unroll), "unrolled")

    # a conversation of one segment is done; the others' states are followed through their segments
    several = tried.filter("size(exits) > 1").select("conv").distinct().select(F.col("conv").alias("c"))
    steps = tried.join(several, F.col("conv").eqNullSafe(F.col("c")), "left_semi").groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "exits"))).alias("parts"))

    def follow(row: dict) -> Iterator[tuple]:
        state = START
        for s in row["parts"]:
            yield row["conv"], s["part"], state
            state = s["exits"][state if len(s["exits"]) > 1 else START]

    entries = _per_row(steps, f"conv {kind}, part bigint, entry int", follow).select(F.col("conv").alias("c"), F.col("part").alias("p"), "entry")
    chosen = tried.join(entries, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")), "left").withColumn("entry", F.coalesce("entry", F.lit(START)))
    return landed(chosen.select("conv", "part", "symbols", "entry", F.element_at("audits", F.when(F.size("audits") > 1, F.col("entry") + 1).otherwise(1)).alias("audit")), "plan")


def _named(df: DataFrame, id_col: str) -> DataFrame:
    """``conv, turn, role, text``: nulls of role and text read as one space."""
    return df.select(F.col(id_col).alias("conv"), "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))


class _Stream:
    """Follows one conversation: its segments' edits first, then its rows in order."""

    def __init__(self, conv: object):
        self.conv, self.symbols, self.audit = conv, "", ""
        self.at, self.state, self.position = 0, START, 0
        self.turns = [None, None, 0]

    def turn(self, turn: int | None) -> None:
        if turn is not None and turn != self.turns[1]:
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]

    def _inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield "I", ROLE[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """``(edit, role, text)`` of the rows that stand for this one, deleted ones too."""
        yield from self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = SYSTEM if role[0] == "s" else NEXT[self.state]
        elif edit == "R":
            self.state = NEXT[self.state]
            role = ROLE[self.state]
        yield edit, role, text

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserts()

    def counts(self) -> dict:
        """Faults, illegal neighbours, cost and gaps."""
        faults = [(ord(c) - 65) % 4 for c in self.symbols]
        initials = [INITIALS[(ord(c) - 65) // 4] for c in self.symbols]
        paid = sum({"R": REROLE, "D": DELETE, "I": INSERT}.get(e, 0) for e in self.audit)
        cut = sum(CUT for e, f in zip(self.audit.replace("I", ""), faults) if f == 3 and e != "D")
        low, high, distinct = self.turns
        return {
            "gaps": 0 if low is None else high - low + 1 - distinct,
            **{name: faults.count(n) for n, name in enumerate(FAULTS) if name},
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "cost": paid + cut,
            "audit": self.audit,
        }


def _streamed(rows: DataFrame, segments: DataFrame, ids: DataFrame | None, schema: str, each: Callable, last: Callable) -> DataFrame:
    """Rows of every conversation in order behind its edits, through ``each(stream, row)`` and ``last(stream)``."""
    null = lambda c, t: F.lit(None).cast(t).alias(c)
    number = rows.schema["turn"].dataType
    heads = segments.select("conv", F.lit(1).alias("kind"), "part", null("turn", number), F.col("symbols").alias("role"), F.col("audit").alias("text"), null("digest", "string"))
    full = rows.select("conv", F.lit(2).alias("kind"), F.lit(0).cast("bigint").alias("part"), "turn", "role", "text", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    both = heads.union(full)
    if ids is not None:
        both = both.union(ids.select("conv", F.lit(0), F.lit(0).cast("bigint"), null("turn", number), null("role", "string"), null("text", "string"), null("digest", "string")))
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = None
        for batch in batches:
            out: list[tuple] = []
            for conv, kind, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "kind", "turn", "role", "text"))):
                if stream is None or stream.conv != conv:
                    if stream is not None:
                        out += last(stream)
                    stream = _Stream(conv)
                if kind == 1:
                    stream.symbols += role
                    stream.audit += text
                elif kind == 2:
                    stream.turn(turn)
                    out += each(stream, stream.row(role, text))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], names=arrow.names)
        if stream is not None and (out := list(last(stream))):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], names=arrow.names)

    return both.repartition("conv").sortWithinPartitions("conv", "kind", "part", "turn", "role", "digest").mapInArrow(run, schema)


def repaired(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The repaired conversations: ``conv_id, position, role, text, edit``, without deleted rows.

    Takes rows ``(id, turn, role, text)`` in order of turn, null turns first; rows of
    one turn by role, then by the SHA-256 of their text. Null roles and texts read as one
    space; a role's initial is its first character, and a row with an empty role can't
    be kept as it is. Repeated rows are duplicates of the first of them, rows with a null
    id are a conversation of their own. No rows, or none that is kept, give none.
    Further columns take no part, whatever their names.
    """
    rows = _named(conversations, id_col)
    kind = rows.schema["conv"].dataType.simpleString()

    def each(stream: _Stream, found: Iterator) -> Iterator[tuple]:
        for edit, role, text in found:
            if edit != "D":
                yield stream.conv, stream.position, role, text, edit
                stream.position += 1

    return _streamed(rows, plan(rows), None, f"`{id_col}` {kind}, position bigint, role string, text string, edit string", each, lambda s: each(s, s.end()))


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def report(conversations: DataFrame, ids: DataFrame | None = None, id_col: str = "conv_id") -> DataFrame:
    """A row per conversation: gaps, faults, illegal neighbours, cost, audit and the hash of the repaired rows.

    Order, nulls, ties and repeated rows as in ``repaired``. Conversations that only
    ``ids`` names have zeros, an empty audit and the hash of the empty text.
    """
    rows = _named(conversations, id_col)
    kind = rows.schema["conv"].dataType.simpleString()

    def each(stream: _Stream, found: Iterator) -> tuple:
        if not hasattr(stream, "hash"):
            stream.hash = hashlib.sha256()
        for edit, role, text in found:
            if edit != "D":
                stream.hash.update(f"{chr(10) if stream.position else ''}{role}:{text}".encode())
                stream.position += 1
        return ()

    def last(stream: _Stream) -> Iterator[tuple]:
        each(stream, stream.end())
        yield stream.conv, *stream.counts().values(), stream.hash.hexdigest()

    names = None if ids is None else ids.select(F.col(id_col).alias("conv")).distinct()
    return _streamed(rows, plan(rows), names, f"`{id_col}` {kind}, {REPORT}", each, last)


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage by ``crc32(conv_id:turn) % 20``; nulls read as one space there and in role and text."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    rows = conversations.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), hit.alias("hit")).filter("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query of operator 11 over all of ``conversations``."""
    original = table(spark, sf_dir, "conversations")
    return report(damaged(original), original)


def _moves() -> str:
    """All ways over one row as SQL values: state, initial it takes (null: any), whether it stays, new state, cost, edits, lines before, role."""
    out = []
    for start in STATES:
        state, edited, before = start, "", ""
        for n in range(4):
            out.append((start, None, False, state, n * INSERT + DELETE, edited + "D", before, None))
            out.append((start, None, True, NEXT[state], n * INSERT + REROLE, edited + "R", before, ROLE[NEXT[state]]))
            asked = {START: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}[state]
            out += [(start, c, True, SYSTEM if c == "s" else NEXT[state], n * INSERT, edited + "K", before, None) for c in asked]
            state = NEXT[state]
            edited, before = edited + "I", f"{before}{ROLE[state]}:|"
    value = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return ", ".join("(" + ", ".join(map(value, m)) + ")" for m in out)


def _oracle() -> str:
    space = " || ".join(f"chr({ord(c)})" for c in _SPACE)
    return f"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS hit FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role, CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy FROM base WHERE hit <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, rtrim(text, {space}) AS bare FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM hurt)),
marked AS (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS d,
    CASE WHEN bare = '' THEN 1 WHEN nth > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM ordered),
moves(st, initial, stays, st2, cost, edits, before, role) AS (VALUES {_moves()}),
dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {START} AS st, lpad('0', 12, '0') AS best, '' AS lines FROM conversations
  UNION ALL
  SELECT conv_id, i, st2, min(k), arg_min(made, k) FROM (
    SELECT d.conv_id, m.i, v.st2,
      lpad((left(d.best, 12)::BIGINT + v.cost + CASE WHEN v.stays AND m.fault = 3 THEN {CUT} ELSE 0 END)::VARCHAR, 12, '0') || substr(d.best, 13) || v.edits AS k,
      d.lines || replace(v.before, '|', chr(10)) || CASE WHEN v.stays THEN coalesce(v.role, m.role) || ':' || m.text || chr(10) ELSE '' END AS made
    FROM dp d JOIN marked m ON m.conv_id IS NOT DISTINCT FROM d.conv_id AND m.i = d.i + 1
    JOIN moves v ON v.st = d.st AND (v.initial IS NULL OR v.initial = m.c) AND NOT (v.stays AND m.fault IN (1, 2)))
  GROUP BY conv_id, i, st2),
ends(st, cost, edits, lines) AS (VALUES ({START}, 0, '', ''), ({SYSTEM}, {2 * INSERT}, 'II', 'user:|assistant:|'), ({USER}, {INSERT}, 'I', 'assistant:|'), ({ASSISTANT}, 0, '', '')),
counted AS (
  SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
    count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE i > 1 AND d || c NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id),
ended AS (
  SELECT d.conv_id, min(k) AS k, arg_min(made, k) AS made FROM (
    SELECT d.conv_id, d.i, lpad((left(d.best, 12)::BIGINT + e.cost)::VARCHAR, 12, '0') || substr(d.best, 13) || e.edits AS k, d.lines || replace(e.lines, '|', chr(10)) AS made
    FROM dp d JOIN ends e USING (st)) d
  LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id WHERE d.i = coalesce(c.n, 0) GROUP BY d.conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, left(k, 12)::BIGINT AS cost, substr(k, 13) AS audit, sha256(left(made, greatest(length(made) - 1, 0))) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""


QUERIES = {"op11_conversation_repair": op11_conversation_repair}
ORACLE_SQL = {"op11_conversation_repair": _oracle()}
