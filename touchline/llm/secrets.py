"""Operator 5, secret scans: patterns plus sliding-window entropy, in SQL functions only.

Base kinds are regexes whose matches keep their positions: the gaps that
``split`` leaves and the matches that ``regexp_extract_all`` finds alternate,
so a running sum of their lengths gives every start and end in code points.

The entropy kinds look at candidate strings, maximal runs of token characters.
A candidate belongs to the narrowest character class that covers it (hex,
alnum, base64), and each class has its own window and threshold; a candidate
shorter than its class's window is one window, with the threshold for that length. The
Shannon entropy of every window comes from incremental counts: the state of a
scan holds a count for each character, packed into longs, and the sum of
``n * log2(n)`` over them. A step takes the character that leaves from its
count and adds the one that enters to its own; the sum changes by these two terms
only. It is kept in whole numbers (2**-40 bits), so it doesn't drift. Candidates on the
allow-list (identifiers without digits, plain numbers, UUIDs, sample values) are
suppressed first. Long candidates are cut into overlapping pieces that together
hold every window, so the work is linear in the text. Patterns over candidates
repeat possessively: they neither backtrack nor recurse, however long the candidate is.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import table

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
PIECE = 1024


class Entropy(NamedTuple):
    kind: str
    covers: str  # regex of the class, tried in this order
    window: int
    bits: float


CLASSES = [
    Entropy("entropy_hex", r"^[0-9a-fA-F]++$", 20, 3.07),
    Entropy("entropy_alnum", r"^[0-9A-Za-z]++$", 20, 3.53),
    Entropy("entropy_base64", r"^", 24, 3.83),
]
KINDS = ["assign", "access", "hex", *(c.kind for c in CLASSES)]
#: A candidate's least length.
SHORTEST = 20

#: Candidates that match one of these are no secrets.
ALLOWED = [
    r"^[^0-9]*+[0-9]?+[^0-9]*+$",  # at most one digit: words, paths, rulers
    r"^[^A-Za-z]++$",  # numbers, dates, rulers
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUIDs
    r"(?i)(example|sample|placeholder|dummy|changeme|xxxx)",
    r"^(?:[A-Za-z]*+[-_/=+])*+[A-Za-z]*+[0-9]{0,4}+(?:[-_/=+][A-Za-z]*+)*+$",  # words with a year or a version
]

#: Candidates' characters lie from ``+`` to ``z``; counts of up to 31 take five bits, twelve of them a long.
_FIRST, _LONGS, _PER_LONG, _BITS = ord("+"), 7, 12, 5
_UNIT = 1 << 40

_SPAN = "array<struct<start: int, kind: int, end: int>>"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(kind: str, gaps: str, found: str, keep: str) -> Column:
    """Spans of the matches ``found`` between ``gaps``; ``keep`` may refer to match number ``i``."""
    return F.expr(
        f"if(size({found}) = 0, cast(array() as {_SPAN}), aggregate(sequence(0, size({found}) - 1), "
        f"named_struct('at', 0, 'out', cast(array() as {_SPAN})), (s, i) -> named_struct("
        f"'at', s.at + length({gaps}[i]) + length({found}[i]), "
        f"'out', if({keep}, concat(s.out, array(named_struct('start', s.at + length({gaps}[i]), 'kind', {kind}, "
        f"'end', s.at + length({gaps}[i]) + length({found}[i])))), s.out))).out)"
    )


def least_bits(c: Entropy, length: int) -> float:
    """The threshold of a window of ``length`` characters: the class's own, in proportion to the most that so many can hold."""
    return c.bits * math.log2(length) / math.log2(c.window)


def _most(c: Entropy, length: int) -> int:
    """The largest sum of ``n * log2(n)``, in units, with which a window of ``length`` is suspicious."""
    return math.floor(length * (math.log2(length) - least_bits(c, length)) * _UNIT)


def _least_sum(text: str, window: str) -> str:
    """SQL of the smallest sum of ``n * log2(n)`` over a window of ``text``, in units."""
    terms = "array(" + ", ".join(f"{round(n * math.log2(n) * _UNIT) if n else 0}L" for n in range(32)) + ")"
    packed = lambda k: f"case {k} " + " ".join(f"when {n} then s.a{n}" for n in range(_LONGS)) + " end"
    count = lambda k, shift: f"cast(shiftright({packed(k)}, {shift}) & 31 as int)"
    # a character: its long, its place there, and one there
    place = lambda x: f"named_struct('k', ({x}) div {_PER_LONG}, 'at', cast({_BITS} * (({x}) % {_PER_LONG}) as int), 'one', shiftleft(1L, cast({_BITS} * (({x}) % {_PER_LONG}) as int)))"
    leaves, enters = f"coalesce({count('c.o.k', 'c.o.at')}, 0)", count("c.i.k", "c.i.at")
    # the window's count of the entering character, without the one that leaves
    inside = f"({enters} - if(coalesce(c.o.k = c.i.k and c.o.at = c.i.at, false), 1, 0))"
    total = f"s.f - {terms}[{leaves}] + {terms}[greatest({leaves} - 1, 0)] + {terms}[{inside} + 1] - {terms}[{inside}]"
    longs = ", ".join(f"'a{n}', s.a{n} + if(c.i.k = {n}, c.i.one, 0L) - if(coalesce(c.o.k = {n}, false), c.o.one, 0L)" for n in range(_LONGS))
    start = ", ".join(f"'a{n}', 0L" for n in range(_LONGS))
    states = (
        f"aggregate(cs, named_struct('n', 0, 'f', 0L, 'least', {1 << 62}L, {start}), (s, c) -> transform(array({total}), f -> named_struct("
        f"'n', s.n + 1, 'f', f, 'least', if(s.n + 1 >= {window}, least(s.least, f), s.least), {longs}))[0], s -> s.least)"
    )
    pairs = f"transform(xs, (x, i) -> named_struct('i', {place('x')}, 'o', if(i >= {window}, {place(f'xs[i - {window}]')}, null)))"
    pieces = f"transform(sequence(0, length({text}) - {window}, {PIECE}), k -> substr({text}, k + 1, {PIECE} + {window} - 1))"
    codes = f"transform(split(p, ''), x -> ascii(x) - {_FIRST})"
    return f"array_min(transform(transform(transform({pieces}, p -> {codes}), xs -> {pairs}), cs -> {states}))"


def _class_of(text: str) -> str:
    whens = " ".join(f"when {text} rlike {_quoted(c.covers)} then {KINDS.index(c.kind)}" for c in CLASSES)
    return f"case {whens} end"


def _entropic(text: str) -> str:
    """SQL of the check whether a candidate is suspicious."""
    allowed = " or ".join(f"{text} rlike {_quoted(a)}" for a in ALLOWED)
    case = lambda value: " ".join(f"when {KINDS.index(c.kind)} then {value(c)}" for c in CLASSES)
    window = "case kind " + case(lambda c: f"least(length({text}), {c.window})") + " end"
    most = "case kind " + case(lambda c: "array(" + ", ".join(f"{_most(c, n)}L" for n in range(SHORTEST, c.window + 1)) + f")[window - {SHORTEST}]") + " end"
    suspicious = f"transform(array({window}), window -> {_least_sum(text, 'window')} <= {most})[0]"
    return f"if({allowed}, false, transform(array({_class_of(text)}), kind -> {suspicious})[0])"


def found_spans(text: Column) -> list[tuple[str, Column]]:
    """The steps, as named columns, that lead from ``text`` to ``base`` and ``added`` spans."""
    steps = [("_text", F.coalesce(text, F.lit("")))]
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("entropy", CANDIDATE)):
        steps.append((f"_{name}", F.expr(f"regexp_extract_all(_text, {_quoted(pattern)}, 0)")))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("entropy", CANDIDATE)):
        steps.append((f"_{name}_gaps", F.expr(f"if(size(_{name}) = 0, array(), split(_text, {_quoted(pattern)}, -1))")))
    steps.append(("_assign_value", F.expr(f"if(size(_assign) = 0, array(), regexp_extract_all(_text, {_quoted(ASSIGN)}, 2))")))
    steps.append(("_entropy_ok", F.expr(f"transform(_entropy, c -> {_entropic('c')})")))
    steps += [
        ("_spans0", _spans("0", "_assign_gaps", "_assign", "length(_assign_value[i]) >= 6")),
        ("_spans1", _spans("1", "_access_gaps", "_access", "true")),
        ("_spans2", _spans("2", "_hex_gaps", "_hex", "true")),
        ("added", _spans(_class_of("_entropy[i]"), "_entropy_gaps", "_entropy", "_entropy_ok[i]")),
        ("base", F.expr("array_sort(concat(_spans0, _spans1, _spans2))")),
    ]
    return steps


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Secret spans of every row: ``row, text, base, added``.

    ``row`` holds the input's columns, whatever their names, unchanged; ``text``
    is the scanned text, empty for null. The spans are arrays of ``(start, kind,
    end)`` in code points, end exclusive, ``kind`` a position in ``KINDS``,
    sorted by start. Empty texts have none; repeated rows give repeated results.
    One row per input row, no shuffle.
    """
    out = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("_text"))
    for name, value in found_spans(F.col("_text")):
        out = out.withColumn(name, value)
    return out.select("row", F.col("_text").alias("text"), "base", "added")


def redact(docs: DataFrame, text_col: str = "text", count_col: str = "n_chars") -> DataFrame:
    """``docs`` with every secret in its texts replaced by a mark, and the texts' lengths, if there, counted anew.

    Null texts stay null, and rows without a secret stay as they are.
    """
    found = scan(docs, text_col).withColumn("spans", F.expr("array_sort(concat(base, added))"))
    found = found.select("row", F.when(F.size("spans") > 0, redacted()).alias("new"))

    def value(c: str) -> Column:
        old = F.col("row").getField(c)
        if c == text_col:
            return F.coalesce("new", old).alias(c)
        if c == count_col:
            return F.coalesce(F.length("new").cast(docs.schema[c].dataType), old).alias(c)
        return old.alias(c)

    return found.select(*map(value, docs.columns))


def redacted(text: str = "text", spans: str = "spans", mark: str = "[SECRET]") -> Column:
    """``text`` with the union of ``spans`` replaced by ``mark``."""
    return F.expr(
        f"if(size({spans}) = 0, {text}, aggregate({spans}, named_struct('at', 0, 'out', ''), (s, h) -> if(h.end <= s.at, s, named_struct("
        f"'at', h.end, 'out', if(h.start < s.at, s.out, concat(s.out, substr({text}, s.at + 1, h.start - s.at), '{mark}')))), "
        f"s -> concat(s.out, substr({text}, s.at + 1))))"
    )


_NAMED = "array_join(transform({0}, h -> concat(element_at(array(" + ", ".join(f"'{k}'" for k in KINDS) + "), h.kind + 1), ':', h.start, ':', h.end)), ',')"


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query of operator 5 over all of ``documents``."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = "cast(size(filter(base, h -> h.kind = {0})) as bigint)"
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.expr(count.format(0)).alias("n_assign"),
        F.expr(count.format(1)).alias("n_access"),
        F.expr(count.format(2)).alias("n_hex"),
        F.expr(f"sha2({_NAMED.format('base')}, 256)").alias("base_sha256"),
        F.expr(_NAMED.format("array_sort(concat(base, added))")).alias("spans"),
    )


def _duck(pattern: str) -> str:
    """The pattern for an engine that never backtracks, and so has no possessive repeats."""
    return "'" + pattern.replace("*+", "*").replace("]++", "]+").replace("?+", "?").replace("}+", "}").replace("'", "''") + "'"


def _oracle() -> str:
    letters = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    assign = "(" + "|".join(letters(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")" + ASSIGN.split(")", 2)[2]
    kinds = [("0", assign), ("1", ACCESS), ("2", HEX), ("9", CANDIDATE)]
    lists = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS kind, regexp_extract_all(text, {_duck(p)}, 0) AS m, regexp_extract_all(text, {_duck(p)}, {2 if k == '0' else 0}) AS v, string_split_regex(text, {_duck(p)}) AS g FROM docs"
        for k, p in kinds
    )
    allowed = " OR ".join(f"regexp_matches(m, {_duck(a)})" for a in ALLOWED)
    kind = " ".join(f"WHEN regexp_matches(m, {_duck(c.covers)}) THEN {KINDS.index(c.kind)}" for c in CLASSES)
    window = " ".join(f"WHEN {KINDS.index(c.kind)} THEN least(len(m), {c.window})" for c in CLASSES)
    bits = " ".join(f"WHEN {KINDS.index(c.kind)} THEN {c.bits} * log2(least(len(m), {c.window})) / log2({c.window})" for c in CLASSES)
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lists AS ({lists}),
places AS (
  SELECT doc_id, kind, m[i] AS m, v[i] AS v, list_sum([len(x) for x in g[1:i]])::BIGINT + coalesce(list_sum([len(x) for x in m[1:i - 1]]), 0)::BIGINT AS start
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM lists)),
cand AS (SELECT *, CASE {kind} END AS cls FROM places WHERE kind = 9 AND NOT ({allowed})),
wins AS (SELECT *, unnest(range(1, len(m) - (CASE cls {window} END) + 2)) AS k FROM cand),
chars AS (SELECT doc_id, start, cls, m, k, c, count(*) AS n FROM (SELECT *, unnest(string_split(m[k : k + (CASE cls {window} END) - 1], '')) AS c FROM wins) GROUP BY ALL),
peaks AS (SELECT doc_id, start, cls, m, k, log2((CASE cls {window} END)) - sum(n * log2(n)) / (CASE cls {window} END) AS h FROM chars GROUP BY doc_id, start, cls, m, k),
spans AS (
  SELECT doc_id, kind, start, start + len(m) AS stop FROM places WHERE kind < 9 AND (kind > 0 OR len(v) >= 6)
  UNION ALL SELECT doc_id, cls, start, start + len(m) FROM (SELECT doc_id, cls, start, m, max(h) AS h FROM peaks GROUP BY ALL) WHERE h >= CASE cls {bits} END),
per AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS b, count(*) FILTER (WHERE kind = 2) AS c,
    string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base,
    string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs d LEFT JOIN per p USING (doc_id)"""


QUERIES = {"op5_secret_scan": op5_secret_scan}
ORACLE_SQL = {"op5_secret_scan": _oracle()}
