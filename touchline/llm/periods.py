"""Operator 12, periodic runs of words by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period ``q`` and a length of
at least ``max(6, 4 * q)`` that can't be extended on either side. Texts are compared as
numbers, many documents at once in one array whose borders equal nothing.

* Periods up to ``SHORT`` are scanned directly: for each lag the words that equal
  the one a lag ahead, in stretches.
* Longer ones have a scale each: scale ``k`` (a power of two) serves the periods in
  ``(k / 2, k]``. The blocks of ``k`` words get numbers by doubling, equal ones
  exactly for equal blocks. Of every window of ``k / 2`` blocks the one that hashes
  least is kept, its minimizer. Inside a run of period ``q`` the window ``q`` words
  on has the same content, so its minimizer lies ``q`` words on and is equal; as a block
  is no shorter than the period, no equal block lies between them. So neighbouring equal
  minimizers seed every run of the scale. Seeds of one lag that touch are one stretch;
  stretches are extended both ways by comparing blocks of halving length.

A stretch whose length is reached with a divisor of its lag belongs to that
divisor, which finds it by itself. Everything found is compared word by word or
block by block, so hashing only orders blocks and never decides equality.

The work is linear in the words for each scale, and a scale only sees documents that
are long enough for it. One task step handles about two megabytes of text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import by_bytes, crc32_sql, table
from touchline.llm.words import WORD, numbered, paired

#: Periods up to this one are scanned lag by lag; a power of two.
SHORT = 16
#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

_SEED = np.uint64(0x9E3779B97F4A7C15)


def _divisors(period: int) -> list[int]:
    """``period`` divided by each of its prime factors: a smaller period divides one of them."""
    out, rest, p = [], period, 2
    while p * p <= rest:
        if rest % p == 0:
            out.append(period // p)
            while rest % p == 0:
                rest //= p
        p += 1
    return out + ([period // rest] if rest > 1 else [])


def _long_enough(length: np.ndarray, lag: np.ndarray | int) -> np.ndarray:
    return length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * lag)


def _smallest(ids: np.ndarray, start: int, length: int, lag: int) -> bool:
    """Whether no smaller period than ``lag`` fits the stretch; as it is four lags long, one would divide the lag."""
    stretch = ids[start : start + 2 * lag]
    return not any(np.array_equal(stretch[p:], stretch[:-p]) for p in _divisors(lag))


def _direct(ids: np.ndarray, lag: int) -> list[tuple[int, int, int]]:
    """Runs of the period ``lag`` by comparing all words with those a lag ahead."""
    same = np.flatnonzero(ids[:-lag] == ids[lag:])
    if not len(same):
        return []
    cut = np.flatnonzero(np.diff(same) != 1)
    first, last = same[np.r_[0, cut + 1]], same[np.r_[cut, len(same) - 1]]
    length = last - first + 1 + lag
    found = np.flatnonzero(_long_enough(length, lag))
    return [(s, n, lag) for s, n in zip(first[found].tolist(), length[found].tolist()) if _smallest(ids, s, n, lag)]


def _minimizers(blocks: np.ndarray, window: int) -> np.ndarray:
    """Places of the least block of every window of ``window`` (a power of two) blocks, ascending, once each.

    Blocks are ordered by a hash of their number and then by place, so windows of equal content choose alike.
    """
    mixed = (blocks.astype(np.uint64) + np.uint64(1)) * _SEED
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _SEED
    least = (mixed & ~np.uint64(0xFFFFFFFF)) | np.arange(len(blocks), dtype=np.uint64)
    step = 1
    while step < window and len(least) > step:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    places = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return np.unique(places)


def _ahead(levels: list[np.ndarray], at: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """From each place, how many words in a row equal the one ``lag`` ahead."""
    out, going = np.zeros(len(at), np.int64), np.arange(len(at))
    top = len(levels) - 1
    while len(going):  # whole blocks of the largest length, as long as they are equal
        x = at[going] + out[going]
        y = x + lag[going]
        same = y < len(levels[top])
        same[same] = levels[top][x[same]] == levels[top][y[same]]
        going = going[same]
        out[going] += 1 << top
    for k in range(top - 1, -1, -1):
        x = at + out
        y = x + lag
        same = y < len(levels[k])
        same[same] = levels[k][x[same]] == levels[k][y[same]]
        out[same] += 1 << k
    return out


def _behind(levels: list[np.ndarray], at: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """How many words in a row before each place equal the one ``lag`` ahead."""
    out, going = np.zeros(len(at), np.int64), np.arange(len(at))
    top = len(levels) - 1
    while len(going):
        x = at[going] - out[going] - (1 << top)
        same = x >= 0
        same[same] = levels[top][x[same]] == levels[top][x[same] + lag[going][same]]
        going = going[same]
        out[going] += 1 << top
    for k in range(top - 1, -1, -1):
        x = at - out - (1 << k)
        same = x >= 0
        same[same] = levels[k][x[same]] == levels[k][x[same] + lag[same]]
        out[same] += 1 << k
    return out


def _seeded(levels: list[np.ndarray], scale: int) -> list[tuple[int, int, int]]:
    """Runs whose period is in ``(scale / 2, scale]``; ``levels[j]`` numbers the blocks of ``2**j`` words."""
    ids, blocks = levels[0], levels[-1]
    if len(blocks) < 2:
        return []
    places = _minimizers(blocks, scale // 2)
    order = np.lexsort((places, blocks[places]))
    places = places[order]
    lag = np.diff(places)
    seed = (blocks[places[:-1]] == blocks[places[1:]]) & (2 * lag > scale) & (lag <= scale)
    first, lag = places[:-1][seed], lag[seed]
    if not len(first):
        return []
    order = np.lexsort((first, lag))
    first, lag = first[order], lag[order]
    # a seed says that the words of its block equal those a lag ahead: touching ones are one stretch
    new = np.r_[True, (lag[1:] != lag[:-1]) | (first[1:] > first[:-1] + scale)]
    starts = np.flatnonzero(new)
    ends = np.r_[starts[1:], len(first)] - 1
    low, high, lag = first[starts], first[ends] + scale, lag[starts]
    low, high = low - _behind(levels, low, lag), high + _ahead(levels, high, lag)
    length = high - low + lag
    keep = _long_enough(length, lag)
    found = {(s, n, q) for s, n, q in zip(low[keep].tolist(), length[keep].tolist(), lag[keep].tolist())}
    return [r for r in found if _smallest(ids, *r)]


def runs(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Each document's runs ``(start, length, period)`` by start, then period."""
    ids, starts = numbered(documents)
    sizes = np.diff(starts)  # with the border
    found: list[tuple[int, int, int]] = []
    for lag in range(1, SHORT + 1):
        if len(ids) > lag:
            found += _direct(ids, lag)
    # levels[j] numbers the blocks of 2**j words of the documents still looked at; their words stand at ``spread``
    scale, spread, levels = 2 * SHORT, np.arange(len(ids)), [ids]
    owner = np.repeat(np.arange(len(documents)), sizes)
    while True:
        # documents that can hold a run of the scale's smallest period
        stay = np.flatnonzero(sizes[owner] - 1 >= LEAST_PERIODS * (scale // 2 + 1))
        if not len(stay):
            break
        # a block that reached over a border keeps its number: it holds the border and equals nothing
        spread, owner = spread[stay], owner[stay]
        levels = [numbers[stay[: max(0, len(stay) - (1 << j) + 1)]] for j, numbers in enumerate(levels)]
        while 1 << (len(levels) - 1) < scale:
            half = 1 << (len(levels) - 1)
            levels.append(paired(levels[-1][:-half], levels[-1][half:]))
        found += [(int(spread[s]), n, q) for s, n, q in _seeded(levels, scale)]
        scale *= 2
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    for (start, length, period), n in zip(found, np.searchsorted(starts, [f[0] for f in found], side="right") - 1):
        out[n].append((start - int(starts[n]), length, period))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not found:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist()) if not g]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: its id, ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` is an array of ``(start, length, period)`` by start, then period, in
    words from 0; ``collapsed`` is the text of the kept words with one space between
    them. Null and empty texts have no words, no runs and an empty text. Repeated rows
    give repeated rows, null ids stay, an empty table gives none; further columns
    take no part, whatever their names.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    triple = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in by_bytes(batches, "text"):
            documents = [t.encode().split() for t in texts]
            found = runs(documents)
            rows = [[dict(zip(("start", "length", "period"), r)) for r in f] for f in found]
            kept = [b" ".join(collapsed(w, f)).decode() for w, f in zip(documents, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(map(len, documents), pa.int64()), pa.array(rows, pa.list_(triple)), pa.array(kept, pa.large_string())],
                names=[id_col, "n_words", "runs", "collapsed"],
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        search, f"`{id_col}` {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    )


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``text`` of the contract: texts of every tenth hash get a periodic tail, all others stay as they are.

    The words of such a text are joined by one space. Null ids and texts without words stay as they are.
    """
    hashed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.crc32(F.col(id_col).cast("string")).alias("h"))
    with_words = hashed.withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    places = with_words.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("if(n > 0, g % n, 0L)"))
    lags = places.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    # the tail repeats its first p words: whole copies and the beginning of one more
    tail = "slice(words, cast(a + 1 as int), cast(p as int))"
    copies = f"flatten(array_repeat({tail}, cast((n - a) div p + 1 as int)))"
    made = f"array_join(concat(slice(words, 1, cast(a as int)), slice({copies}, 1, cast(n - a as int))), ' ')"
    return lags.select("doc_id", F.expr(f"if(coalesce(n, 0) > 0, {made}, text)").alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Contract columns from the rows of ``find_runs``."""
    best = F.expr(
        "aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (b, r) -> "
        "if(b is null or r.length * b.period > b.length * r.period or (r.length * b.period = b.length * r.period and (r.start < b.start or (r.start = b.start and r.period < b.period))), r, b))"
    )
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")

    def number(name: str) -> Column:
        return F.col(f"best.{name}").alias(name)

    return found.withColumn("best", best).select(
        "doc_id", "n_words", F.size("runs").cast("bigint").alias("n_runs"), number("start"), number("length"), number("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query of operator 12 over all of ``documents``."""
    return digest(find_runs(planted(table(spark, sf_dir, "documents"))))


def _oracle() -> str:
    return f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws, {crc32_sql("doc_id::VARCHAR")} AS h FROM documents),
sized AS MATERIALIZED (SELECT r, doc_id, ws, len(ws) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM docs),
placed AS MATERIALIZED (SELECT r, unnest(ws) AS w, unnest(range(n)) AS i FROM sized),
plan AS MATERIALIZED (SELECT r, i, CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END AS j FROM placed JOIN sized USING (r)),
words AS MATERIALIZED (SELECT p.r, p.i, q.w FROM plan p JOIN placed q ON q.r = p.r AND q.i = p.j),
lags AS (SELECT r, n, unnest(range(1, n // {LEAST_PERIODS} + 1)) AS q FROM sized),
aligned AS (SELECT r, q, unnest(range(0, n - 2 * q, q)) AS x FROM lags),
first AS MATERIALIZED (SELECT x.r, x.q, x.x, a.w FROM aligned x JOIN words a ON a.r = x.r AND a.i = x.x),
second AS MATERIALIZED (SELECT p.r, p.q, p.x, p.w FROM first p JOIN words b ON b.r = p.r AND b.i = p.x + p.q AND b.w = p.w),
hit AS MATERIALIZED (SELECT DISTINCT p.r, p.q FROM second p JOIN words c ON c.r = p.r AND c.i = p.x + 2 * p.q AND c.w = p.w),
tried AS MATERIALIZED (SELECT h.r, h.q, a.i, a.w FROM hit h JOIN words a ON a.r = h.r),
same AS MATERIALIZED (SELECT t.r, t.q, t.i FROM tried t JOIN words b ON b.r = t.r AND b.i = t.i + t.q AND b.w = t.w),
stretch AS MATERIALIZED (
  SELECT r, q, min(i) AS s, count(*) + q AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM same)
  GROUP BY r, q, k HAVING count(*) + q >= greatest({LEAST_WORDS}, {LEAST_PERIODS} * q)),
runs AS MATERIALIZED (SELECT * FROM stretch a WHERE NOT EXISTS (SELECT 1 FROM stretch b WHERE b.r = a.r AND b.s = a.s AND b.l = a.l AND b.q < a.q)),
best AS (SELECT r, s, l, q FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY l::DOUBLE / q DESC, s, q) = 1),
listed AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT d.doc_id, d.n::BIGINT AS n_words, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, l::BIGINT AS length, q::BIGINT AS period, (1000 * l // q)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM sized d LEFT JOIN best USING (r) LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)"""


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLE_SQL = {"op12_periodic_runs": _oracle()}
