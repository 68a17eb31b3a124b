"""Operator 9, MinHash near-duplicates with tensored banding.

A document is the set of its distinct word shingles. Two small collections of
minhash tuples are computed per set, and every pair of a tuple of the first and
a tuple of the second collection forms a table key: ``s1 * s2`` tables cost only
``r1 * s1 + r2 * s2`` minhashes, about the square root of what independent
tables would take. A pair of similarity ``j`` meets in some table with
probability ``(1 - (1 - j^r1)^s1) * (1 - (1 - j^r2)^s2)``, 0.9993 at ``j = 0.8``.

Equal sets are collapsed first. A bucket is compared with a few of its members
only, its centers (its smallest member, and the least in some random orders), and each
set with one center of each kind: linear in the bucket's size, however many copies it holds. Verified
links join components. A second round does this with new centers over the
bucket members that are not yet in their center's component, unless they would meet few;
at last those meet every bucket member of another component. So every pair that shares a bucket is
verified or already connected, or proved to be no link: each set also has an
odd sketch, the parities of its shingles in ``BITS`` cells, and two sets differ
in at least as many shingles as their sketches in cells. Verification builds
both full sets from the whole texts.

Of a bucket that is crowded by then, with more than ``CROWD`` members, not all pairs are
formed: its sets are alike without being linked, as texts with much boilerplate are. They
are compared by their rarest shingles instead. Linked sets share one of the first
``n - percent * n / 100 + 1`` of their shingles in any common order; taken in order of
frequency these are what is a text's own and not boilerplate, so they meet few others.
Texts of the component that has most of a shingle's texts don't meet each other there.
That finds every link among these sets, whichever buckets they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import by_bytes, components, landed, table

#: (minhashes of a tuple, tuples) of the two collections.
COLLECTIONS = ((2, 8), (3, 11))
#: Random orders that choose centers, by round; the exact round follows.
CENTERS = ((0, 1), (2, 3, 4, 5))
#: Pairs a bucket member, below which the exact round follows at once.
EASY = 16
#: Members of a bucket whose pairs are formed one by one.
CROWD = 1024
#: Cells of an odd sketch.
BITS = 512
#: Bytes of text whose sets are built at once.
_RUN = 500_000

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, np.uint64)
_HASHES = sum(r * s for r, s in COLLECTIONS)
_XOR = _RANDOM.integers(0, 1 << 63, _HASHES, np.uint64)
_TIMES = _RANDOM.integers(0, 1 << 62, _HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MASKS = _RANDOM.integers(0, 1 << 63, 8).tolist()
#: Rows of a set that are hashed at once.
_ROWS = 1 << 14


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text of
    fewer words has one shingle, its whole sequence; one without words has none.
    """
    data = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    ends = np.cumsum([len(d) + 1 for d in data])
    raw = np.frombuffer(b" ".join(data) + b" ", np.uint8)
    gap = np.concatenate([[True], _SPACE[raw]])
    starts = np.flatnonzero(gap[:-1] & ~gap[1:])
    stops = np.flatnonzero(~gap[:-1] & gap[1:])
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in texts]
    lengths = stops - starts
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(int(lengths.max()), _BASE))
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        flat = _BYTE[raw[np.repeat(starts, lengths) + inside]] * powers[inside]
        word = _mixed(np.add.reduceat(flat, np.cumsum(lengths) - lengths))
        last = np.searchsorted(starts, ends)
        first = np.concatenate([[0], last[:-1]])
        rolled = word.copy()
        for k in range(1, words):
            rolled[: len(word) - k] = _mixed(rolled[: len(word) - k] * _BASE + word[k:]) if k < len(word) else rolled[:0]
        out = []
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            if b - a >= words:
                found = np.sort(rolled[a : b - words + 1])
                out.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
            elif b > a:
                whole = np.uint64(b - a)
                for w in word[a:b]:
                    whole = _mixed(np.array([whole * _BASE + w]))[0]
                out.append(np.array([whole]))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _minhashes(found: np.ndarray) -> np.ndarray:
    least = None
    for a in range(0, len(found), _ROWS):
        part = ((found[a : a + _ROWS, None] ^ _XOR) * _TIMES).min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return least


def _odd(found: np.ndarray) -> np.ndarray:
    """The parity of the set's shingles in each cell, as 64-bit words."""
    cells = (found >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in by_bytes(batches, "text", _RUN):
            sets = shingle_sets(texts, words)
            marks = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            tuples = []
            with np.errstate(over="ignore"):
                hashes = np.stack([_minhashes(s) if len(s) else np.zeros(_HASHES, np.uint64) for s in sets])
                at = 0
                for r, s in COLLECTIONS:
                    part = hashes[:, at : at + r * s].reshape(-1, s, r)
                    mixed = part[:, :, 0]
                    for k in range(1, r):
                        mixed = _mixed(mixed * _BASE + part[:, :, k])
                    at += r * s
                    tuples.append(pa.ListArray.from_arrays(np.arange(0, mixed.size + 1, s, dtype=np.int32), pa.array(np.ascontiguousarray(mixed).reshape(-1).view(np.int64))))
            odd = pa.array([_odd(s) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(marks, pa.binary()), *tuples, odd], names=["id", "n", "mark", "left", "right", "odd"]
            )

    return run


def _shingled(words: int):
    """Every text's shingles, a row each, with the size of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in by_bytes(batches, "text", _RUN):
            sets = shingle_sets(texts, words)
            sizes = np.array([len(s) for s in sets], np.int64)
            of = pa.array(np.repeat(np.arange(len(sets)), sizes))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(of) for c in ("place", "id", "component")), pa.array(np.repeat(sizes, sizes)), pa.array(np.concatenate(sets).view(np.int64))],
                names=["place", "id", "component", "n", "shingle"],
            )

    return run


def _cells(name: str) -> list[Column]:
    """The words of the odd sketch, a column each: a join's condition on them compiles to little code."""
    return [F.coalesce(F.get("odd", F.lit(k)), F.lit(0)).alias(f"{name}{k}") for k in range(BITS // 64)]


def _may_link(a: str, b: str, n: str, m: str, percent: int) -> Column:
    """Whether the odd sketches and sizes of two sets allow that they are linked."""
    differ = sum(F.bit_count(F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))) for k in range(BITS // 64))
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return sizes & (differ * (100 + percent) <= (F.col(n) + F.col(m)) * (100 - percent))


def _first_shared(x: str, y: str) -> Column:
    """The first place, from 0, where two arrays agree; -1 without one."""
    return (F.array_position(F.zip_with(x, y, lambda a, b: a == b), True) - 1).cast("int")


def _rare_pairs(texts: DataFrame, sketches: DataFrame, found: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components that share one of their rarest shingles: every link is among them.

    ``sketches(rep, odd)`` are the odd sketches of the texts' sets, which leave out pairs that can't be links.
    """
    numbered = texts.join(found.withColumnRenamed("rep", "id"), "id", "left").select(F.monotonically_increasing_id().alias("place"), "id", F.coalesce("component", "id").alias("component"), "text")
    shingles = landed(numbered.mapInArrow(_shingled(words), "place bigint, id bigint, component bigint, n bigint, shingle bigint"), "shingles")
    # only shingles of several components can make a pair; each one's main component has most of its texts
    counts = shingles.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("of"))
    shared = counts.groupBy("shingle").agg(F.sum("of").alias("df"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("of", "component")).getField("component").alias("main"))
    # in order of frequency a set's unshared shingles come first; only those behind them can meet another set
    common = shingles.join(landed(shared.filter("parts > 1").drop("parts"), "shared"), "shingle")
    of = Window.partitionBy("place")
    first = F.col("n") - F.expr(f"(n * {percent} + 99) div 100") + 1
    place = F.col("n") - F.count(F.lit(1)).over(of) + F.row_number().over(of.orderBy("df", "shingle"))
    rare = common.withColumn("at", place).filter(F.col("at") <= first).join(sketches.select(F.col("rep").alias("id"), "odd"), "id")
    rare = landed(rare.select("shingle", "id", "n", "odd", "component", "main", (F.col("n") - F.col("at") + 1).alias("rest")), "rare")
    other = rare.select("shingle", F.col("id").alias("b"), F.col("n").alias("nb"), *_cells("ob"), F.col("component").alias("cb"), F.col("rest").alias("rb"))
    # of two components one at least isn't the main one, so its texts never meet each other
    met = rare.filter("component <> main").select("shingle", "id", "n", *_cells("odd"), "component", "main", "rest").join(other, "shingle").filter((F.col("component") != F.col("cb")) & ((F.col("cb") == F.col("main")) | (F.col("id") < F.col("b"))))
    # the first shingle that linked sets share has all the others of both behind it
    met = met.filter(F.least("rest", "rb") * (100 + percent) >= (F.col("n") + F.col("nb")) * percent)
    return met.filter(_may_link("odd", "ob", "n", "nb", percent)).select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()


def _similar(words: int, percent: int):
    """Pairs of texts whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in by_bytes(batches, "text_a", _RUN):
            lefts = shingle_sets(texts, words)
            keep = []
            for (part, others), n in _runs_of(batch):
                for k, right in enumerate(shingle_sets(others, words)):
                    left = lefts[n + k]
                    both = int((right[np.minimum(np.searchsorted(right, left), len(right) - 1)] == left).sum()) if len(right) else 0
                    keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def _runs_of(batch: pa.RecordBatch):
        n = 0
        for part, others in by_bytes([batch], "text_b", _RUN):
            yield (part, others), n
            n += len(others)

    return run


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are links, written."""
    pairs = landed(pairs, "pairs")
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = landed(docs.join(needed, "id", "left_semi"), "texts")
    left, right = (texts.select(F.col("id").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return landed(joined.mapInArrow(_similar(words, percent), "a bigint, b bigint"), "links")


def _turned(x: str, seed: int) -> Column:
    """A random order of the ids; turned again, the id."""
    return F.col(x).bitwiseXOR(F.lit(_MASKS[seed]))


def _keys(sets: DataFrame) -> DataFrame:
    """Every set's table keys, ``(rep, key)``.

    The few files of ``sets`` would give few tasks, each of which held the groups of all its
    sets' keys in memory; spread over a number of partitions, which Spark doesn't
    coalesce, a task has its share of them only.
    """
    spread = sets.select("rep", "left", "right").repartition(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rep")
    return spread.select("rep", F.explode(F.expr("flatten(transform(left, (x, i) -> transform(right, (y, j) -> xxhash64(i, j, x, y))))")).alias("key"))


def _centers(seeds: tuple[int, ...]) -> list[Column]:
    """The bucket's least member in each order, turned."""
    return [F.min(_turned("rep", k)).alias(f"center{k}") for k in seeds]


def link(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents whose sets have ``percent`` or more of their union in common are
    linked; a component's id is its smallest document id and only that document
    is kept. Empty sets and rows without an id (whose component is null) are
    linked with nothing and kept. Rows that repeat an id count their own text's
    shingles; texts of one id are one node. An empty table gives no rows; other
    columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sketch = landed(rows.mapInArrow(_sketch(words), "id bigint, n bigint, mark binary, left array<bigint>, right array<bigint>, odd array<bigint>"), "sketch")
    sets = landed(
        sketch.filter("n > 0 and id is not null").groupBy("mark")
        .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("left").alias("left"), F.first("right").alias("right"), F.first("odd").alias("odd")),
        "sets",
    )
    keys = _keys(sets)
    first = CENTERS[0] if CENTERS else ()
    buckets = keys.groupBy("key").agg(F.min("rep").alias("center"), *_centers(first), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = landed(keys.join(buckets, "key"), "members")

    # each text that may take part, once: the representatives that share a bucket
    some = landed(members.select(F.col("rep").alias("id")).distinct(), "candidates")
    texts = landed(rows.join(some, "id", "left_semi"), "texts")
    if texts.count() > some.count():  # rows that repeat an id: each of its different texts once
        texts = landed(texts.groupBy("id", F.xxhash64("text").alias("of")).agg(F.first("text").alias("text")).drop("of"), "texts")
    links = None
    found = docs.sparkSession.createDataFrame([], "rep bigint, component bigint")
    for seeds in (*CENTERS, None):
        if links is None and seeds is not None:  # nothing is linked yet: all but the centers are apart
            apart = members.filter("rep <> center")
        else:
            left = members.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
            center = found.select(F.col("rep").alias("center"), F.col("component").alias("central"))
            left = left.join(center, "center", "left").filter(F.col("component") != F.coalesce("central", "center"))
            apart = landed(left.select("key", "rep", "size", "component"), "apart")
        if apart.isEmpty():
            break
        crowded, small = F.col("size") > CROWD, F.col("size") <= CROWD
        if links is not None and seeds is not None:
            meet = apart.filter(small).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
            seeds = None if meet <= EASY * members.count() else seeds
        if seeds is None:
            full = landed(apart.filter(crowded).select("key").distinct(), "crowded")
            crowd = members.filter(crowded).join(full, "key", "left_semi")
            crowd = landed(crowd.select(F.col("rep").alias("id")).distinct(), "crowd")
            undone = members.filter(small).join(apart.select("key").distinct(), "key", "left_semi").select("key", "rep")
            of = sets.select("rep", "n", "left", "right", *_cells("odd"))
            other = undone.join(of, "rep").join(found, "rep", "left").select(
                "key", F.col("rep").alias("b"), F.col("n").alias("nb"), F.coalesce("component", "rep").alias("cb"), F.col("left").alias("lb"), F.col("right").alias("rb"), *(F.col(f"odd{k}").alias(f"ob{k}") for k in range(BITS // 64))
            )
            # a pair counts in the first table that it shares
            i, j = _first_shared("left", "lb"), _first_shared("right", "rb")
            pairs = (
                apart.filter(small).join(of, "rep").join(other, "key").filter(F.col("component") != F.col("cb"))
                .filter(_may_link("odd", "ob", "n", "nb", percent))
                .filter(F.col("key") == F.xxhash64(i, j, F.get("left", i), F.get("right", j)))
                .select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b"))
            )
            if not crowd.isEmpty():
                pairs = pairs.union(_rare_pairs(texts.join(crowd, "id", "left_semi"), sets, found, words, percent))
            pairs = pairs.distinct()
        else:
            near = apart
            if links is not None:  # new centers; only those apart meet them, the other members go through no join
                center = members.groupBy("key").agg(F.min("center").alias("center"), *_centers(seeds))
                near = apart.select("key", "rep").join(center, "key")
            near = near.groupBy("rep").agg(F.min("center").alias("center"), *(F.min(f"center{k}").alias(f"center{k}") for k in seeds))
            pairs = near.select("rep", F.explode(F.array_distinct(F.array("center", *(_turned(f"center{k}", k) for k in seeds)))).alias("near"))
            pairs = pairs.filter("rep <> near").select(F.least("rep", "near").alias("a"), F.greatest("rep", "near").alias("b"))
        more = _verified(pairs, texts, words, percent)
        links = more if links is None else links.union(more)
        found = components(links, once=True).select(F.col("node").alias("rep"), "component")
        if seeds is None:
            break
    named = sets.select("mark", "rep").join(found, "rep", "left").select("mark", F.coalesce("component", "rep").alias("component"))
    out = sketch.select("id", "n", F.when(F.col("n") > 0, F.col("mark")).alias("mark")).join(named, "mark", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query of operator 9 over all of ``documents``: two words, 80 percent."""
    return link(table(spark, sf_dir, "documents"), words=2)


QUERIES = {"op9_near_duplicates": op9_near_duplicates}
ORACLE_SQL = {
    "op9_near_duplicates": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) = 1 THEN words[1] ELSE words[i] || ' ' || words[i + 1] END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words), 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * inter >= 80 * (x.n + y.n - inter)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, other) AS (SELECT a, a FROM e UNION SELECT r.node, e.b FROM reach r JOIN e ON e.a = r.other),
c AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component, w.doc_id)::BIGINT AS component_id, coalesce(component, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = w.doc_id"""
}
