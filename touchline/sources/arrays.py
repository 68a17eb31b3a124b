"""JSON array documents of any size, scanned in splits and written in parts.

A document is one JSON array. Spark's text source cuts its files into byte ranges at
``}``, a byte that no other character contains, so a task reads a range without knowing
what precedes it: it may begin inside a string, behind a backslash, or at any depth.

1. Each split is summed up for each of the three states that it can begin in: the
   state behind it and by how much the depth changes.
2. The sums are composed from left to right, a row per split and document, which gives
   the state and depth that each split really begins with.
3. Each split is read again with its true beginning and cut at the array's own
   brackets and commas. What stands between two of them is an element. The first and
   last piece of a split may be parts of an element that spans splits; these pieces,
   at most two a split, are put together by document.

A document may also be a folder of part files that follow each other by name, which is
how ``write_json_array`` writes one: no task holds more than its part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.session import scratch_folder

# States of a scan: outside strings, inside one, inside one behind a backslash.
PLAIN, TEXT, ESCAPED = range(3)
_SPACE = b" \t\r\n\xef\xbb\xbf"  # a byte order mark stands at the beginning only
_OPEN, _CLOSE, _COMMA = ord("["), ord("]"), ord(",")
#: By byte: whether a scan looks at it, how it changes the depth, whether it is white space of an element's edge.
_MARK, _CHANGE, _WHITE = np.zeros(256, bool), np.zeros(256, np.int8), np.zeros(256, bool)
_MARK[list(b'"\\{}[],')] = True
_CHANGE[list(b"{[")], _CHANGE[list(b"}]")] = 1, -1
_WHITE[list(b" \t\n\x0b\f\r")] = True
#: What is no part of an element at its edges. Pieces that ``_cut`` calls ``plain`` have lost it already.
_EDGES = "^[\ufeff\\s]+|\\s+$"
#: A summed up split; ``ends`` and ``changes`` have an entry for each state that it can begin in.
SUMMARY = "file string, start bigint, size bigint, bytes bigint, first int, ends array<int>, changes array<bigint>"
_PIECE = "document string, file string, start bigint, number bigint, last boolean, left int, right int, plain boolean, text binary"
#: So many beginnings of splits, some 30 MB, are sent to every executor; of more, rows are dealt out by split.
SENT_SPLITS = 100_000


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the bytes that a scan looks at."""
    at = np.flatnonzero(_MARK[data])
    return at, data[at]


def _walk(at: np.ndarray, byte: np.ndarray, n: int, state: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Which marks of ``n`` bytes stand outside strings, how each changes the depth, and the state behind the bytes."""
    quote = byte == 34
    backslash = at[byte == 92]
    escaped = np.zeros(0, np.int64)
    if len(backslash):
        # a run of backslashes escapes the byte behind it if their number is odd; a state may hold one more before the beginning
        begin = backslash[np.diff(backslash, prepend=-2) != 1]
        behind = backslash[np.diff(backslash, append=n + 1) != 1] + 1
        escaped = behind[(behind - begin + ((begin == 0) & (state == ESCAPED))) % 2 == 1]
    if state == ESCAPED and not (len(backslash) and backslash[0] == 0):
        escaped = np.concatenate(([0], escaped))
    if len(escaped):
        quote &= ~np.isin(at, escaped)
    count = np.cumsum(quote, dtype=np.int64)
    plain = (count - quote + (state != PLAIN)) % 2 == 0
    change = _CHANGE[byte] * plain
    if ((count[-1] if len(count) else 0) + (state != PLAIN)) % 2 == 0:
        return plain, change, PLAIN
    return plain, change, ESCAPED if len(escaped) and escaped[-1] == n else TEXT


def _brace(state: int, depth: int) -> tuple[int, int]:
    """State and depth behind a ``}``."""
    return (PLAIN, depth - 1) if state == PLAIN else (TEXT, depth)


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes, bool]]:
    """``(row, bytes, begins)`` of consecutive rows of a split, with the ``}`` between them back in place.

    ``row`` holds the other columns; a split's bytes come in one or several blobs, the first one ``begins`` it.
    """
    current = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        values, rest = batch.column("value"), batch.drop_columns(["value"])
        file, start = rest.column("file"), rest.column("start")
        bounds = [0, n]
        if (file[0], start[0]) != (file[n - 1], start[n - 1]):
            other = pc.or_(pc.not_equal(file.slice(1), file.slice(0, n - 1)), pc.not_equal(start.slice(1), start.slice(0, n - 1)))
            bounds = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), n]
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values), pa.scalar(b"}", values.type))
        for at, blob in zip(bounds, joined.to_pylist()):
            row = rest.slice(at, 1).to_pylist()[0]
            key = (row["file"], row["start"])
            yield row, blob if key != current else b"}" + blob, key != current
            current = key


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def _summed(schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, total, first, sums = None, 0, None, []

        def done() -> pa.RecordBatch:
            ends, changes = zip(*sums)
            return _table([(row["file"], row["start"], row["size"], total, first, ends, changes)], schema)

        for head, blob, begins in _blobs(batches):
            if begins:
                if row is not None:
                    yield done()
                row, total, first, sums = head, 0, None, [(s, 0) for s in (PLAIN, TEXT, ESCAPED)]
            total += len(blob) + begins  # every row is followed by one byte
            if first is None and (bare := blob.lstrip(_SPACE)):
                first = bare[0]
            if blob:
                data = np.frombuffer(blob, np.uint8)
                marks = _marks(data)
                found = {s: _walk(*marks, len(data), s) for s in {s for s, _ in sums}}
                sums = [(found[s][2], d + int(found[s][1].sum(dtype=np.int64))) for s, d in sums]
        if row is not None:
            yield done()

    return run


def _begun(schema: pa.Schema) -> Callable:
    """The true beginning of each split, from the summed up splits of a document in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for document in batch.to_pylist():
                splits, state, depth = document["splits"], PLAIN, 0
                kind = next((s["first"] for s in splits if s["first"] is not None), None)
                read: dict[str, int] = {}
                for s in splits:
                    read[s["file"]] = read.get(s["file"], 0) + s["bytes"]
                for n, s in enumerate(splits):
                    out.append([s["file"], s["start"], state, depth, kind == _OPEN, True])
                    state, depth = s["ends"][state], depth + s["changes"][state]
                    if n + 1 == len(splits) or splits[n + 1]["file"] != s["file"]:
                        # whether a } ends the file or nothing does: by its length, of which a byte order mark isn't read
                        missing = s["size"] - read[s["file"]]
                        out[-1][5] = missing in (0, 3) or missing not in (-1, 2) and depth > 0
                    if out[-1][5]:
                        state, depth = _brace(state, depth)
            yield _table(out, schema)

    return run


def _edged(blob: bytes, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(plain, begin, end)`` of the pieces of ``blob``, ``plain`` ones without the white space at their edges.

    Pieces with a byte order mark in front, another character than ASCII at the end, or broken
    UTF-8 stay as they are and are not ``plain``: their edges are left to Spark.
    """
    try:
        blob.decode()
        valid = True
    except UnicodeDecodeError:
        valid = False
    solid = np.flatnonzero(~_WHITE[data])
    if not valid or not len(solid):
        return np.full(len(begin), valid), begin, end if not valid else begin
    first, behind = np.searchsorted(solid, begin), np.searchsorted(solid, end)
    blank = first == behind
    inner = np.where(blank, begin, solid[np.minimum(first, len(solid) - 1)])
    outer = np.where(blank, begin, solid[behind - 1] + 1)
    plain = blank | ((data[np.minimum(inner, len(data) - 1)] != 0xEF) & (data[outer - 1] < 0x80))
    return plain, np.where(plain, inner, begin), np.where(plain, outer, end)


def _is_blank(text: bytes) -> bool:
    return not text.decode("utf-8", "replace").strip("\ufeff \t\n\x0b\f\r")


def _cut(schema: pa.Schema, folders: bool) -> Callable:
    """The pieces of each split between the array's own brackets and commas, without empty arrays' blanks."""
    kinds = dict(zip(schema.names, schema.types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, state, depth, number, left = None, PLAIN, 0, 0, None
        piece: list[bytes] = []

        def table(numbers: np.ndarray, last: bool, lefts: pa.Array, rights: pa.Array, plain: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
            n = len(texts)
            document = row["file"].rpartition("/")[0] if folders else row["file"]
            same = {"document": document, "file": row["file"], "start": row["start"], "last": last}
            found = {k: pa.repeat(pa.scalar(v, kinds[k]), n) for k, v in same.items()}
            found |= {"number": pa.array(numbers, kinds["number"]), "left": lefts, "right": rights, "plain": pa.array(plain), "text": pa.array(texts, kinds["text"])}
            return pa.RecordBatch.from_arrays([found[k] for k in schema.names], schema=schema)

        def one(right: int | None, last: bool) -> pa.RecordBatch | None:
            """The piece that ends here; one that may be a part keeps its edges."""
            text, plain = b"".join(piece), False
            piece.clear()
            if number and not last:
                if left == _OPEN and right == _CLOSE and _is_blank(text):
                    return None
                edged = _edged(text, np.frombuffer(text, np.uint8), np.array([0]), np.array([len(text)]))
                plain, text = bool(edged[0][0]), text[int(edged[1][0]) : int(edged[2][0])]
            return table(np.array([number]), last, pa.array([left], kinds["left"]), pa.array([right], kinds["right"]), np.array([plain]), [text])

        def end() -> pa.RecordBatch:
            if row["closed"]:
                piece.append(b"}")
            return one(None, True)

        for head, blob, begins in _blobs(batches):
            if begins:
                if row is not None:
                    yield end()
                row, state, depth, number, left = head, head["state"], head["depth"], 0, None
            if not blob:
                continue
            data = np.frombuffer(blob, np.uint8)
            at, byte = _marks(data)
            plain, change, state = _walk(at, byte, len(data), state)
            after = depth + np.cumsum(change, dtype=np.int64)
            depth = int(after[-1]) if len(after) else depth
            cuts = np.zeros(0, np.int64)
            if row["is_array"]:
                own = ((byte == _OPEN) | (byte == _COMMA)) & (after == 1) & ((byte == _COMMA) | (change == 1)) | (byte == _CLOSE) & (after == 0) & (change == -1)
                cuts = at[own & plain]
            if not len(cuts):
                piece.append(blob)
                continue
            piece.append(blob[: cuts[0]])
            # a piece behind a cut has a number from 1 on
            if (found := one(int(data[cuts[0]]), False)) is not None:
                yield found
                number += 1
            if len(cuts) > 1:
                begin, stop = cuts[:-1] + 1, cuts[1:]
                lefts, rights = data[cuts[:-1]].astype(np.int32), data[stop].astype(np.int32)
                clean, begin, stop = _edged(blob, data, begin, stop)
                texts = [blob[a:b] for a, b in zip(begin.tolist(), stop.tolist())]
                empty = np.flatnonzero((lefts == _OPEN) & (rights == _CLOSE)).tolist()
                if empty := [n for n in empty if _is_blank(texts[n])]:
                    lefts, rights, clean = (np.delete(x, empty) for x in (lefts, rights, clean))
                    gone = set(empty)
                    texts = [x for n, x in enumerate(texts) if n not in gone]
                if texts:
                    yield table(number + np.arange(len(texts)), False, pa.array(lefts, kinds["left"]), pa.array(rights, kinds["right"]), clean, texts)
                    number += len(texts)
            left = int(data[cuts[-1]])
            piece.append(blob[cuts[-1] + 1 :])
        if row is not None:
            yield end()

    return run


def scan_array_documents(spark: SparkSession, path: str | list[str], folders: bool = False, position: bool = False) -> DataFrame:
    """The elements of JSON array documents, whatever the documents' sizes: ``source_file, element, unreadable``.

    ``spark.sql.files.maxPartitionBytes`` sets the size of a split; it does not
    change the rows. With ``folders`` a document is a folder, its files in the order of
    their names; ``source_file`` is then the folder. With ``position`` there is the place of
    each row in its document, from 0.

    Blank documents and empty arrays give no rows, a document that is one object gives
    that object. What can't be an element is ``unreadable`` and keeps its text: an empty
    place between commas, the unfinished rest of a truncated array, text outside the
    brackets, a document of another kind. The elements before and behind it are whole.
    """
    chunks = spark.read.option("lineSep", "}").text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"),
    )
    home = scratch_folder(spark, "array")

    def kept(df: DataFrame, name: str) -> DataFrame:
        """Written, so that a size check decides how it is joined and no document is scanned again for it."""
        df.write.parquet(f"{home}/{name}")
        return spark.read.schema(df.schema).parquet(f"{home}/{name}")

    document = F.regexp_replace("file", "/[^/]*$", "") if folders else F.col("file")
    summed = chunks.mapInArrow(_summed(_arrow(spark, SUMMARY)), SUMMARY).withColumn("document", document)
    parts = summed.groupBy("document").agg(F.array_sort(F.collect_list(F.struct("file", "start", "size", "bytes", "first", "ends", "changes"))).alias("splits"))
    beginnings = "file string, start bigint, state int, depth bigint, is_array boolean, closed boolean"
    begun = kept(parts.mapInArrow(_begun(_arrow(spark, beginnings)), beginnings), "beginnings")
    if begun.count() <= SENT_SPLITS:
        rows = chunks.drop("size").join(F.broadcast(begun), ["file", "start"])
    else:
        # rows of a split in their order again, where the join may have moved them
        rows = chunks.drop("size").withColumn("row", F.monotonically_increasing_id()).join(begun, ["file", "start"]).sortWithinPartitions("file", "start", "row").drop("row")
    pieces = kept(rows.mapInArrow(_cut(_arrow(spark, _PIECE), folders), _PIECE), "pieces")

    between = (F.col("number") > 0) & ~F.col("last")
    order = ["file", "start", "number"]
    # a piece behind a cut begins something; pieces without one go on with it
    loose = pieces.filter(~between).withColumn("group", F.sum(F.when(F.col("number") > 0, 1).otherwise(0)).over(Window.partitionBy("document").orderBy(*order)))
    joined = loose.groupBy("document", "group").agg(F.array_sort(F.collect_list(F.struct(*order, "left", "right", "text"))).alias("p")).select(
        "document", *[F.col("p")[0][c].alias(c) for c in (*order, "left")], F.element_at("p", -1)["right"].alias("right"),
        F.regexp_replace(F.aggregate("p", F.lit(b""), lambda text, x: F.concat(text, x["text"])).cast("string"), _EDGES, "").alias("bare"),
    )
    outside = (F.col("left").isNull() & (F.coalesce("right", F.lit(_OPEN)) == _OPEN)) | ((F.col("left") == _CLOSE) & F.col("right").isNull())
    empty = outside | ((F.col("left") == _OPEN) & (F.col("right") == _CLOSE))
    element = F.col("left").isin(_OPEN, _COMMA) & F.col("right").isin(_COMMA, _CLOSE) & (F.col("bare") != "")
    alone = F.col("left").isNull() & F.col("right").isNull() & F.col("bare").startswith("{")
    # few rows, two a split at most; written, so that their texts are put together once
    ends = kept(joined.filter((F.col("bare") != "") | ~F.coalesce(empty, F.lit(False))), "ends")
    text = F.col("text").cast("string")
    whole = pieces.filter(between).select("document", *order, "left", "right", F.when(F.col("plain"), text).otherwise(F.regexp_replace(text, _EDGES, "")).alias("bare"))
    found = whole.unionByName(ends)
    out = found.select(F.col("document").alias("source_file"), *order, F.col("bare").alias("element"), (~F.coalesce(element | alone, F.lit(False))).alias("unreadable"))
    if not position:
        return out.drop(*order)
    # A split's rows are numbered without gaps, from 0 if its first piece begins the document and is a row, else from 1;
    # its last piece has its highest number and is a row if it is no part of an earlier one.
    inner = pieces.filter("last").select("document", "file", "start", F.greatest(F.col("number") - 1, F.lit(0)).alias("n"), F.lit(1).alias("base"))
    outer = ends.select("document", "file", "start", F.lit(1).cast("bigint").alias("n"), F.when(F.col("number") == 0, 0).otherwise(1).alias("base"))
    counted = inner.unionByName(outer).groupBy("document", "file", "start").agg(F.sum("n").alias("n"), F.min("base").alias("base"))
    behind = F.sum("n").over(Window.partitionBy("document").orderBy("file", "start"))
    ahead = kept(counted.select("file", "start", (behind - F.col("n") - F.col("base")).alias("ahead")), "ahead")
    return out.join(ahead, ["file", "start"]).select("source_file", "element", "unreadable", (F.col("ahead") + F.col("number")).alias("position"))


def write_json_array(df: DataFrame, path: str, order_by: list[str]) -> None:
    """K1: a result as one JSON array document, nulls omitted, written by the executors.

    The folder's part files, one after the other by name, are one valid JSON array with a
    line for each row, in ascending order of ``order_by`` (nulls first). Only the first and the
    last row differ from the others, by a bracket; their numbers are all that the driver
    sees. An empty result is an empty array.
    """
    spark = df.sparkSession
    home = scratch_folder(spark, "array")
    keys = [f"key{n}" for n in range(len(order_by))]
    # numbered once, so that equal rows keep their order and both ends are certain
    df.select(*[F.col(c).alias(k) for c, k in zip(order_by, keys)], F.to_json(F.struct(*df.columns)).alias("json"), F.monotonically_increasing_id().alias("row")).write.parquet(home)
    rows = spark.read.schema(", ".join(f"{k} {df.schema[c].dataType.simpleString()}" for c, k in zip(order_by, keys)) + ", json string, row bigint").parquet(home)
    place = F.struct(*keys, "row")
    ends = rows.agg(F.min(place)["row"].alias("first"), F.max(place)["row"].alias("last")).first()
    if ends["first"] is None:
        spark.range(1).select(F.lit("[]").alias("value")).write.text(path)
        return
    opening = F.when(F.col("row") == ends["first"], "[").otherwise(",")
    closing = F.when(F.col("row") == ends["last"], "]").otherwise("")
    rows.orderBy(*keys, "row").select(F.concat(opening, "json", closing).alias("value")).write.text(path)
