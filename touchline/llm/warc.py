"""Operator 3, WARC: writing archives, and reading them by boundary-chain verification.

Writing is a projection and Spark's own text writer: a record is one string and
the record terminator is the writer's line separator, so archives go to any
file system Spark knows and are committed like any Spark output.

Reading splits the files at every occurrence of the magic line, also those
inside payloads. A task sees the pieces of its split in order and emits, for
every piece that starts with a record header, a *candidate*: its offset and the
offset of the successor that its Content-Length promises. Successors only point
forward, so the candidates of a split form a forest; a task numbers it in
pre-order and follows each chain to the first offset outside the split. Between
splits, pointer jumping from the file start doubles those links until no new
entry is reached. A candidate is a record if and only if it lies on the chain
from the entry of its split, which the pre-order numbers decide: magic inside
payloads is never on it. Only records that hold such magic need a second look
at the bytes, to put their pieces together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import landed, shared_folder, table

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
#: Payloads of fewer bytes are always written in full.
LEAST_REVISIT = 1000


def _header_value(value) -> object:
    """A string that may stand in a header line: control characters percent-encoded."""
    for code in (13, 10):
        value = F.replace(value, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return value


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record per row of ``pages`` below ``path``.

    Of rows with equal payloads of ``LEAST_REVISIT`` bytes or more, the one with
    the largest id is a response and the others are revisits of it; rows that
    share that id and payload are all responses, as are rows when no row of
    their group has an id. A null payload is empty, a null id or url leaves its
    header empty or out. The groups with copies are aggregated before the join
    and landed, so Spark broadcasts them if they are small and otherwise
    shuffles and splits hot groups.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("payload")
    ).select("*", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("bytes"))
    groups = landed(
        rows.filter(F.col("bytes") >= LEAST_REVISIT)
        .groupBy("sha1", "bytes").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first is not null").drop("n"),
        "copies",
    )
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), "bytes", F.lit(END))
    body = F.when(revisit, F.col("http")).otherwise(F.concat("http", "payload"))
    header = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {date}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), _header_value(F.col("url"))), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), "sha1",
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), "first", F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("body"), F.lit(END),
    )
    records = (
        rows.join(groups, ["sha1", "bytes"], "left").withColumn("http", http).withColumn("body", body).select(F.concat(header, "body").alias("value"))
    )
    records.write.option("lineSep", END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between magic lines, with their file and split, in file order within a task."""
    return (
        spark.read.option("lineSep", MAGIC).text(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    )


def _located(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int, int, bytes]]:
    """``(path, block, at, piece)``: ``at`` counts bytes from the start of the split's first piece."""
    now, at = None, 0
    for frame in frames:
        for path, block, value in zip(frame["path"], frame["block"], frame["value"], strict=True):
            if (path, block) != now:
                now, at = (path, block), 0
            yield path, block, at, value
            at += len(value) + len(MAGIC)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, sep, v in (line.partition(":") for line in lines) if sep}


def _parsed(piece: bytes) -> tuple[dict[str, str], int, int] | None:
    """Header fields, the block's start in the piece and the record's length, if a record starts here."""
    cut = piece.find(END.encode())
    fields = _fields(piece[:cut]) if cut >= 0 else {}
    if not re.fullmatch(r"[0-9]{1,15}", fields.get("content-length", "")) or "warc-type" not in fields:
        return None
    return fields, cut + len(END), int(fields["content-length"])


def _content(fields: dict[str, str], block: bytes) -> tuple[int | None, str | None]:
    """Bytes and SHA-1 of the full payload: of revisits, as their headers state them."""
    cut = block.find(END.encode())
    payload = block[cut + len(END):] if cut >= 0 else block
    if fields["warc-type"] != "revisit":
        return len(payload), hashlib.sha1(payload).hexdigest()
    stated = _fields(block[: max(cut, 0)]).get("content-length")
    return int(stated) if stated else None, fields.get("warc-payload-digest", "").rpartition(":")[2] or None


def _urn(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", value or "")
    return int(found[1]) if found else None


_RECORD = "id bigint, type string, refers_to bigint, url string, bytes bigint, sha1 string"
_CANDIDATE = f"path string, block bigint, at bigint, next bigint, exit bigint, pre bigint, size bigint, total bigint, whole boolean, {_RECORD}"
_KEYS = ["path", "block", "at", "next", "exit", "pre", "size", "total", "whole", "id", "type", "refers_to", "url", "bytes", "sha1"]


def _typed(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    for c in names:
        if c not in ("path", "whole", "type", "url", "sha1", "payload"):
            out[c] = out[c].astype("Int64")
    return out


def _forest(split: list[list]) -> pd.DataFrame:
    """Fill exit, pre and size of a split's rows; successors always lie further on."""
    at = {row[2]: n for n, row in enumerate(split) if row[3] is not None}
    size = dict.fromkeys(at.values(), 1)
    for n in at.values():  # in file order, so a row's chain has met all that lead to it
        if (up := at.get(split[n][3])) is not None:
            size[up] += size[n]
    free, given = 0, {}
    for n in reversed(at.values()):
        row, up = split[n], at.get(split[n][3])
        if up is None:
            row[4], row[5], free = row[3], free, free + size[n]
        else:
            row[4], row[5] = split[up][4], split[up][5] + 1 + given.get(up, 0)
            given[up] = given.get(up, 0) + size[n]
        row[6] = size[n]
    return _typed([tuple(row) for row in split], _KEYS)


def _candidates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per piece; pieces that don't start a record have no successor."""
    split: list[list] = []
    for path, block, at, piece in _located(frames):
        if split and (path, block) != (split[0][0], split[0][1]):
            yield _forest(split)
            split = []
        row = [path, block, at, *[None] * 4, at + len(piece) + len(MAGIC), False, *[None] * 6]
        # the first piece of a file ends where its first magic starts
        if not (block == 0 and at == 0) and (got := _parsed(piece)):
            fields, start, length = got
            stop = start + length
            row[3] = at + stop + len(END)
            row[8] = len(piece) == stop + len(END) and piece.endswith(END.encode())
            row[9:13] = _urn(fields.get("warc-record-id")), fields["warc-type"], _urn(fields.get("warc-refers-to")), fields.get("warc-target-uri")
            if row[8]:
                row[13:15] = _content(fields, piece[start:stop])
            # offsets are those of the piece, so of the byte after its magic; the successor's are, too
            row[3] += len(MAGIC)
        split.append(row)
    if split:
        yield _forest(split)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``: ``path, offset, id, type, refers_to, url, bytes, sha1``.

    ``bytes`` and ``sha1`` are of the full payload; ids are null where the
    header has none of this writer's. What follows a damaged record in its file
    is not reachable and is left out. No files, or empty ones, give no rows.
    """
    pieces = landed(_pieces(spark, path).mapInPandas(_candidates, _CANDIDATE), "candidates")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        pieces.groupBy("path", "block").agg(F.max("total").alias("total"))
        .select("path", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    )
    pieces = landed(
        pieces.join(splits, ["path", "block"])
        .withColumns({c: F.col(c) + F.col("base") for c in ("at", "next", "exit")})
        .withColumn("stop", F.col("total") + F.col("base")).drop("total", "base"),
        "pieces",
    )
    found = pieces.filter("next is not null")
    start = F.lit(len(MAGIC)).cast("bigint")
    entered = found.select("path", F.col("exit").alias("at")).distinct()
    jumps = landed(found.join(entered.union(found.filter(F.col("at") == start).select("path", "at")).distinct(), ["path", "at"], "left_semi").select("path", "at", F.col("exit").alias("to")), "jumps")
    nodes = jumps.select("path", "at")
    reached = landed(jumps.filter(F.col("at") == start).select("path", "at"), "reached")
    n = reached.count()
    while True:
        onward = reached.join(jumps, ["path", "at"]).select("path", F.col("to").alias("at")).join(nodes, ["path", "at"], "left_semi")
        more = landed(reached.union(onward).distinct(), "reached")
        if (m := more.count()) == n:
            break
        reached, n = more, m
        ahead = jumps.select("path", F.col("at").alias("to"), F.col("to").alias("beyond"))
        jumps = landed(jumps.join(ahead, ["path", "to"]).select("path", "at", F.col("beyond").alias("to")), "jumps")
    entries = found.join(reached, ["path", "at"], "left_semi").select("path", "block", F.col("pre").alias("entry"))
    records = found.join(entries, ["path", "block"]).filter("pre <= entry and entry < pre + size")
    records = records.select("path", F.col("at").alias("offset"), "next", "stop", "whole", "id", "type", "refers_to", "url", "bytes", "sha1")
    names = ["path", "offset", "id", "type", "refers_to", "url", "bytes", "sha1"]
    broken = landed(records.filter("not whole"), "broken")
    out = records.filter("whole").select(*names)
    if broken.isEmpty():
        return out
    return out.unionByName(_joined(spark, path, pieces, splits, broken).select(*names))


def _joined(spark: SparkSession, path: str, pieces: DataFrame, splits: DataFrame, broken: DataFrame) -> DataFrame:
    """Records that hold magic in their payload, put together from their pieces."""
    marks = broken.select("path", F.col("offset").alias("at"), F.struct(F.col("offset").alias("own"), "next").alias("mark"))
    held = pieces.join(broken.select("path").distinct(), "path", "left_semi").select("path", "block", "at").join(marks, ["path", "at"], "left")
    # the record that a piece is in began in its own split, or is the last that began in an earlier one
    inside = Window.partitionBy("path", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    latest = held.groupBy("path", "block").agg(F.max("mark").alias("mark")).select("path", "block", F.last("mark", True).over(earlier).alias("carried"))
    parts = (
        held.withColumn("mark", F.last("mark", True).over(inside)).join(latest, ["path", "block"])
        .withColumn("mark", F.coalesce("mark", "carried")).select("path", "block", "at", "mark.own", "mark.next")
        .filter("own is not null and at < next")
    )
    parts = landed(parts.join(splits, ["path", "block"]).select("path", "block", (F.col("at") - F.col("base")).alias("at"), "own"), "parts")

    def located(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p, block, at, piece in _located(frames):
            yield pd.DataFrame({"path": [p], "block": [block], "at": [at], "value": [piece]})

    def record(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        whole = MAGIC.encode().join(frame.sort_values(["block", "at"])["value"])
        fields, start, length = _parsed(whole)
        block = whole[start:start + length]
        if len(block) < length:  # the file ends early
            return _typed([], ["path", "offset", "id", "type", "refers_to", "url", "bytes", "sha1"])
        row = (key[0], key[1], _urn(fields.get("warc-record-id")), fields["warc-type"], _urn(fields.get("warc-refers-to")), fields.get("warc-target-uri"), *_content(fields, block))
        return _typed([row], ["path", "offset", "id", "type", "refers_to", "url", "bytes", "sha1"])

    found = _pieces(spark, path).mapInPandas(located, "path string, block bigint, at bigint, value binary").join(parts, ["path", "block", "at"])
    return found.groupBy("path", "own").applyInPandas(record, f"path string, offset bigint, {_RECORD}")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query of operator 3: write all of ``pages``, read the archives back."""
    path = shared_folder(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    return read(spark, path).select(
        F.col("id").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to"
    )


QUERIES = {"op3_warc": op3_warc}
ORACLE_SQL = {
    "op3_warc": f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY digest, bytes) AS first FROM p)
SELECT page_id, bytes::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN bytes >= {LEAST_REVISIT} AND page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN bytes >= {LEAST_REVISIT} AND page_id IS DISTINCT FROM first THEN first END AS refers_to FROM g"""
}
