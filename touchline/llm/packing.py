"""Operator 10, packing by Karmarkar-Karp multiway differencing.

Tokenizing cuts every document into pieces that fill a window by themselves and
one shorter rest. The rests are dealt into groups of about ``WINDOWS`` windows by
a number that their task gave them (no key of the data, so no group is hot), and
each group is packed by itself: every rest starts as a partial partition of its own,
the two partial partitions with the largest differences are merged again and again,
fullest window onto emptiest, and the last one is a partition into near-equal
windows. Rests stay whole but for what exceeds the capacity: where a window does, the end
of its longest piece is cut off and goes where there is room, and when there is none any
more the window count rises. So a cut needs no ids: pieces bring the checksums of their
beginnings, at every ``GRAIN`` ids, and checksums of parts follow from these.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import by_bytes, landed, table

CAPACITY = 1024
#: Rests are cut at multiples of so many ids.
GRAIN = 32
#: Windows of a group, about.
WINDOWS = 192
# The tokenizer's own pattern before the merges; for characters up to U+024F the libraries agree on its classes.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BEYOND = re.compile("[^\x00-\u024F]")


class Encoder:
    """Byte-level BPE ids of texts, those of the ``tokenizers`` library for the given file.

    The file's vocabulary is in merge order, so the faster rank-based encoder of
    ``tiktoken`` gives the same ids. Texts with other characters, on whose
    classes the libraries' Unicode versions may differ, and texts that are too
    much for its pattern (very long runs of spaces) go through ``tokenizers``.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.specials = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        # the alphabet's characters stand for bytes: printable ones for themselves, the others in order from U+0100
        own = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160, 173)]
        byte = {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in own)}
        if set(byte) != set(ByteLevel.alphabet()):
            raise ValueError("the byte alphabet differs")
        ranks = {bytes(byte[c] for c in token): i for token, i in self.library.get_vocab(False).items()}
        self.fast = tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _plain(self, text: str) -> list[int]:
        if not _BEYOND.search(text):
            try:
                return self.fast.encode_ordinary(text)
            except ValueError:
                pass
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        if self.special and any(s in text for s in self.specials):
            return [i for part in self.special.split(text) for i in ([self.specials[part]] if part in self.specials else self._plain(part))]
        return self._plain(text)


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Documents as pieces ``doc_id, start, length, ids_crc32, doc_tokens, salt, marks`` (and ``ids``).

    A document's ids are those of its text followed by ``end_id``: an empty or
    null text has that one id, so each row has a piece. Full windows come
    first, then the rest. ``salt`` numbers the pieces uniquely; ``marks`` holds the
    checksums of the rest's beginnings of ``GRAIN``, ``2 * GRAIN`` … ids.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, salt bigint, marks array<bigint>" + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        salt = TaskContext.get().partitionId() << 33
        for batch, texts in by_bytes(batches, "text"):
            row, start, length, crc, total, marks, ids = [], [], [], [], [], [], []
            for n, text in enumerate(texts):
                found = np.array([*encoder.encode(text), end_id], "<u4").tobytes()
                count = len(found) // 4
                for a in range(0, count, capacity):
                    b = min(a + capacity, count)
                    data, sums, value = found[4 * a : 4 * b], None, 0
                    if b - a < capacity:
                        sums = []
                        for at in range(0, len(data) - len(data) % (4 * GRAIN), 4 * GRAIN):
                            value = zlib.crc32(data[at : at + 4 * GRAIN], value)
                            sums.append(value)
                    row.append(n), start.append(a), length.append(b - a), crc.append(zlib.crc32(data)), total.append(count), marks.append(sums)
                    if with_ids:
                        ids.append(data)
            columns = [batch.column("id").take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total, range(salt, salt + len(row)))), pa.array(marks, pa.list_(pa.int64()))]
            salt += len(row)
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt", "marks", *["ids"] * with_ids])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def part_crc32(marks: list[int], whole: int, length: int, a: int, b: int) -> int:
    """The checksum of ids ``a`` to ``b`` of a rest, ``a`` a multiple of ``GRAIN`` and ``b``, too, or its end.

    A checksum of two parts is that of the first, carried over as many zero bytes as the
    second has, xor that of the second.
    """
    upto = lambda n: whole if n == length else marks[n // GRAIN - 1] if n else 0
    carried = zlib.crc32(bytes(4 * (b - a)), upto(a) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF if a else 0
    return upto(b) ^ carried


def differencing(lengths: np.ndarray, windows: int) -> np.ndarray:
    """The window of each piece by Karmarkar-Karp multiway differencing.

    A partial partition holds its windows' sums above the smallest one, in
    descending order. Ties go by the order in which partitions were made.
    """
    n = len(lengths)
    heap: list[tuple[int, int, np.ndarray]] = []
    for i in range(n):
        sums = np.zeros(windows, np.int64)
        sums[0] = lengths[i]
        heap.append((-int(lengths[i]), i, sums))
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heap[0]
        sums = left + right[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        sums -= sums[-1]
        heapq.heapreplace(heap, (-int(sums[0]), n + len(merges), sums))
        merges.append((a, b, order))
    # from the last merge back: the final window of each slot of a partial partition
    slots: dict[int, np.ndarray] = {heap[0][1]: np.arange(windows)}
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        final = np.empty(windows, np.int64)
        final[order] = slots.pop(n + k)
        slots[a], slots[b] = final, final[::-1]
    return np.array([slots[i][0] for i in range(n)], np.int64)


def fitted(lengths: np.ndarray, capacity: int) -> list[tuple[int, int, int, int]]:
    """``(piece, from, to, window)`` of every part: pieces stay whole where their window has room for them.

    No window exceeds the capacity. A window that differencing fills beyond it gives the end
    of its longest piece, down to a multiple of ``GRAIN``, to the fullest window with room for
    it, or in parts to the emptiest ones; what finds no room opens a new window.
    """
    k = max(1, -(-int(lengths.sum()) // capacity))
    window = differencing(lengths, k)
    room = (capacity - np.bincount(window, lengths, k).astype(np.int64)).tolist()
    parts = [[0, int(n), int(w)] for n, w in zip(lengths, window)]
    members: dict[int, list[int]] = {}
    for i, w in enumerate(window.tolist()):
        members.setdefault(w, []).append(i)
    loose: list[tuple[int, int, int]] = []
    for w in np.flatnonzero(np.array(room) < 0).tolist():
        while room[w] < 0:
            i = max(members[w], key=lambda i: (parts[i][1], -i))
            keep = max(0, parts[i][1] + room[w]) // GRAIN * GRAIN
            loose.append((i, keep, parts[i][1]))
            room[w] += parts[i][1] - keep
            parts[i][1] = keep
    out = [(i, a, b, w) for i, (a, b, w) in enumerate(parts) if b > a]
    for i, a, b in sorted(loose, key=lambda x: (x[1] - x[2], x[0])):
        while a < b:
            fits = [w for w, r in enumerate(room) if r >= b - a]
            if fits:
                w, end = min(fits, key=lambda w: (room[w], w)), b
            else:
                w = max(range(len(room)), key=lambda w: (room[w], -w))
                end = a + room[w] // GRAIN * GRAIN
                if end == a:
                    room.append(capacity)
                    continue
            out.append((i, a, end, w))
            room[w] -= end - a
            a = end
    return out


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, rests cut where they must be; windows are gapless."""
    found = landed(found, "pieces")
    rest = found.filter(F.col("length") < capacity)
    tokens = rest.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(tokens / (capacity * WINDOWS)))
    full = found.filter(F.col("length") == capacity).drop("marks").withColumn("sequence_id", F.col("salt") * 2 + 1).withColumn("offset", F.lit(0).cast("bigint"))

    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by("salt")
        lengths, crcs, marks = group.column("length").to_numpy().astype(np.int64), group.column("ids_crc32").to_pylist(), group.column("marks").to_pylist()
        parts = sorted(fitted(lengths, capacity), key=lambda p: (p[3], p[0], p[1]))
        piece, a, b, window = (np.array(x, np.int64) for x in zip(*parts))
        ends = np.cumsum(b - a)
        first = np.concatenate([[True], np.diff(window) > 0])
        begins = ends - (b - a)
        offset = begins - begins[np.maximum.accumulate(np.where(first, np.arange(len(window)), 0))]
        out = group.take(pa.array(piece))
        put = lambda t, c, v: t.set_column(t.column_names.index(c), c, v)
        out = put(out, "start", pa.array(out.column("start").to_numpy() + a))
        out = put(out, "length", pa.array(b - a))
        out = put(out, "ids_crc32", pa.array([part_crc32(marks[i], crcs[i], int(lengths[i]), x, y) for i, x, y, _ in parts], pa.int64()))
        if "ids" in out.column_names:
            out = put(out, "ids", pa.array([v[4 * x : 4 * y] for v, (_, x, y, _) in zip(out.column("ids").to_pylist(), parts)], pa.binary()))
        sequence = (out.column("g").to_numpy().astype(np.int64) << 32 | window) * 2
        return out.drop_columns(["g", "marks"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.schema)
    dealt = rest.withColumn("g", F.pmod(F.xxhash64("salt"), F.lit(groups)))
    packed = dealt.groupBy("g").applyInArrow(place, schema)
    return full.unionByName(packed)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query of operator 10 over all of ``documents``."""
    return pack(pieces(table(spark, sf_dir, "documents"), default_tokenizer())).drop("salt")


QUERIES = {"op10_packing": op10_packing}
ORACLE_SQL: dict[str, str] = {}
