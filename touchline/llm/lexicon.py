"""Operator 7, BPE encoding and decoding with a transducer lexicon.

The words of the whole corpus are counted, and the most frequent ones are
merged once and compiled into a minimal acyclic transducer: an automaton that
shares prefixes and suffixes, whose arc outputs add up to a word's number and
so to its ids. Its arrays are one block of bytes that tasks map into memory.
A task looks up all distinct words of a run of texts at once, walking the
automaton byte by byte over whole arrays; words that it doesn't hold are merged
exactly by rank. The lexicon's choice of words never changes a result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import by_bytes, landed, shared_folder, table

#: Words of the lexicon, and their most bytes.
WORDS, WORD_BYTES = 131_072, 48
#: Distinct words that a task counts, or merged words that it keeps, at a time.
HELD = 200_000

# The tokenizer's pattern over characters up to U+024F, whose letters, numbers and spaces are these.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\\t-\\r \x85\xa0"
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_BEYOND = re.compile("[^\x00-ɏ]")


class WordBpe:
    """The words of texts, and the exact merges of a word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        vocab, merges, end = model["model"]["vocab"], model["model"]["merges"], model["model"]["end_of_word_suffix"]
        own = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160, 173)]
        char = {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in own)}
        self.inner, self.last = ([vocab[char[b] + tail] for b in range(256)] for tail in ("", end))
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        self.tokens = np.array([tokens[i] for i in range(len(tokens))], object)

    def _plain(self, text: str) -> list[str]:
        low = text.replace("Σ", "σ").lower()
        if not _BEYOND.search(low) and not _BEYOND.search(text):
            return _SPLIT.findall(low)
        # other characters: the file's own normalizer and pattern
        low = self.library.normalizer.normalize_str(text)
        return [low[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(low)]

    def words(self, text: str) -> list[str]:
        """The words of a text; a special token is a word of its own, which no other text gives."""
        if any(s in text for s in self.specials):
            return [w for part in self.special.split(text) for w in ([part] if part in self.specials else self._plain(part))]
        return self._plain(text)

    def merged(self, word: str) -> list[int]:
        """The ids of a word: of all adjacent pairs the one of least rank is merged, leftmost first."""
        if word in self.specials:
            return [self.specials[word]]
        data = word.encode()
        ids = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        if len(ids) > 64:
            return self._long(ids)
        merges = self.merges
        while len(ids) > 1:
            best, at = None, 0
            for n, pair in enumerate(zip(ids, ids[1:])):
                found = merges.get(pair)
                if found and (best is None or found < best):
                    best, at = found, n
            if best is None:
                break
            ids[at : at + 2] = [best[1]]
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """The same by a heap of pairs over a linked list, for words of any length."""
        after, before, heap = [*range(1, len(ids)), -1], list(range(-1, len(ids) - 1)), []
        push = lambda a, b: (m := self.merges.get((ids[a], ids[b]))) and heapq.heappush(heap, (m[0], a, b, ids[a], ids[b], m[1]))
        for n in range(len(ids) - 1):
            push(n, n + 1)
        while heap:
            _, a, b, left, right, new = heapq.heappop(heap)
            if ids[a] != left or ids[b] != right or after[a] != b:
                continue
            ids[a], ids[b], after[a] = new, -1, after[b]
            if after[a] >= 0:
                before[after[a]] = a
                push(a, after[a])
            if before[a] >= 0:
                push(before[a], a)
        return [i for i in ids if i >= 0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids as the library gives it for this file: their tokens, joined by spaces."""
        return " ".join(self.tokens[ids].tolist())


@lru_cache(maxsize=1)
def _bpe(path: str) -> WordBpe:
    return WordBpe(path)


def compiled(words: Iterable[bytes], ids: list[list[int]]) -> bytes:
    """A minimal acyclic transducer of sorted distinct words, as bytes to be mapped.

    Words are added in order; the states of the previous word beyond the common
    prefix are then complete and are replaced by equal ones that exist already.
    """
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    path: list[list] = [[False, []]]  # of the last word: final, arcs
    previous = b""

    def freeze(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            path[-1][1][-1] = (path[-1][1][-1][0], register[key])

    for word in words:
        common = next((n for n, (a, b) in enumerate(zip(previous, word)) if a != b), min(len(previous), len(word)))
        freeze(common)
        for byte in word[common:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        previous = word
    freeze(0)
    states.append((path[0][0], tuple(path[0][1])))  # the start is the last state
    counts: list[int] = []
    key, target, output = [], [], []
    for n, (final, arcs) in enumerate(states):
        total = int(final)
        for byte, to in arcs:
            key.append(n * 256 + byte), target.append(to), output.append(total)
            total += counts[to]
        counts.append(total)
    starts = np.cumsum([0, *map(len, ids)])
    parts = [
        np.array(key, "<i8"), np.array(target, "<i8"), np.array(output, "<i8"), np.array([f for f, _ in states], "<i8"),
        starts.astype("<i8"), np.array([i for x in ids for i in x], "<i8"),
    ]
    return b"".join([np.array([len(p) for p in parts], "<i8").tobytes(), *(p.tobytes() for p in parts)])


class Transducer:
    """The compiled lexicon, mapped into memory from a file, or from bytes."""

    def __init__(self, source: str | bytes):
        mapped = np.frombuffer(source, "<i8") if isinstance(source, bytes) else np.memmap(source, "<i8", "r")
        ends = np.cumsum([6, *mapped[:6]])
        self.key, self.target, self.output, self.final, self.starts, self.ids = (mapped[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for words that it doesn't hold."""
        number = np.full(len(words), -1, np.int64)
        if not len(self.key) or not words:
            return number
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] <= WORD_BYTES]
        data = np.frombuffer(b"".join(words) + b" ", np.uint8)
        begin = np.cumsum(lengths) - lengths
        state = np.full(len(words), len(self.final) - 1, np.int64)
        total = np.zeros(len(words), np.int64)
        alive = order
        for n in range(WORD_BYTES):
            alive = alive[: np.searchsorted(-lengths[alive], -n)]
            if not len(alive):
                break
            key = state[alive] * 256 + data[begin[alive] + n]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[at] == key
            state[alive[~hit]] = -1
            alive, at = alive[hit], at[hit]
            state[alive] = self.target[at]
            total[alive] += self.output[at]
        done = order[state[order] >= 0]
        done = done[self.final[state[done]] == 1]
        number[done] = total[done]
        return number


class _Numbers(dict):
    """Words numbered in order of appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Encoder:
    """Ids of texts from a transducer and, for unseen words, exact merges."""

    def __init__(self, bpe: WordBpe, lexicon: Transducer):
        self.bpe, self.lexicon, self.unseen = bpe, lexicon, {}

    def _merged(self, word: str) -> list[int]:
        if (found := self.unseen.get(word)) is None:
            if len(self.unseen) >= HELD:
                self.unseen.clear()
            self.unseen[word] = found = self.bpe.merged(word)
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.bpe.words(t) for t in texts]
        numbers = _Numbers()
        codes = np.fromiter((numbers[w] for words in split for w in words), np.int64, sum(map(len, split)))
        distinct = list(numbers)
        number = self.lexicon.find([w.encode() for w in distinct])
        known = number >= 0
        unseen = [self._merged(distinct[n]) for n in np.flatnonzero(~known)]
        # ids of all distinct words in one array: the lexicon's, then those of unseen words
        start, length = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        start[known] = self.lexicon.starts[number[known]]
        length[known] = self.lexicon.starts[number[known] + 1] - start[known]
        length[~known] = [len(x) for x in unseen]
        start[~known] = len(self.lexicon.ids) + np.cumsum(length[~known]) - length[~known]
        flat = np.concatenate([self.lexicon.ids, np.array([i for x in unseen for i in x], np.int64)])
        ends = np.cumsum(length[codes])
        ids = flat[np.repeat(start[codes] - ends + length[codes], length[codes]) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.cumsum([len(words) for words in split])
        return np.split(ids, np.concatenate([[0], ends])[cuts[:-1]])


def frequent_words(docs: DataFrame, tokenizer: str, text_col: str = "text", words: int = WORDS) -> list[str]:
    """The most frequent words of all texts, ``words`` at most.

    Words are taken by classes of similar counts, most frequent first, as long
    as whole classes fit: the classes' sizes are all that is needed to choose.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, found = _bpe(tokenizer), Counter()
        give = lambda: pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])
        for _, texts in by_bytes(batches, "text"):
            for text in texts:
                found.update(w for w in bpe.words(text) if len(w) <= WORD_BYTES)
            if len(found) > HELD:
                yield give()
                found.clear()
        yield give()

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    rank = F.floor(F.log2("n") * 16).cast("int")
    counted = landed(counted.filter(F.octet_length("word") <= WORD_BYTES), "words")
    least, left = None, words
    for r in sorted(counted.groupBy(rank.alias("rank")).count().collect(), reverse=True):
        if (left := left - r["count"]) < 0:
            break
        least = r["rank"]
    return [] if least is None else [r["word"] for r in counted.filter(rank >= least).select("word").collect()]


def lexicon_of(found: list[str], tokenizer: str) -> bytes:
    bpe = _bpe(tokenizer)
    ordered = sorted((w.encode(), w) for w in found)
    return compiled([b for b, _ in ordered], [bpe.merged(w) for _, w in ordered])


def published(spark: SparkSession, blob: bytes) -> str:
    """Write the compiled lexicon to shared storage and have Spark bring it to every executor, once each; its name there."""
    name = f"lexicon-{uuid.uuid4().hex}"
    path = f"{shared_folder(spark, 'lexicon')}/{name}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p)
    out.write(bytearray(blob))
    out.close()
    spark.sparkContext.addFile(path)
    return name


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, full: bool = True) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if ``full``, ``ids`` and ``decoded``.

    A null or empty text has no ids and decodes to an empty text. Repeated rows
    give repeated results, a null id stays null, other columns are not read. The
    lexicon, of ``words`` words of at most ``WORD_BYTES`` bytes, is a file of a few
    megabytes at any size of the input, which an executor fetches once.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    name = published(docs.sparkSession, lexicon_of(frequent_words(docs, tokenizer, text_col, words), tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(tokenizer)
        encoder = Encoder(bpe, Transducer(SparkFiles.get(name)))
        for batch, texts in by_bytes(batches, "text"):
            ids = encoder.encode(texts)
            decoded = [bpe.decode(x) for x in ids]
            columns = [
                batch.column("id"), pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
            ]
            if full:
                columns += [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * full])

    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if full else "")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query of operator 7 over all of ``documents``."""
    return encode(table(spark, sf_dir, "documents"), default_tokenizer(), full=False)


QUERIES = {"op7_word_bpe": op7_word_bpe}
ORACLE_SQL: dict[str, str] = {}
