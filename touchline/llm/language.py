"""Operator 8, language identification by a linear-chain conditional random field.

Every word of a text gets a distribution over languages: its features (the
character n-grams of the word between two boundary marks, of which those at a
boundary are its affixes, and its place in a learned lexicon) score each
language, learned transitions tie neighbouring words together, and
forward-backward gives the marginals, so that text that switches between
languages is labelled word by word. A document's language is the one with the
most of its words' probability.

The model is fitted on the driver to a bounded sample of labelled documents,
``PER_LANGUAGE`` of each language on average, with stretches of different
languages spliced together so that transitions are learned, too. Prediction
reads texts only. Features of a run of texts are computed once per distinct
word, over arrays; chains of at most ``CHAIN`` words run side by side.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import by_bytes, table

#: Labelled documents of a language in the sample, on average, and the most words taken from all of them.
PER_LANGUAGE, SAMPLE_WORDS = 300, 1_000_000
#: Feature buckets, longest n-gram, words of the lexicon, words of a chain, of a spliced stretch.
BUCKETS, GRAM, LEXICON, CHAIN, STRETCH = 1 << 17, 4, 20_000, 64, 16
EPOCHS, CHAINS, RATE, DECAY = 3, 256, 0.2, 1e-6
#: Most languages that are learned; most weights of n-grams, and of pairs of labels in a step. They bound the model and the
#: driver's memory: with many languages there are fewer buckets and fewer chains in a step.
MOST_LABELS, CELLS, JOINT = 128, 1 << 20, 1 << 22
UNKNOWN = "und"
#: Bytes of text, and words, whose features are computed at once.
_RUN, _PART = 600_000, 20_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """By code point: 2 for letters, 1 for marks, 0 for the rest."""
    return np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.int8)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Words(NamedTuple):
    """The words of a run of texts; a word is a run of letters and marks with a letter."""

    chars: np.ndarray  # code points, lower case
    start: np.ndarray
    length: np.ndarray
    mark: np.ndarray  # hash of the word
    counts: np.ndarray  # words of each text


def words_of(texts: list[str]) -> Words:
    low = [t.lower() for t in texts]
    chars = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(t) + 1 for t in low])
    kind = np.concatenate([[0], _kinds()[chars], [0]])
    inside = kind > 0
    start, stop = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
    if len(start):
        lettered = np.maximum.reduceat(kind[1:], start) == 2  # up to the next start there are no other kinds but 0
        start, stop = start[lettered], stop[lettered]
    length = stop - start
    counts = np.diff(np.concatenate([[0], np.searchsorted(start, ends)]))
    mark = np.zeros(len(start), np.uint64)
    if len(start):
        with np.errstate(over="ignore"):
            place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            power = np.multiply.accumulate(np.full(int(length.max()), _MIX))
            flat = _mixed(chars[np.repeat(start, length) + place].astype(np.uint64) + np.uint64(7)) * power[place]
            mark = _mixed(np.add.reduceat(flat, np.cumsum(length) - length))
    return Words(chars, start, length, mark, counts)


def features(words: Words, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of the words ``some``, one after the other, and where each word's begin."""
    length = words.length[some]
    wide = length + 2
    begin = np.cumsum(wide) - wide
    padded = np.full(int(wide.sum()), 1, np.uint64)
    padded[begin + wide - 1] = 2
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    padded[np.repeat(begin + 1, length) + place] = words.chars[np.repeat(words.start[some], length) + place].astype(np.uint64) + np.uint64(3)
    owner = np.repeat(np.arange(len(some)), wide)
    left = np.repeat(begin + wide, wide) - np.arange(len(padded))  # characters from here to the word's end
    found, owners = [], []
    with np.errstate(over="ignore"):
        gram = np.zeros(len(padded), np.uint64)
        for n in range(1, GRAM + 1):
            gram[: len(padded) - n + 1] = _mixed(gram[: len(padded) - n + 1] * _MIX + padded[n - 1 :])
            ok = left >= n
            found.append((gram[ok] + np.uint64(n)) * _MIX >> np.uint64(64 - BUCKETS.bit_length() + 1))
            owners.append(owner[ok])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    bounds = np.searchsorted(owners[order], np.arange(len(some)))
    return np.concatenate(found)[order].astype(np.int64), bounds


class Model(NamedTuple):
    labels: list[str]
    grams: np.ndarray  # bucket x label
    lexicon: np.ndarray  # sorted word hashes
    lexical: np.ndarray  # lexicon word x label
    moves: np.ndarray  # label x label
    first: np.ndarray


def _lexical(lexicon: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Lexicon number of each word; the last one, whose weights are zero, for others."""
    if not len(lexicon):
        return np.zeros(len(marks), np.int64)
    at = np.minimum(np.searchsorted(lexicon, marks), len(lexicon) - 1)
    return np.where(lexicon[at] == marks, at, len(lexicon))


def marginals(model: Model, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Forward-backward over chains, words x labels; ``scores`` holds the chains one after the other."""
    n, labels = len(lengths), len(model.labels)
    most = int(lengths.max())
    where = (np.cumsum(lengths) - lengths)[:, None] + np.arange(most)
    real = np.arange(most) < lengths[:, None]
    emitted = np.ones((most, n, labels))
    emitted[real.T] = np.exp(scores - scores.max(axis=1, keepdims=True))[where.T[real.T]]
    move = np.exp(model.moves - model.moves.max())
    ahead = np.empty((most, n, labels))
    now = np.exp(model.first - model.first.max()) * emitted[0]
    ahead[0] = now / now.sum(axis=1, keepdims=True)
    for t in range(1, most):
        now = ahead[t - 1] @ move * emitted[t]
        ahead[t] = now / now.sum(axis=1, keepdims=True)
    back = np.ones((n, labels))
    for t in range(most - 1, -1, -1):
        if t + 1 < most:  # behind a chain's end everything is possible
            now = (emitted[t + 1] * back) @ move.T
            back = np.where(real[:, t + 1, None], now / now.sum(axis=1, keepdims=True), 1.0)
        ahead[t] *= back
    out = np.empty_like(scores)
    out[where.T[real.T]] = ahead[real.T]
    return out / out.sum(axis=1, keepdims=True)


def _chains(counts: np.ndarray) -> np.ndarray:
    """Lengths of the chains of texts of so many words."""
    full, rest = np.divmod(counts, CHAIN)
    lengths = [np.append(np.full(f, CHAIN), r) if r else np.full(f, CHAIN) for f, r in zip(full, rest, strict=True)]
    return np.concatenate(lengths).astype(np.int64) if lengths else np.zeros(0, np.int64)


def fitted(texts: list[str], langs: list[str]) -> Model:
    """The model of labelled texts, by stochastic gradient descent on the chains' likelihood."""
    labels = sorted(set(langs))
    size = len(labels)
    words = words_of(texts)
    label = np.repeat([labels.index(x) for x in langs], words.counts) if langs else np.zeros(0, np.int64)
    marks, one, of = np.unique(words.mark, return_index=True, return_inverse=True)
    common = np.sort(marks[np.argsort(-np.bincount(of, minlength=len(marks)), kind="stable")[:LEXICON]])
    buckets = BUCKETS
    while buckets * size > CELLS and buckets > 1024:  # with more languages, fewer buckets
        buckets //= 2
    chains = max(1, min(CHAINS, JOINT // (CHAIN * max(1, size) ** 2)))
    model = Model(labels, np.zeros((buckets, size)), common, np.zeros((len(common) + 1, size)), np.zeros((size, size)), np.zeros(size))
    if not len(marks) or size < 2:
        return model
    found, spans = [], []
    for at in range(0, len(one), _PART):  # in parts, as the intermediate arrays are larger than the result
        part, begins = features(words, one[at : at + _PART])
        found.append((part % buckets).astype(np.int32)), spans.append(np.diff(np.append(begins, len(part))))
    found, spans = np.concatenate(found), np.concatenate(spans)
    bounds = np.cumsum(spans) - spans
    lexical = _lexical(common, marks)
    # stretches of words; a chain is four in a row or four of anywhere
    text = np.repeat(np.arange(len(texts)), words.counts)
    place = np.arange(len(text)) - np.repeat(np.cumsum(words.counts) - words.counts, words.counts)
    starts = np.flatnonzero(place % STRETCH == 0)
    sizes = np.diff(np.append(starts, len(text)))
    random = np.random.Generator(np.random.PCG64(8))
    squares = [np.full(x.shape, 1e-3) for x in (model.grams, model.lexical, model.moves, model.first)]
    per = CHAIN // STRETCH
    for _ in range(EPOCHS):
        runs = np.arange(len(starts))
        runs = runs[: len(runs) // per * per].reshape(-1, per) if len(runs) >= per else runs[None]
        rows = random.permutation(len(runs))
        spliced = runs[rows[: len(rows) // 2]]
        spliced = random.permutation(spliced.reshape(-1)).reshape(spliced.shape)
        runs = random.permutation(np.concatenate([spliced, runs[rows[len(rows) // 2 :]]]))
        for at in range(0, len(runs), chains):
            part = runs[at : at + chains]
            which = np.concatenate([np.arange(starts[s], starts[s] + sizes[s]) for s in part.reshape(-1)])
            lengths = sizes[part].sum(axis=1)
            seen, back = np.unique(of[which], return_inverse=True)
            flat = np.concatenate([found[bounds[u] : bounds[u] + spans[u]] for u in seen])
            cuts = np.cumsum(spans[seen]) - spans[seen]
            scores = (np.add.reduceat(model.grams[flat], cuts) + model.lexical[lexical[seen]])[back]
            gold = np.zeros_like(scores)
            gold[np.arange(len(which)), label[which]] = 1
            off = marginals(model, scores, lengths)
            # neighbours' joint probability, by the product of their marginals and the transition
            begins = np.cumsum(lengths) - lengths
            inner = np.ones(len(which), bool)
            inner[begins] = False
            b = np.flatnonzero(inner)
            both = off[b - 1][:, :, None] * np.exp(model.moves - model.moves.max()) * np.exp(scores[b] - scores[b].max(axis=1, keepdims=True))[:, None, :]
            both /= both.sum(axis=(1, 2), keepdims=True)
            wanted = np.zeros((size, size))
            np.add.at(wanted, (label[which][b - 1], label[which][b]), 1)
            slope = off - gold
            each = np.stack([np.bincount(back, slope[:, k], len(seen)) for k in range(size)], axis=1)
            spread = np.repeat(each, spans[seen], axis=0)
            slopes = [
                np.stack([np.bincount(flat, spread[:, k], buckets) for k in range(size)], axis=1),
                np.stack([np.bincount(lexical[seen], each[:, k], len(common) + 1) for k in range(size)], axis=1),
                both.sum(axis=0) - wanted,
                (off[begins] - gold[begins]).sum(axis=0),
            ]
            for value, square, d in zip((model.grams, model.lexical, model.moves, model.first), squares, slopes, strict=True):
                square += d * d
                value -= RATE * (d / np.sqrt(square) + DECAY * value)
            model.lexical[-1] = 0
    return model._replace(grams=model.grams.astype(np.float32), lexical=model.lexical.astype(np.float32))


def labelled(model: Model, texts: list[str]) -> tuple[Words, np.ndarray]:
    """The words of the texts and their distributions over the labels."""
    words = words_of(texts)
    if not len(words.mark):
        return words, np.zeros((0, len(model.labels)))
    marks, one, of = np.unique(words.mark, return_index=True, return_inverse=True)
    found, bounds = features(words, one)
    scores = np.add.reduceat(model.grams[found % len(model.grams)], bounds).astype(np.float64) + model.lexical[_lexical(model.lexicon, marks)]
    return words, marginals(model, scores[of], _chains(words.counts))


def languages(model: Model, texts: list[str], unlearned: str | None = UNKNOWN) -> tuple[list[str | None], list[float]]:
    """The language of each text and the share of its words' probability that is its.

    Without labels it is ``unlearned`` for texts with a word.
    """
    if not model.labels:
        return [unlearned if n else UNKNOWN for n in words_of(texts).counts], [0.0] * len(texts)
    words, found = labelled(model, texts)
    ends = np.concatenate([[0], np.cumsum(words.counts)])
    total = np.concatenate([np.zeros((1, len(model.labels))), np.cumsum(found, axis=0)])
    share = (total[ends[1:]] - total[ends[:-1]]) / np.maximum(words.counts, 1)[:, None]
    best = share.argmax(axis=1)
    has = words.counts > 0
    return [model.labels[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)], np.clip(np.where(has, share.max(axis=1), 0.0), 0, 1).tolist()


def held_out(id_column: Column) -> Column:
    """Documents that nothing is learned from; those without an id are."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _longest(lengths: list[int], room: int) -> int:
    """The length to which texts are cut so that all of them fit into ``room``."""
    for n, x in enumerate(sorted(lengths)):
        if x * (len(lengths) - n) > room:
            return room // (len(lengths) - n)
        room -= x
    return max(lengths)


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], list[str]]:
    """Texts and languages of a bounded sample of the labelled rows that may be learned from.

    Of more than ``MOST_LABELS`` languages the commonest are learned. All rows are counted,
    then rows are chosen by a hash of their id, at a rate
    that gives ``per_language`` rows of each language on average, and one at
    least. Every language has the same share of the sample's characters; if its
    texts are longer, the longest give their first part only.
    """
    rows = docs.filter("lang is not null and text is not null").filter(~held_out(F.col("doc_id"))).select("text", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("draw"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("draw").alias("least")).orderBy(F.col("n").desc(), "lang").limit(MOST_LABELS).collect()
    if not counts:
        return [], []
    chosen = F.lit(False)
    for r in counts:
        most = max(int(min(1.0, per_language / r["n"]) * (1 << 30)), r["least"] + 1)
        chosen |= (F.col("lang") == F.lit(r["lang"])) & (F.col("draw") < F.lit(most))
    some = rows.filter(chosen).withColumns({"tie": F.xxhash64("text"), "length": F.length("text")})
    first = Window.partitionBy("lang").orderBy("draw", "tie")

    def taken(columns: DataFrame) -> DataFrame:
        return columns.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= 2 * per_language)

    lengths: dict[str, list[int]] = {}
    for r in taken(some.select("lang", "draw", "tie", "length")).collect():
        lengths.setdefault(r["lang"], []).append(r["length"])
    room = max(SAMPLE_WORDS * 8 // len(counts), 1)
    longest = F.when(F.lit(False), F.lit(0))
    for lang, of in lengths.items():
        longest = longest.when(F.col("lang") == F.lit(lang), F.lit(_longest(of, room)))
    found = taken(some.select("lang", "draw", "tie", F.substring("text", F.lit(1), longest).alias("text"))).collect()
    found = sorted(found, key=lambda r: (r["draw"], r["lang"], r["text"]))
    return [r["text"] for r in found], [r["lang"] for r in found]


def predict(docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score"), unlearned: str | None = UNKNOWN) -> DataFrame:
    """``docs`` with the language of each text and its score, under the given names.

    Null and empty texts and texts without a letter are ``und`` with score 0. If
    there was nothing to learn from, all others are ``unlearned``, with score 0.
    No shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in by_bytes(batches, "text", _RUN):
            langs, scores = languages(sent.value, texts, unlearned)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{names[0]}` string, `{names[1]}` double")


def identify(docs: DataFrame, names: tuple[str, str] = ("lang_pred", "score"), unlearned: str | None = UNKNOWN) -> DataFrame:
    """Fit on the labelled rows of ``docs`` and predict all of them."""
    return predict(docs, fitted(*sample(docs)), names, unlearned)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query of operator 8 over all of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), fitted(*sample(docs)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {"op8_language_id": op8_language_id}
ORACLE_SQL: dict[str, str] = {}
