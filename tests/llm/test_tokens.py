"""Operators 7 and 10 against the tokenizers library; the transducer; packing; operator 8 held out; the pipeline."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from cases import ODD, make_docs, sf  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from touchline.llm import language, lexicon, packing

import corpus_pipeline

WORD, BYTE = lexicon.default_tokenizer(), packing.default_tokenizer()


def _mixed(n):
    r = random.Random(1)
    pick = lambda: chr(r.choice([r.randrange(0, 0x250), r.randrange(0, 128), 32, 39, r.randrange(0, 0x3000), r.randrange(0x300, 0x310)]))
    return ["".join(pick() for _ in range(r.randrange(40))) for _ in range(n)]


def test_word_bpe_equals_the_library():
    bpe = lexicon._bpe(WORD)
    texts = [t or "" for t in ODD] + _mixed(500) + ["!" * 3000, "ab" * 3000, "ΑΣ Σ ς İstanbul K ȺȾ <|endof", "a<|startoftext|>b<|endoftext|>"]
    for found in ([], ["the", "of", "x" * 40000][:2], sorted({w for t in texts for w in bpe.words(t)})[::2]):
        encoder = lexicon.Encoder(bpe, lexicon.Transducer(lexicon.lexicon_of([w for w in found if len(w.encode()) <= lexicon.WORD_BYTES], WORD)))
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            want = bpe.library.encode(text, add_special_tokens=False).ids
            assert ids.tolist() == want, text[:50]
            assert bpe.decode(ids) == bpe.library.decode(want, skip_special_tokens=False)


@settings(max_examples=50, deadline=None)
@given(st.sets(st.text("abc\x00é", min_size=1, max_size=6), max_size=40), st.lists(st.text("abc\x00é", max_size=6), max_size=20))
def test_transducer(words, others):
    ordered = sorted(w.encode() for w in words)
    t = lexicon.Transducer(lexicon.compiled(ordered, [[n] for n in range(len(ordered))]))
    asked = ordered + [w.encode() for w in others]
    assert t.find(asked).tolist() == [ordered.index(w) if w in ordered else -1 for w in asked]


def test_transducer_is_minimal():
    words = sorted(a.encode() + b for a in "abcdefgh" for b in (b"ing", b"ings", b"ed"))
    t = lexicon.Transducer(lexicon.compiled(words, [[0]] * len(words)))
    assert len(t.final) == 7  # start, shared stem, i, in, ing, e, end


def test_word_bpe_table(spark, make_docs):  # noqa: F811
    rows = [*enumerate(ODD), (2, ODD[5]), (None, "the word")]
    got = lexicon.encode(make_docs(rows), WORD).collect()
    bpe = lexicon._bpe(WORD)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["ids"], r["decoded"]) for r in got) == sorted(
        (-1 if i is None else i, bpe.library.encode(t or "", add_special_tokens=False).ids, bpe.library.decode(bpe.library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, t in rows
    )
    assert lexicon.encode(make_docs([]), WORD).count() == 0


def test_byte_encoder_equals_the_library():
    encoder = packing._encoder(BYTE)
    for text in [t or "" for t in ODD] + _mixed(500) + [" " * 300000 + "x", "a<|endoftext|>b <|endoftext|>"]:
        assert encoder.encode(text) == encoder.library.encode(text, add_special_tokens=False).ids, text[:50]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 256), min_size=1, max_size=200))
def test_rests_fit_and_stay_whole_where_they_can(lengths):
    lengths = np.array(lengths)
    parts = packing.fitted(lengths, 256)
    sums, covered = {}, {}
    for i, a, b, w in parts:
        assert a < b and a % packing.GRAIN == 0 and (b % packing.GRAIN == 0 or b == lengths[i])
        sums[w] = sums.get(w, 0) + b - a
        covered.setdefault(i, []).append((a, b))
    assert max(sums.values()) <= 256 and set(sums) == set(range(len(sums)))
    for i, n in enumerate(lengths.tolist()):
        at = 0
        for a, b in sorted(covered[i]):
            assert a == at
            at = b
        assert at == n
    # windows that lose less than a grain each to the cuts
    assert len(sums) <= -(-int(lengths.sum()) // (256 - packing.GRAIN)) + 1
    assert len(parts) <= 2 * (len(lengths) + len(sums))


def test_differencing_against_the_best_partition():
    """Small cases, all partitions tried: never beyond 4/3 of the best fullest window, and mostly the best itself."""
    r, same = random.Random(5), 0
    for _ in range(60):
        lengths, k = [r.randint(1, 60) for _ in range(r.randint(2, 8))], r.randint(2, 3)
        best = min(max(sum(n for n, w in zip(lengths, ws) if w == x) for x in range(k)) for ws in itertools.product(range(k), repeat=len(lengths)))
        window = packing.differencing(np.array(lengths), k)
        most = int(np.bincount(window, lengths, k).max())
        assert best <= most <= best * 4 / 3
        same += most == best
    assert same >= 40


def test_differences_shrink_with_the_pieces():
    r = np.random.RandomState(2)
    for n in (100, 400, 1600):
        lengths = r.randint(1, 1024, n)
        sums = np.bincount(packing.differencing(lengths, n // 2), lengths)
        assert sums.max() - sums.min() <= 1100 - 2 * lengths.min() and sums.std() < 0.25 * lengths.std()


def test_checksums_of_parts():
    r = random.Random(1)
    for n in (1, 31, 32, 33, 500, 1023):
        data = bytes(r.randrange(256) for _ in range(4 * n))
        marks = [zlib.crc32(data[: 4 * at]) for at in range(packing.GRAIN, n + 1, packing.GRAIN)]
        places = [*range(0, n, packing.GRAIN), n]
        for a in places[:-1]:
            for b in (x for x in places if x > a):
                assert packing.part_crc32(marks, zlib.crc32(data), n, a, b) == zlib.crc32(data[4 * a : 4 * b])


def _check_packed(rows, docs):
    library = packing._encoder(BYTE).library
    texts = {}
    for i, t in docs:
        texts.setdefault(i, []).append(np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4"))
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces.keys() == texts.keys()
    for i, found in pieces.items():
        assert sum(r["length"] for r in found) == sum(map(len, texts[i]))
        if len(texts[i]) == 1:
            at = 0
            for r in sorted(found, key=lambda r: r["start"]):
                assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(texts[i][0]), zlib.crc32(texts[i][0][at : at + r["length"]].tobytes()))
                at += r["length"]
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024
    return sequences


def test_packing(spark, make_docs, sf):  # noqa: F811
    rows = [*enumerate(ODD), (2, ODD[5]), (2, ODD[5]), (None, "the word")]
    _check_packed(packing.pack(packing.pieces(make_docs(rows), BYTE)).collect(), rows)
    assert packing.pack(packing.pieces(make_docs([]), BYTE)).count() == 0
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    sequences = _check_packed(packing.op10_packing(spark, sf).collect(), docs)
    used = sum(n for s in sequences.values() for _, n in s)
    assert len(sequences) * 1024 < 1.02 * used


def test_language_held_out(spark, sf):  # noqa: F811
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = language.op8_language_id(spark, sf).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == docs.count() and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_texts(spark, make_docs):  # noqa: F811
    docs = make_docs([*enumerate(ODD), (None, "the word"), (2, "the word")])
    for df in (docs, docs.withColumn("lang", F.lit(None).cast("string")), docs.limit(0)):
        got = language.identify(df, ("p", "s")).collect()
        assert len(got) == df.count()
        for r in got:
            blank = not any(c.isalpha() for c in r["text"] or "")
            assert not blank or (r["p"], r["s"]) == ("und", 0.0)


def test_every_language_is_learned(spark, monkeypatch):
    """A short sample holds all languages, also beside common ones and over-long texts."""
    monkeypatch.setattr(language, "SAMPLE_WORDS", 250)
    of = [("en", "the dog " * 4)] * 400 + [("fr", "le chat " * 4)] * 40 + [("cy", "y gath " * 9000)] * 4 + [(f"l{k}", "mot " * 8) for k in range(5)] * 2
    docs = spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(of)], "doc_id long, text string, lang string")
    kept = {lang for i, (lang, _) in enumerate(of) if zlib.crc32(str(i).encode()) % 5}
    texts, langs = language.sample(docs, 10)
    assert set(langs) == kept == {"en", "fr", "cy", *(f"l{k}" for k in range(5))}
    sizes = {lang: sum(len(t) for t, x in zip(texts, langs, strict=True) if x == lang) for lang in kept}
    assert max(sizes.values()) <= 250 * 8 // len(kept) and sizes["cy"] > 0.9 * 250 * 8 // len(kept)
    assert language._longest([5, 100, 30], 65) == 30 and language._longest([5, 6], 65) == 6


def test_forward_backward_is_exact():
    r = np.random.RandomState(0)
    model = language.Model(["a", "b", "c"], None, None, None, r.normal(size=(3, 3)), r.normal(size=3))
    scores = r.normal(size=(5, 3))
    import itertools

    want, total = np.zeros((5, 3)), 0.0
    for path in itertools.product(range(3), repeat=5):
        w = np.exp(model.first[path[0]] + sum(scores[t, y] for t, y in enumerate(path)) + sum(model.moves[a, b] for a, b in itertools.pairwise(path)))
        total += w
        for t, y in enumerate(path):
            want[t, y] += w
    got = language.marginals(model, np.concatenate([scores, scores[:2]]), np.array([5, 2]))
    assert np.allclose(got[:5], want / total)


def test_code_switching():
    texts = ["the cat and the dog are here with you", "le chat et le chien sont avec vous ici"] * 20
    model = language.fitted(texts, ["en", "fr"] * 20)
    words, found = language.labelled(model, ["the dog and the cat are le chien et le chat sont"])
    assert [model.labels[k] for k in found.argmax(axis=1)] == ["en"] * 6 + ["fr"] * 6


def test_pipeline(spark, sf, tmp_path, make_docs):  # noqa: F811
    texts = [" ".join(f"w{(i * 7 + k) % 91}x{i}" for k in range(60)) for i in range(6)]
    rows = [*enumerate(texts), (10, texts[0]), (11, texts[1] + " more"), (12, None), (13, "123 !!"), (14, 'unique words here token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end'), (3, texts[3]), (None, "a text without id")]
    rows += list(enumerate(ODD, 20))
    folder = str(tmp_path / "sf")
    make_docs(rows).write.parquet(f"{folder}/documents.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            docs = corpus_pipeline.landed(out, name)
            kept[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
    assert not {12, 13} & set(kept["language"]) and {0, 10, 11, 14, None} <= set(kept["language"])
    assert not {10, 11} & set(kept["near_duplicates"]) and {0, 1, 2, 14, None} <= set(kept["near_duplicates"])
    assert kept["near_duplicates"].count(3) == 1 and kept["secrets"].count(14) == 1
    secret = docs.filter("doc_id = 14").first()
    assert "24be" not in secret["text"] and secret["n_chars"] == len(secret["text"])
    final = corpus_pipeline.run(spark, folder).collect()
    _check_packed(final, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_pipeline_keeps_unlabelled_texts(spark, make_docs):  # noqa: F811
    docs = make_docs([(1, "a clean text"), (2, None), (3, ""), (4, "12 !!"), (5, "ünd"), (None, "no id")]).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.keep_language(spark, docs, "")
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 5, None}


@pytest.mark.parametrize("stage", range(4))
def test_pipeline_stands_empty_tables(spark, make_docs, stage):  # noqa: F811
    assert corpus_pipeline.STAGES[stage][1](spark, make_docs([]), "").count() == 0


def test_many_languages_have_a_bounded_model(monkeypatch):
    monkeypatch.setattr(language, "CELLS", 1 << 13)
    names = [f"l{i:02}" for i in range(40)]
    r = random.Random(3)
    words = {n: ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 7))) for _ in range(30)] for n in names}
    texts = [" ".join(r.choice(words[n]) for _ in range(40)) for n in names for _ in range(6)]
    model = language.fitted(texts, [n for n in names for _ in range(6)])
    assert model.grams.shape == (1024, 40)
    found, _ = language.languages(model, [" ".join(r.choice(words[n]) for _ in range(40)) for n in names])
    assert sum(a == b for a, b in zip(found, names)) >= 30


def test_the_commonest_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LABELS", 3)
    rows = [(i, f"text number {i}", f"l{min(i % 10, 5)}", None, 1) for i in range(400)]
    _, langs = language.sample(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    assert len(set(langs)) == 3 and "l5" in langs
