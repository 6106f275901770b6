import itertools
import math
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from fleetgrain.llm import language_pieces as lang

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def all_cuts(text):
    for cuts in itertools.product((0, 1), repeat=len(text) - 1):
        parts, at = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                parts.append(text[at:i])
                at = i
        yield [*parts, text[at:]]


def test_forward_sums_all_segmentations():
    ids = {p: i for i, p in enumerate(lang.vocabulary(MODEL))}
    odds = np.random.default_rng(0).random((len(ids) + 1, 2))
    odds /= odds.sum(axis=0)
    words = ["the", "über", "çon", "x", "tionthe", "дом", "日本", "thex"]
    pieces = lang.Pieces(lang.vocabulary(MODEL))
    got = lang.Lattice(words, pieces).forward(odds)
    assert np.allclose(got, lang.Lattice(words, pieces)._scaled_forward(odds))
    uses = lang.Lattice(words, pieces).expected(odds, np.ones((len(words), 2)))
    want_uses = np.zeros_like(odds)
    for w, word in enumerate(words):
        for k in range(2):
            ways = []
            for parts in all_cuts(lang.START + word):
                at = [ids.get(p, len(ids) if len(p) == 1 else None) for p in parts]
                if None not in at:
                    ways.append((math.prod(odds[i, k] for i in at), at))
            total = sum(p for p, _ in ways)
            assert abs(got[w, k] - math.log(total)) < 1e-9
            for p, at in ways:
                for i in at:
                    want_uses[i, k] += p / total
    assert np.allclose(uses, want_uses)


def test_a_very_long_word_has_a_finite_score():
    pieces = lang.Pieces(lang.vocabulary(MODEL))
    odds = np.full((pieces.unknown + 1, 2), 1e-5)
    assert np.isfinite(lang.Lattice(["the" * 20_000], pieces).forward(odds)).all()


def test_long_pieces_count_like_all_others():
    names = lang.vocabulary(MODEL)
    word = next(p for p in names if p.startswith(lang.START) and len(p) == 11)
    ids = {p: i for i, p in enumerate(names)}
    odds = np.full((len(names) + 1, 1), 1e-9)
    odds[ids[word]] = 0.5
    assert abs(lang.Lattice([word[1:]], lang.Pieces(names)).forward(odds)[0, 0] - math.log(0.5)) < 1e-6


def test_long_runs_are_learned_from(make_docs, monkeypatch):
    run = "thequickbrownfox" * 300
    docs = make_docs([(i, f"{run} word", "en") for i in range(9)])
    table, _ = lang.word_counts(docs, 1000)
    assert {r["word"] for r in table.collect()} == {run, "word"}
    assert all(np.isfinite(lang.learn(docs, MODEL)["odds"]).ravel())
    pieces = lang.Pieces(lang.vocabulary(MODEL))
    odds = np.random.default_rng(1).random((pieces.unknown + 1, 2))
    odds /= odds.sum(axis=0)
    words, counts = ["the", "quickly", "дом", "x" * 30], np.array([[1, 2], [3, 0], [1, 1], [2, 5]])
    plain = lang.Lattice(words, pieces).expected(odds, counts)
    monkeypatch.setattr(lang, "LONGEST_PLAIN", 1)
    assert np.allclose(lang.Lattice(words, pieces).expected(odds, counts), plain)
    assert sorted(i for part in lang.by_length([run, *words]) for i in part) == list(range(5))


def test_held_out_documents_are_told_apart(documents):
    rows = lang.predict(documents, lang.learn(documents, MODEL)).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_documents_and_sources_are_no_input(documents):
    other = documents.withColumn("source", F.lit("z")).withColumn(
        "lang", F.when(lang.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))
    )
    a = lang.predict(documents, lang.learn(documents, MODEL)).collect()
    b = lang.predict(other, lang.learn(other, MODEL)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_languages_may_have_any_name(make_docs):
    names = {"EN": "the house", "en": "der garten", "word": "el perro", "": "la maison"}
    rows = [(100 * k + i, f"{text} {text} " * 3, name) for k, (name, text) in enumerate(names.items()) for i in range(12)]
    got = lang.predict(make_docs(rows), lang.learn(make_docs(rows), MODEL)).collect()
    by_id = {r[0]: r[2] for r in rows}
    assert len(got) == len(rows) and all(r["lang_pred"] == by_id[r["doc_id"]] for r in got)


def test_number_signs_are_no_letters(make_docs):
    assert lang.runs("a²b") == ["a", "b"] and lang.runs("x1Ⅷ½é") == ["x", "é"]
    learned = [(i, "the house", "en") for i in range(9)]
    got = lang.predict(make_docs([(1, "5 ²"), (2, "① ½ Ⅷ"), (3, "5 m²")]), lang.learn(make_docs(learned), MODEL)).collect()
    assert [r["lang_pred"] for r in sorted(got)] == ["und", "und", "en"]


def test_defined_cases(make_docs):
    learned = [(i, "the house and the garden " * 5, "en") for i in range(30)]
    learned += [(100 + i, "das haus und der garten " * 5, "de") for i in range(30)]
    odd = [(500, None, "en"), (501, "", "en"), (502, "12 %% ..", "en"), (503, "der garten", None), (503, "der garten", None)]
    odd += [(None, "the garden", "en"), (504, "the" * 100_000, "en")]
    docs = make_docs([*learned, *odd])
    rows = lang.predict(docs, lang.learn(docs, MODEL)).collect()
    assert len(rows) == 67
    got = {r["doc_id"]: (r["lang_pred"], r["held_out"]) for r in rows}
    assert [got[i][0] for i in (500, 501, 502)] == ["und"] * 3
    assert got[503][0] == "de" and got[None] == ("en", False) and got[504][0] in ("en", "de")
    assert lang.learn(make_docs([(1, "x", None)]), MODEL) is None
    assert [r["lang_pred"] for r in lang.predict(make_docs([(1, "x")]), None).collect()] == ["und"]
    assert lang.predict(make_docs([]), None).count() == 0
