"""Batches with more text than a kernel takes up at once, and texts that alone hold more."""

import random
import zlib

import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fleetgrain.llm import decontaminate, jaccard_groups, language_pieces, line_crf, mixing, personal_data, quality_rules, token_files
from fleetgrain.llm.common import BYTES_AT_ONCE, WordCodes, slices

TOKENS = public_tokenizers.path("word_bpe_49k.json")


def long_texts():
    rng = random.Random(3)
    words = "The quick Brown fox jumps Über den müden Hund ÉTÉ l'été don't x.y 5 ² 日本 ok".split()
    texts = [None, "", "Short ONE"]
    texts += [" ".join(rng.choices(words, k=1500)) for _ in range(500)]
    texts.insert(250, " ".join(rng.choices(words, k=900_000)))
    texts += [None, "Last Ü"]
    return texts


TEXTS = long_texts()


@pytest.fixture(scope="module")
def long_docs(llm):
    rows = [(i, t, ("en", "de")[i % 2], "s", 0) for i, t in enumerate(TEXTS)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.coalesce(1)


def plain_words(text):
    return (text or "").translate(LOWER).encode().split()


LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_of_slices_are_right(kind):
    assert len(TEXTS[250].encode()) > BYTES_AT_ONCE
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS, kind)], names=["text"])
    pieces = list(slices(iter([batch])))
    assert len(pieces) > 2
    got = []
    for piece in pieces:
        words = WordCodes(piece.column(0), lower=True)
        got += [[words.distinct[c].encode() for c in words[i]] for i in range(len(words))]
    assert got == [plain_words(t) for t in TEXTS]


def test_tokens(long_docs):
    tokenizer = Tokenizer.from_file(TOKENS)
    rows = {r["doc_id"]: r for r in token_files.digests(long_docs, TOKENS).collect()}
    start = 0
    for i, text in enumerate(TEXTS):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(raw))
        start += len(ids)


def test_shingles(long_docs):
    rows = {r["doc_id"]: r["n_shingles"] for r in jaccard_groups.cluster(long_docs).collect()}
    for i, text in enumerate(TEXTS):
        words = plain_words(text)
        want = len({tuple(words[k : k + 5]) for k in range(len(words) - 4)}) if len(words) >= 5 else int(bool(words))
        assert rows[i] == want


def test_languages(long_docs, llm):
    model = language_pieces.learn(long_docs, public_tokenizers.path("piece_bpe_32k.model"))
    rows = {r["doc_id"]: r["lang_pred"] for r in language_pieces.predict(long_docs, model).collect()}
    few = [i for i in range(len(TEXTS)) if i % 50 == 0 or i < 3]
    alone = language_pieces.predict(long_docs.where(long_docs.doc_id.isin(few)), model).collect()
    assert len(rows) == len(TEXTS) and all(rows[r["doc_id"]] == r["lang_pred"] for r in alone)
    assert rows[0] == rows[1] == "und" and rows[250] in ("en", "de")


def test_counts_of_words_and_rows(long_docs, labels, llm):
    judged = {r["doc_id"]: r["n_words"] for r in quality_rules.judge(long_docs, labels).collect()}
    sizes = {r["doc_id"]: r["size"] for r in mixing.mix(long_docs).collect()}
    assert judged == sizes == {i: len(plain_words(t)) for i, t in enumerate(TEXTS)}
    assert line_crf.score(long_docs, *line_crf.learn(long_docs, labels)).count() == len(TEXTS)


def test_scans(long_docs, llm):
    passage = " ".join(TEXTS[250].split()[-12:])
    items = llm.createDataFrame([("a", passage)], "item_id string, text string")
    hits = {r["doc_id"]: r["n_hit"] for r in decontaminate.judge(long_docs, items).collect()}
    assert len(hits) == len(TEXTS) and hits[250] >= 10
    last = long_docs.selectExpr("doc_id", "concat(text, ' write x (at) y dot org')  as text")
    found = personal_data.scan(last).collect()
    assert all(r["n_added"] == (TEXTS[r["doc_id"]] is not None) for r in found)
