import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetgrain.llm import token_files as tf

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return tf.WordEncoder(PATH)


@pytest.mark.parametrize("bits", range(1, 33))
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1000 + bits).astype("<u4")
    raw = tf.pack(ids, bits)
    assert len(raw) == -(-len(ids) // 64) * 8 * bits
    assert np.array_equal(tf.unpack(raw, bits, len(ids)), ids)


def test_fewest_bits():
    assert [tf.bits_for(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


PIECES = ["a", "THE", "the", "İ", "ς", "Σ", "é", "é", "̸", "<", "=", " ", "\n", "\t", "\xa0", "\x85", "\x1c", "'s", "'", "it's"]
PIECES += ["<|endoftext|>", "<|ENDOFTEXT|>", "<|", "1", "٣", "½", "日本", "👍🏽", "...", "!!", "K", "​", "_", "-", "ß", "ﬁ", "가", "x" * 50]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=4)), max_size=25))
def test_words_give_the_ids_of_the_whole_text(pieces):
    text = "".join(pieces)
    encoder, tokenizer = _both()
    sizes, ids = encoder.texts(pa.array([text, None, text + " x"]))
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in (text, "", text + " x")]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


_HELD = []


def _both():
    if not _HELD:
        _HELD.extend([tf.WordEncoder(PATH), Tokenizer.from_file(PATH)])
    return _HELD


def test_ids_of_real_texts(texts, encoder, tokenizer):
    some = list(texts.values())
    sizes, ids = encoder.texts(pa.array(some))
    for text, part in zip(some, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert tokenizer.encode(text, add_special_tokens=False).ids == part.tolist()


def test_random_access(tmp_path):
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 49408, n).astype("<u4") for n in (0, 5, 70_000, 1, 200_000, 0, 65_536)]
    writer = tf.TokenFileWriter(str(tmp_path / "deep" / "x.ids"), 16)
    for i, ids in enumerate(docs):
        writer.add([None if i == 3 else i], np.array([len(ids)]), ids)
    writer.close()
    file = tf.TokenFile(f"file://{tmp_path}/deep/x.ids")
    assert file.doc_ids == [0, 1, 2, None, 4, 5, 6]
    for i in (6, 0, 4, 2, 3, 5, 1):
        assert np.array_equal(file.document(i), docs[i])
    whole = np.concatenate(docs)
    rng = random.Random(1)
    for _ in range(30):
        a, b = sorted((rng.randint(0, len(whole)), rng.randint(0, len(whole))))
        assert np.array_equal(file.ids(a, b), whole[a:b])
    file.close()


def plain(rows, tokenizer):
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_digests_of_all_documents(documents, texts, tokenizer):
    got = sorted(map(tuple, tf.digests(documents, PATH).collect()))
    assert got == plain(sorted(texts.items()), tokenizer)


def test_defined_cases(make_docs, tokenizer):
    rows = [(3, None), (1, ""), (2, "the cat " * 40_000), (-5, "x"), (9, "tie"), (9, "tie"), (None, "none")]
    got = [tuple(r) for r in tf.digests(make_docs(rows).repartition(3), PATH).collect()]
    want = plain(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), tokenizer)
    assert sorted(got, key=lambda r: r[1]) == want
    assert tf.digests(make_docs([]), PATH).count() == 0


def test_rows_with_one_id_have_one_order(make_docs):
    rows = [(1, f"text {i}") for i in range(50)]
    a = sorted(map(tuple, tf.digests(make_docs(rows), PATH).collect()))
    b = sorted(map(tuple, tf.digests(make_docs(rows[::-1]), PATH).collect()))
    assert a == b and len(a) == 50
