import hashlib
import random
import re

import pytest

from fleetgrain.llm import personal_data as pd

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd = [int(d) for d in digits[::-1][::2]]
    even = [sum(divmod(2 * int(d), 10)) for d in digits[::-1][1::2]]
    return (sum(odd) + sum(even)) % 10 == 0


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    }


def test_plain_finds_equal_the_patterns():
    rng = random.Random(6)
    parts = ["a", "b.c", "@", "@x.y", ".", "1", "25", "256", "0004", "1.2.3.4", "+", "+1 ", "(", ")", " ", "-", "_", "%", "é", "\n"]
    parts += ["4111111111111111", "4111 1111 1111 1111", "+1 (555) 010-9999", "@a", "x@y-z.co.uk"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pd.detect(text) == plain(text), text


DISGUISED = [
    ("write john.doe (at) example [dot] com", "email", "john.doe (at) example [dot] com"),
    ("write john dot doe at example dot co dot uk now", "email", "john dot doe at example dot co dot uk"),
    ("john @ example . com", "email", "john @ example . com"),
    ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ!", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("mail jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("call plus one five five five one two three four five six seven now", "phone", "plus one five five five one two three four five six seven"),
    ("card four " + " ".join(["one"] * 15) + ".", "card", "four " + " ".join(["one"] * 15)),
    ("ruf plus vier neun drei null eins zwei drei vier fünf sechs an", "phone", "plus vier neun drei null eins zwei drei vier fünf sechs"),
    ("ip ١٩٢.١٦٨.٠.١ x", "ip", "١٩٢.١٦٨.٠.١"),
    ("ip one nine two dot one six eight dot zero dot one two", "ip", "one nine two dot one six eight dot zero dot one two"),
]


@pytest.mark.parametrize(("text", "kind", "find"), DISGUISED)
def test_disguises_map_back_to_the_source(text, kind, find):
    import pyarrow as pa

    assert pd.hinted(pa.array([text])) == [True]
    base, every = pd.find(text)
    assert base == plain(text)
    assert [text[a:b] for a, b in every[kind]][:1] == [find]


MIXED = [
    "john at example [dot] com",
    "jane at mail.example dot com",
    "jane at mail.example (dot) co dot uk",
    "john\nat\nexample dot com",
    "john at\texample\tdot\ncom",
    "john at example\r\ndot com",
    "john dot doe at example\n[dot]\ncom",
    "john\u2003at\u2003example dot com",
]


@pytest.mark.parametrize("find", MIXED)
def test_mixed_disguises_over_any_white_space(find):
    import pyarrow as pa

    text = f"write: {find}, please"
    assert pd.hinted(pa.array([text])) == [True]
    base, every = pd.find(text)
    assert base == plain(text) and [text[a:b] for a, b in every["email"]] == [find]


def test_long_white_space_and_domains_are_walked_once():
    for text in ("a at " + "b." * 50_000, "a\n" * 50_000 + "(dot)", "\n" * 200_000 + "[at] x dot y", "x at " * 30_000, "a" + "\t" * 200_000 + "at b dot c"):
        pd.rewrite(text)
    for text in ("meet at\nthe dot com", "at noon.\nDot the i", "he is at home.\n dot"):
        assert not any(pd.find(text)[1].values()), text


def test_hints_miss_nothing_over_white_space():
    import pyarrow as pa

    rng = random.Random(9)
    parts = ["at", "dot", "(at)", "[dot]", " ", " ", "\n", "\t", "\u2003", "a", "x.y", "@", ".", "com", "the"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 16))) for _ in range(6000)]
    for text, hint in zip(texts, pd.hinted(pa.array(texts)), strict=True):
        assert hint or pd.rewrite(text).text == text, text


def test_invisible_characters_widen_a_find():
    text = "x jo" + chr(0x200B) + "hn@example.com"
    base, every = pd.find(text)
    assert [text[a:b] for a, b in base["email"]] == ["hn@example.com"]
    assert every["email"] == [(2, len(text)), *base["email"]]


def test_time_follows_the_text():
    """Twice the text may not take much more than twice the time; a quadratic walk took 29 s here."""
    import time

    for text in ("x (at) y " + "a dot " * 16_000, "dot a@b " * 16_000 + "one two " * 16_000, "a@b.co " * 16_000 + "x (at) y.zz"):
        began = time.perf_counter()
        pd.find(text)
        assert time.perf_counter() - began < 5


def test_chains_of_spelled_dots_around_an_address():
    text = "write x (at) mail dot example dot com or j dot doe (at) y.org, dot dot end"
    _, every = pd.find(text)
    assert [text[a:b] for a, b in every["email"]] == ["x (at) mail dot example dot com", "j dot doe (at) y.org"]


def test_common_words_are_no_disguise():
    for text in ("meet at the dot com", "look at it. dot the i", "one two three", "plus one", "at [4] dot", "un deux, et un", "a < b > c"):
        base, every = pd.find(text)
        assert not any(every.values()), text


def test_hints_miss_nothing():
    """A text without a hint is not changed by the rewriting."""
    import pyarrow as pa

    rng = random.Random(7)
    parts = ["at", "dot", "(at)", "[dot]", "{@}", " ", " ", " ", "one", "two", "zwei", "double", "plus", "oh", "1", ",", "\n", "-", "a", "x.y", "@"]
    parts += [".", "com", "é", "ａ", chr(0x200B), "punkt", "arroba", "the"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 16)))
        if not pd.hinted(pa.array([text]))[0]:
            assert pd.rewrite(text).text == text, text


def digest(found):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k in pd.KINDS for a, b in found[k]).encode()).hexdigest()


def test_all_documents_of_the_smallest_tables(documents, texts):
    rows = pd.scan(documents).collect()
    assert len(rows) == len(texts)
    for r in rows:
        found = plain(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pd.KINDS] == [len(found[k]) for k in pd.KINDS]
        assert r["base_sha256"] == digest(found)
        assert r["n_added"] or r["spans"] == pd.listed(found)


def test_defined_cases(make_docs):
    rows = [(1, None), (2, ""), (3, "a@b.co " * 20_000), (4, "1" * 300_000), (5, "+" + "1" * 100_000), (6, "." * 100_000 + "@"), (7, "@" * 50_000)]
    rows += [(8, "x@y.zz"), (8, "x@y.zz"), (None, "x@y.zz"), (9, "a." * 60_000 + "@b.cc")]
    got = pd.scan(make_docs(rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["spans"] == by_id[2]["spans"] == by_id[4]["spans"] == "" and by_id[1]["base_sha256"] == digest(plain(""))
    assert by_id[3]["n_email"] == 20_000 and by_id[9]["spans"] == "email:0:120005" and by_id[None]["spans"] == "email:0:6"
    assert pd.scan(make_docs([])).count() == 0
