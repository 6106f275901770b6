import hashlib
import random
import re

import pytest

from fleetgrain.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(docs, items):
    windows = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if ids := windows.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= ids
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def judged(docs, items, **kwargs):
    return sorted((tuple(r)[:6] for r in dc.judge(docs, items, **kwargs).collect()), key=str)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(40)] + ["é", "日本", "x1"]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(30)] + [(50, None), (51, " .,"), (None, "lonely item words")]
    items += [(7, items[3][1]), (60, items[4][1])]
    docs = []
    for i in range(120):
        parts = text(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            piece = words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(piece) - 10))
            parts[rng.randint(0, len(parts)) : 0] = piece[a : a + rng.choice([9, 10, 14])]
        docs.append((i, rng.choice([" ", ", ", "\n-"]).join(p.upper() if rng.random() < 0.2 else p for p in parts)))
    docs += [(500, None), (501, ""), (502, "Lonely ITEM-words!"), (503, " ".join(parts) + " " + "v1 " * 40_000), (0, docs[0][1]), (None, docs[1][1])]
    return docs, items


@pytest.mark.parametrize("part_words", [2_000_000, 60])
def test_against_all_windows(llm, make_docs, case, part_words):
    docs, items = case
    table = llm.createDataFrame([(*i, "x") for i in items], "item_id long, text string, items string")
    assert judged(make_docs(docs), table, part_words=part_words) == plain(docs, items)
    clean = dc.keep(make_docs(docs), table, part_words=part_words)
    assert clean.columns == make_docs(docs).columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(r[0]) for r in plain(docs, items) if not r[5])


def test_a_worker_and_the_driver_hold_one_part(llm, make_docs, case, monkeypatch):
    """Automata that workers hold after a benchmark in many parts, and parts collected before the first is scanned."""
    import pyarrow as pa

    docs, items = case
    table = llm.createDataFrame(items, "item_id long, text string")
    steps, collect, broadcast = [], type(table).collect, type(llm.sparkContext).broadcast
    monkeypatch.setattr(type(table), "collect", lambda self: steps.append("collect") or collect(self))
    monkeypatch.setattr(type(llm.sparkContext), "broadcast", lambda self, value: steps.append("broadcast") or broadcast(self, value))

    def held(batches):
        import sys

        for _ in batches:
            home = sys.modules.get("_llm_worker")
            n = sum(kind.startswith("automaton") for kind in (home.held if home else ()))
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    for run in (dc.judge, dc.keep):
        steps.clear()
        out = run(make_docs(docs).repartition(1), table, part_words=60)
        assert steps.count("broadcast") > 3 and steps[1:] == ["collect", "broadcast"] * (len(steps) // 2)  # the first is of the size
        out.collect()
        assert max(r["n"] for r in llm.range(0, 400, 1, 16).mapInArrow(held, "n long").collect()) <= 1


def test_all_documents_of_the_smallest_tables(documents, benchmark, texts):
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    assert judged(documents, benchmark) == plain(list(texts.items()), items)


def test_spans_are_places_in_the_original(llm, make_docs):
    item = "one two three four five six seven eight nine ten eleven"
    text = "Ünder: ONE,two; three--four\nfive six seven (eight) nine ten! eleven? twelve"
    table = llm.createDataFrame([(1, item)], "item_id long, text string")
    row = dc.scan(make_docs([(1, text)]), table).collect()[0]
    assert [text[a:b] for a, b in zip(row["starts"], row["ends"], strict=True)] == [text[7:-8].rstrip("?")]
    assert (row["first_words"], row["end_words"]) == ([1], [12])


def test_empty_tables(llm, make_docs, benchmark):
    assert judged(make_docs([]), benchmark) == []
    docs = [(1, "a b c"), (2, None)]
    assert judged(make_docs(docs), benchmark.limit(0)) == plain(docs, [])
    assert dc.keep(make_docs(docs), benchmark.limit(0)).count() == 2
