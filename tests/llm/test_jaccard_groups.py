import random
import re

import pytest

from fleetgrain.llm import jaccard_groups as jg
from fleetgrain.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain(rows):
    """(doc_id, n, component) by comparing every pair of distinct sets."""
    sets = {}
    for doc_id, text in rows:
        if doc_id is not None and shingles(text):
            sets.setdefault(shingles(text), []).append(doc_id)
    keys = list(sets)
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(keys):
        for j in range(i):
            both = len(a & keys[j])
            if 100 * both >= 80 * (len(a) + len(keys[j]) - both) and find(i) != find(j):
                root[find(i)] = find(j)
    least = {}
    for i, key in enumerate(keys):
        least[find(i)] = min([least.get(find(i), sets[key][0]), *sets[key]])
    of = {key: least[find(i)] for i, key in enumerate(keys)}
    return sorted(((d, len(shingles(t)), of.get(shingles(t), d) if d is not None else None) for d, t in rows), key=str)


def got(docs):
    return sorted(map(tuple, jg.cluster(docs).collect()), key=str)


def near_copies(rng, n, clusters, words=60, edits=6):
    """Clusters of texts with a few replaced words, sharing one passage."""
    passage = [f"p{i}" for i in range(25)]
    rows = []
    for i in range(n):
        c = rng.randrange(clusters)
        base = random.Random(c)
        text = [f"w{base.randrange(10**6)}" for _ in range(words)]
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        if c % 3 == 0:
            text[10:10] = passage
        rows.append((i * 7 % 100_003, " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [2, 64])
def test_clusters_of_near_copies(make_docs, monkeypatch, block):
    monkeypatch.setattr(jg, "BLOCK_CLASSES", block)
    monkeypatch.setattr(jg, "VISITS_PER_COPY", 5 if block == 2 else 4096)
    rows = near_copies(random.Random(block), 400, 25)
    assert got(make_docs(rows)) == plain(rows)


def test_chains_of_links(make_docs):
    """Neighbours are linked and far members are not, so a component needs every link of the chain."""
    words = [f"w{i}" for i in range(400)]
    rows = [(500 - k, " ".join(words[4 * k : 4 * k + 80])) for k in range(60)]
    rows += [(1000 + k, " ".join(words[:80][::-1][k : k + 60])) for k in range(5)]
    assert got(make_docs(rows)) == plain(rows)


def test_all_documents_of_the_smallest_tables(documents, texts):
    assert got(documents) == plain(list(texts.items()))


def test_threshold_is_exact(make_docs):
    # sets of 10 and 8 shingles with 8 in common: exactly 80 of 100; with 7 of 8 in 9: below
    words = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(words[:14])), (2, " ".join(words[:12])), (3, " ".join(words[15:28])), (4, " ".join(words[15:25] + ["x"]))]
    assert got(make_docs(rows)) == plain(rows) and dict((r[0], r[2]) for r in plain(rows)) == {1: 1, 2: 1, 3: 3, 4: 4}


def test_defined_cases(make_docs):
    rows = [(9, None), (8, ""), (7, " \n"), (6, "Too few words"), (5, "too FEW\twords"), (4, "too few"), (None, "too few"), (None, None)]
    rows += [(3, "a " * 30_000), (2, "a a a a a"), (11, "é É e E x"), (12, "é É E e x"), (20, "same id " * 9), (20, "other text " * 9)]
    rows += [(21, "same id " * 9), (1, "too few words"), (1, "too few words")]
    assert got(make_docs(rows)) == plain(rows)
    assert got(make_docs([])) == []


def test_first_of_each_component_stays(make_docs):
    rows = near_copies(random.Random(9), 120, 8) + [(3, None), (None, "x"), (None, "x"), (4, "p q r"), (4, "p q r"), (5, "p q r")]
    docs = make_docs(rows)
    kept = jg.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted([*{str(c) for d, _, c in plain(rows) if d is not None}, "None", "None"])
    assert jg.keep_first(make_docs([])).count() == 0


def test_components(llm):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(80)]
    edges += [(5000, 5000 + i) for i in range(1, 60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    df = components(llm.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["root"] for r in df.collect()} == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(llm.createDataFrame([(1, 1)], "a long, b long")).count() == 0
