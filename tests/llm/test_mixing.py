import math
import re
from collections import Counter, defaultdict

import pandas as pd
import pytest

from fleetgrain.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Sharing by weight and resharing the excess, step by step."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += share[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 100, "c": 1000}, {"b": 5, None: 7, "a": 900, "é": 3, "Z": 50}, {"x": 8}, {"a": 0, "b": 4, "c": 90}])
def test_targets_are_the_water_level(llm, sizes):
    frame = llm.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.water_level(frame).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_newton_solves_the_dual(llm):
    rows = [(1000, t) for t in (2000.0, 1500.0, 1000.0, 10.0, 0.001)]
    df = llm.createDataFrame(rows, "w long, t double")
    from pyspark.sql import functions as F

    for r in df.select("w", "t", mixing.tilt(F.col("w"), F.col("t")).alias("x")).collect():
        assert r["x"] == pytest.approx(math.log(r["t"] / r["w"]), abs=1e-9)


def test_chosen_bins_come_near_the_share():
    cells = pd.DataFrame([(c, b, 2**c + b % 3) for c in range(8) for b in range(40)], columns=["size_class", "bin", "words"])
    for share in (0.0, 0.1, 0.5, 0.93, 1.0):
        last = dict(mixing.choose_bins(cells, share))
        taken = sum(w for c, b, w in cells.itertuples(index=False) if b <= last.get(c, -1))
        assert abs(taken - share * cells["words"].sum()) <= 2


def test_all_documents_of_the_smallest_tables(documents, texts):
    rows = mixing.mix(documents).join(documents.select("doc_id", "source"), "doc_id").collect()
    assert len(rows) == len(texts)
    assert all(r["size"] == len(WORD.findall(texts[r["doc_id"]])) for r in rows)
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    want = plain_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["copies"] in (0, 1, 2) and r["taken"] == r["copies"] * r["size"]
    assert abs(sum(taken.values()) - sum(want.values())) <= 0.02 * sum(want.values())


def test_sources_with_many_documents_come_near_their_targets(make_docs):
    rows = [(i, "w " * (1 + i * 37 % 200 + (5000 if i % 97 == 0 else 0)), "en", f"s{i % 3 if i % 2 else 0}") for i in range(3000)]
    docs = make_docs(rows)
    out = mixing.mix(docs).collect()
    source = {r[0]: r[3] for r in rows}
    taken, target = Counter(), {}
    for r in out:
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.005 * t
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_mixed_rows_are_the_copies(make_docs):
    rows = [(i, f"w{i} " * (1 + i % 9), "en", [None, "a", "b"][i % 3]) for i in range(300)] + [(3, "w3 " * 4, "en", None), (None, "z", "en", "a")]
    docs = make_docs(rows)
    copies = defaultdict(int)
    for r in mixing.mix(docs).collect():
        copies[r["doc_id"]] += r["copies"]
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.schema["mix_size"].dataType.simpleString() == "bigint"
    got = Counter(r["doc_id"] for r in mixed.collect())
    assert got == Counter({k: n for k, n in copies.items() if n})


def test_defined_cases(make_docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (4, "one"), (None, "two words"), (5, "x " * 100_000, "en", None)]
    out = mixing.mix(make_docs(rows)).collect()
    assert len(out) == 7 and all(r["taken"] <= 2 * r["size"] for r in out)
    assert {r["doc_id"]: r["size"] for r in out} == {1: 0, 2: 0, 3: 0, 4: 1, None: 2, 5: 100_000}
    assert mixing.mix(make_docs([])).count() == 0 and mixing.mixed(make_docs([])).count() == 0
    assert [r["taken"] for r in mixing.mix(make_docs([(1, None), (2, "")])).collect()] == [0, 0]
