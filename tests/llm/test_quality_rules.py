import math
import random
import re

import numpy as np

from fleetgrain.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        sum(line in lines[:i] for i, line in enumerate(lines)),
        len(hit),
    )


def measured(docs):
    rows = q.measure(docs).collect()
    return [tuple(r[c] for c in q.COUNTS) for r in rows]


def test_counts_of_all_documents(documents, texts):
    for row in q.measure(documents).collect():
        assert tuple(row[c] for c in q.COUNTS) == plain(texts[row["doc_id"]])


def test_counts_of_odd_texts(make_docs):
    rng = random.Random(5)
    odd = [None, "", " \n\t", "a", "\x1c\x85\xa0 b\x0bc\x0cd", "é" * 5 + " ü\n\n\nx\nx\n x", "#*$%&|<> !!"]
    odd += ["a b c d e f g h " * 2, "a b c d e f g h " * 2 + "i", "x " * 30000]
    odd += ["".join(rng.choice("ab#\n \t\x1fé") for _ in range(200)) for _ in range(150)]
    docs = make_docs([(i, t) for i, t in enumerate(odd)])
    assert measured(docs.orderBy("doc_id")) == [plain(t) for t in odd]


def test_binomial_tail_is_exact():
    for k, n, p in ((0, 50, 0.01), (3, 40, 0.2), (7, 90, 0.05), (39, 40, 0.5)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(q.tail_at_most(k, n, p) - want) < 1e-12
        bound = q.upper_bound(k, n, 0.05)
        assert abs(q.tail_at_most(k, n, bound) - 0.05) < 1e-9


def test_cutoffs_are_certified():
    limits = q.RiskLimits()
    good, bad = np.zeros(101, int), np.zeros(101, int)
    good[0], good[40], bad[80], bad[0] = 5000, 400, 300, 100
    cutoff, false, caught, bound = q.choose_cutoff(good, bad, limits, 0.01)
    assert (cutoff, false, caught) == (79, 0, 300) and bound <= limits.false_share
    few = np.zeros(101, int)
    few[0] = 100
    # zero errors among 100 prove nothing at 1%
    assert q.choose_cutoff(few, bad, limits, 0.01)[0] == q.LEVELS
    assert q.choose_cutoff(np.zeros(101, int), bad, limits, 0.01)[0] == q.LEVELS


def test_false_rejections_stay_below_the_limit():
    rng = np.random.default_rng(3)
    limits, broken = q.RiskLimits(false_share=0.05, harm=0.0), 0
    truth = np.clip(rng.normal(30, 12, 100_000), 0, 100).astype(int)
    for _ in range(200):
        good = np.bincount(rng.choice(truth, 800), minlength=101)
        cutoff = q.choose_cutoff(good, np.bincount([99] * 50 + [60] * 50, minlength=101), limits, 0.05)[0]
        broken += (truth > cutoff).mean() > limits.false_share
    assert broken <= 20


def _many(make_docs):
    good = " ".join(f"word{i}" for i in range(30))
    junk = " ".join(f"w{i}###" for i in range(30))
    rows = [(i, good + f" {i}") for i in range(1500)] + [(i, junk + f" {i}") for i in range(1500, 1600)]
    return make_docs([*rows, (2000, None), (2001, ""), (2002, junk, None), (2003, good, None), (0, good + " 0")])


def test_rules_reject_junk_and_keep_the_rest(llm, make_docs):
    docs = _many(make_docs)
    marks = [(i, int(i < 1500), "x") for i in range(1600)] + [(None, 1, "x"), (7, None, "x"), (99999, 0, "x")]
    labels = llm.createDataFrame(marks, "doc_id long, quality int, text string")
    rows = q.judge(docs, labels).collect()
    assert len(rows) == docs.count()
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert kept == {*range(1500), 2002, 2003}  # a stratum without labels has no rules
    assert all(r["base_failed"] for r in rows if r["doc_id"] in (2000, 2001))
    assert sum(r["doc_id"] == 0 for r in rows) == 2
    passed = q.keep(docs, labels)
    assert passed.columns == docs.columns
    assert sorted(r["doc_id"] for r in passed.collect()) == sorted(r["doc_id"] for r in rows if r["kept"])


def test_empty_tables(llm, make_docs, labels):
    assert q.judge(make_docs([]), labels).count() == 0
    rows = q.judge(make_docs([(1, "a " * 5), (2, " ".join(map(str, range(50))))]), labels.limit(0)).collect()
    assert {r["doc_id"]: r["kept"] for r in rows} == {1: False, 2: True}
    assert q.keep(make_docs([]), labels).count() == 0


def test_copies_are_no_further_evidence(llm, make_docs):
    good = " ".join(f"word{i}" for i in range(30))
    junk = " ".join(f"w{i}###" for i in range(30))
    rows = [(i, good) for i in range(1500)] + [(i, f"{junk} {i}") for i in range(1500, 1600)]
    labels = llm.createDataFrame([(i, int(i < 1500)) for i in range(1600)], "doc_id long, quality int")
    docs = make_docs(rows)
    found = q.certify(q.measure(docs), labels).collect()
    assert all(r["n_good"] == 1 and r["cutoff"] == q.LEVELS for r in found)
    assert all(r["kept"] for r in q.judge(docs, labels).collect())
