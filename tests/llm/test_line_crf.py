import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from fleetgrain.llm import line_crf as crf


def test_marginals_sum_over_all_labellings():
    rng = np.random.default_rng(1)
    sizes = np.array([3, 1, 5, 0, 4])
    u, moves = rng.normal(size=13), rng.normal(size=(2, 2))
    good, pairs, log_z = crf.Chains(sizes).marginals(u, moves)
    at = 0
    for c, n in enumerate(sizes):
        total, ones, jumps = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            p = np.exp(sum(u[at + i] * y[i] for i in range(n)) + sum(moves[a, b] for a, b in itertools.pairwise(y)))
            total += p
            ones += p * np.array(y)
            for a, b in itertools.pairwise(y):
                jumps[a, b] += p
        assert np.allclose(good[at : at + n], ones / total)
        assert np.allclose(pairs[c], jumps / total)
        assert np.isclose(log_z[c], np.log(total))
        at += n


def test_gradient():
    rng = np.random.default_rng(2)
    sizes = np.array([3, 1, 5])
    args = rng.random((9, crf.N_FEATURES)), sizes, np.array([1.0, 0, 1]), np.array([0.5, 1, 2])
    w = rng.normal(size=crf.N_WEIGHTS)
    gradient = crf.loss_and_gradient(w, *args)[1]
    for i in range(len(w)):
        step = np.zeros(len(w))
        step[i] = 1e-6
        up, down = crf.loss_and_gradient(w + step, *args)[0], crf.loss_and_gradient(w - step, *args)[0]
        assert abs((up - down) / 2e-6 - gradient[i]) < 1e-6


def test_minimise_finds_the_minimum():
    scale = np.arange(1.0, 7.0)

    def bowl(x):
        return float((scale * (x - 3) ** 2).sum()), 2 * scale * (x - 3)

    assert np.allclose(crf.minimise(bowl, np.zeros(6)), 3, atol=1e-3)


def test_held_out_quality(documents, labels):
    rows = crf.score(documents, *crf.learn(documents, labels)).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_held_out_labels_are_no_input(documents, labels):
    other = labels.withColumn("quality", F.when(crf.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = crf.learn(documents, labels), crf.learn(documents, other)
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]


def test_defined_cases(llm, make_docs):
    good, junk = "A line of words here.\nAnother line of words.\n", "BUY!! NOW!!\nBUY!! NOW!!\nCLICK!! ME!!\n"
    docs = [(i, good * 2) for i in range(40)] + [(40 + i, junk) for i in range(40)]
    odd = [(200, None), (201, ""), (202, " \n\n "), (203, good * 3000), (204, "x" * 200_000), (0, good * 2), (None, good)]
    marks = [(i, int(i < 40)) for i in range(80)] + [(None, 1), (3, None), (7, 0), (999, 1)]
    labels = llm.createDataFrame(marks, "doc_id long, quality int")
    weights, prior = crf.learn(make_docs([*docs, *odd]), labels)
    rows = crf.score(make_docs([*docs, *odd]), weights, prior).collect()
    assert len(rows) == 87
    got = {r["doc_id"]: r for r in rows}
    assert got[200]["score"] == got[201]["score"] == got[202]["score"] == prior
    assert got[203]["predicted"] == 1 and got[50]["predicted"] == 0 and not got[None]["held_out"]
    assert got[203]["n_lines"] == 6000
    none, half = crf.learn(make_docs(docs), labels.limit(0))
    assert none is None and {r["score"] for r in crf.score(make_docs(docs), none, half).collect()} == {0.5}
    assert crf.score(make_docs([]), weights, prior).count() == 0
