import hashlib

import pytest

from fleetgrain.llm import bitsets, exact_dedup, hot_keys

LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def checked(rows, got):
    want = plain(rows)
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, set()).add((text or "").translate(LOWER))
    digests = {hashlib.sha256(t.encode()).hexdigest(): t for t in want}
    assert len(got) == len(rows)
    kept = {}
    for r in got:
        text = digests[r["text_sha256"]]
        assert text in texts[r["doc_id"]]
        assert (r["keep_id"], r["group_size"]) == want[text]
        kept.setdefault(text, []).extend([r["doc_id"]] * r["kept"])
    assert all(kept[t] == [keep_id] for t, (keep_id, _) in want.items())


def test_all_documents(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    checked(rows, exact_dedup.judge(documents, all_digests=True).collect())
    assert exact_dedup.keep(documents).count() == len(plain(rows))


@pytest.mark.parametrize("bits", [1, 1 << 20])
def test_full_bitmaps_change_nothing(make_docs, bits, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LENGTH_BITS", bits)
    monkeypatch.setattr(exact_dedup, "HEAD_BITS", bits)
    # equal lengths and heads, other ends; equal to lower case of A-Z only
    head = "x" * 100
    rows = [(1, head + "a"), (2, head + "b"), (3, head + "A"), (4, "ÄB"), (5, "äb"), (6, "Äb"), (7, "straße"), (8, "STRAßE"), (9, "İ"), (10, "i̇")]
    checked(rows, exact_dedup.judge(make_docs(rows), all_digests=True).collect())


def test_only_possible_copies_are_read_whole(make_docs):
    rows = [(1, "one"), (2, "two two"), (3, "x" * 90 + "1"), (4, "y" * 90 + "1"), (5, "same"), (6, "Same")]
    got = {r["doc_id"]: r for r in exact_dedup.judge(make_docs(rows)).collect()}
    assert {i for i, r in got.items() if r["text_sha256"]} == {5, 6}
    assert {i for i, r in got.items() if not r["kept"]} == {5}


def test_defined_cases(make_docs):
    rows = [(1, None), (2, ""), (2, ""), (None, "q"), (None, "q"), (None, "r"), (3, "R"), (4, "long " * 400_000), (5, "LONG " * 400_000)]
    docs = make_docs(rows)
    checked(rows, exact_dedup.judge(docs, all_digests=True).collect())
    kept = exact_dedup.keep(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), len(r["text"] or "")) for r in kept.collect()) == [("2", 0), ("3", 1), ("5", 2_000_000), ("None", 1)]
    assert exact_dedup.judge(make_docs([])).count() == 0 and exact_dedup.keep(make_docs([])).count() == 0


def test_hot_keys_join_like_others(llm):
    rows = llm.range(4000).selectExpr("case when id % 3 = 0 then 0 else id end as k", "id")
    facts = rows.groupBy("k").count()
    got = hot_keys.join_by_key(rows, facts, ["k"], "count")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(facts, "k").select(got.columns).collect()))
    none = rows.selectExpr("cast(null as long) as k", "id")
    assert hot_keys.join_by_key(none, facts, ["k"], "count").count() == 0


def test_bitmaps_miss_no_key(llm):
    keys = llm.range(0, 3000, 3).select("id")
    held = bitsets.bitmap(keys, 1 << 20)
    rows = bitsets.marked(llm.range(3000), [exact_dedup.F.col("id")], held, 1 << 20, "on").collect()
    assert all(r["on"] for r in rows if r["id"] % 3 == 0) and sum(r["on"] for r in rows) < 1100
    empty = bitsets.bitmap(keys.limit(0), 1 << 20)
    assert not any(r["on"] for r in bitsets.marked(llm.range(9), [exact_dedup.F.col("id")], empty, 1 << 20, "on").collect())
