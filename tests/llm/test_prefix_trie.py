import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from fleetgrain.llm import prefix_trie as pt


def plain(rows):
    convs = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in convs.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:])
    members, children, sums = collections.defaultdict(list), collections.defaultdict(list), {}
    for c, turns in sorted(rebuilt.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves = sum(sums[k][0] for k in children[p]) if children[p] else 1
        sums[p] = (leaves, (len(members[p]) - 1) * words + sum(sums[k][1] for k in children[p]))
    out = []
    for p, ids in members.items():
        ends = ",".join(str(c) for c in ids if len(rebuilt[c]) == len(p))
        parent = members[p[:-1]][0] if p else None
        out.append((ids[0], len(p), parent, len(ids), len(children[p]), *sums[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(llm, rows):
    table = llm.createDataFrame(
        [(*r, 1, 2, 3, 4) for r in rows], "conv_id long, turn long, role string, text string, pos long, part long, seg long, n1 long"
    )
    got = sorted(map(tuple, pt.nodes(table).collect()), key=str)
    assert got == plain(rows)
    return got


def test_all_conversations(llm):
    rows = llm.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert len(check(llm, list(map(tuple, rows)))) > 1


@pytest.mark.parametrize("segment,shard_turns", [(1024, 1 << 16), (3, 20), (1, 1)])
def test_segments_and_shards_of_any_size(llm, segment, shard_turns, monkeypatch):
    monkeypatch.setattr(pt, "SEGMENT", segment)
    monkeypatch.setattr(pt, "SHARD_TURNS", shard_turns)
    monkeypatch.setattr(pt, "TRIES", 2)
    rng = random.Random(segment)
    rows = [(c, t, rng.choice("ab"), rng.choice(["x", "y z", None])) for c in range(-5, 60) for t in range(rng.randint(1, 9))]
    rows += [(200 + c, t, "user", f"copy {t}") for c in range(40) for t in range(5)]
    check(llm, rows)


def test_a_conversation_with_most_turns(llm, monkeypatch):
    monkeypatch.setattr(pt, "SEGMENT", 64)
    check(llm, [(7, t, "a", str(t % 5)) for t in range(900)] + [(8, t, "a", str(t % 5)) for t in range(700)] + [(3, None, None, None)])


def test_defined_cases(llm):
    # a conversation whose turns are all replaced by fewer of its family has none
    none_left = next(c for c in range(41, 60) if zlib.crc32(str(c).encode()) % 4 == 3)
    long_text = "word " * 300_000
    rows = [(none_left, 0, "user", "x"), (None, 0, "user", "x"), (100, None, None, None), (100, 1, "user", long_text)]
    rows += [(300, 1, "user", "tie"), (300, 1, "user", "tie")]
    got = check(llm, rows)
    root = next(r for r in got if r[1] == 0)
    assert root[:4] == (none_left, 0, None, 3) and root[7] == hashlib.sha256(str(none_left).encode()).hexdigest()
    assert check(llm, [(5, 1, "a", "b")])
    assert check(llm, []) == []


def test_double_array_tells_all_paths():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 8, 500)
    codes = rng.integers(1, 9, sizes.sum())
    trie = pt.Trie(codes, sizes)
    ends, nodes = np.cumsum(sizes), {}
    for end, size in zip(ends, sizes, strict=True):
        for d in range(1, size + 1):
            path = tuple(codes[end - size : end - size + d])
            assert nodes.setdefault(path, trie.node[end - size + d - 1]) == trie.node[end - size + d - 1]
    assert len(set(nodes.values())) == len(nodes)
    for path, node in nodes.items():
        for code in range(1, 9):
            child = int(trie.array.child(np.array([node]), np.array([code]))[0])
            assert child == nodes.get((*path, code), -1)
