"""Prefix tries of conversations: double arrays over dense turn ids per prefix shard, shared nodes merged globally.

Rebuilding. A conversation becomes the first turns of the one it starts from and
its own turns behind as many of its own. Turns are narrow rows from the start:
a 128-bit digest of (role, text) and a number of words. They are numbered within
their conversation by sorted ranges, so a conversation of any length spreads
over many tasks.

Units. A rebuilt conversation is cut into segments of `SEGMENT` turns; a unit is
one segment with the digest of all turns before it, which stands for a node.
A digest of a prefix is the exclusive or of its turns' digests mixed with their places.

Shards. Units are sorted by the node they start from and their first turns, in
ranges that Spark cuts, and a shard is a run of a range with about
`SHARD_TURNS` turns. So conversations with a common beginning lie together, a
beginning that a third of all share is many shards, and no shard grows with the
data. A shard numbers its distinct turns densely and packs a trie of its units
into BASE and CHECK arrays: the child of node s by turn t is at BASE[s] + t, and
is one if CHECK there is s. Walking its units through the arrays gives every
unit its nodes and every node its part of the aggregates. Nodes that lie in
several shards, upper ones mostly, have the same digest and are merged by Spark.

Two passes. The first gives members and their smallest id. The conversation with
that id owns the node, and then owns all deeper nodes on its path as well. A sum
over the distinct nodes below a node is thus a sum over its members of what they
own there, and the second pass adds that up, without walking up a tree whose
depth has no bound.

Defined cases: remainders of negative ids are negative, as in SQL; a null role or text is empty; rows with a null conv_id are no
conversation; null turns come first, equal turns are ordered by their digest and
count each, so repeated rows are turns of their own; a conversation without
turns after rebuilding is a member of the root; texts of any length are read
whole; a childless root is its own leaf; an empty table gives no rows. Other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgrain.llm.hot_keys import join_by_key
from fleetgrain.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
#: Conversations start from the one with this multiple as id, by fewer than `MOST_SHARED` turns.
FAMILY = 20
MOST_SHARED = 4
SEGMENT = 1024
SHARD_TURNS = 1 << 16
TRIES = 32


class DoubleArray:
    """A trie over codes 1..n in two arrays; node 0 is the root.

    Children go to the first place where all fit, of TRIES places from the first free one on, or else behind all nodes.
    """

    def __init__(self, n_codes: int):
        self.n_codes = n_codes
        self.base = np.zeros(2 * n_codes + 2, np.int64)
        self.check = np.full(2 * n_codes + 2, -1, np.int64)
        self.check[0] = 0
        self.free_from = self.behind = 1

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def add_children(self, node: int, codes: np.ndarray) -> np.ndarray:
        """Place the children of a node, all at once, by ascending codes; their node numbers."""
        self._grow(self.behind + 1)
        while self.check[self.free_from] >= 0:
            self.free_from += 1
        self._grow(self.behind + TRIES + self.n_codes + 1)
        offsets = codes - codes[0]
        for slot in (*range(self.free_from, self.free_from + TRIES), self.behind):
            places = slot + offsets
            if (self.check[places] < 0).all():
                break
        self.base[node] = slot - codes[0]
        self.check[places] = node
        self.behind = max(self.behind, int(places[-1]) + 1)
        return places

    def child(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of nodes by codes, -1 where there is none."""
        at = self.base[nodes] + codes
        inside = (at > 0) & (at < len(self.check))
        at = np.where(inside, at, 0)
        return np.where(inside & (self.check[at] == nodes), at, -1)


class Trie:
    """The trie of paths given as codes one after the other, and for each turn of each path its node."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        self.array = DoubleArray(int(codes.max(initial=0)))
        first = np.cumsum(sizes) - sizes
        paths = np.arange(len(sizes))
        state = np.zeros(len(sizes), np.int64)
        self.node = np.zeros(len(codes), np.int64)
        for depth in range(int(sizes.max(initial=0))):
            paths = paths[sizes[paths] > depth]
            at = first[paths] + depth
            parent, code = np.divmod(np.unique(state[paths] * (self.array.n_codes + 1) + codes[at]), self.array.n_codes + 1)
            cuts = (np.flatnonzero(np.diff(parent)) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(parent)], strict=True):
                self.array.add_children(int(parent[a]), code[a:b])
            state[paths] = self.node[at] = self.array.child(state[paths], codes[at])


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, d1, d2, words): the turns of each conversation, numbered from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    lanes = [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16)]
    narrow = cut_lineage(
        conversations.where("conv_id is not null").select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            lanes[0].alias("d1"),
            lanes[1].alias("d2"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("words"),
        )
    )
    order = ["turn", "d1", "d2"]
    ranges = cut_lineage(narrow.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()))
    here = Window.partitionBy("conv_id", "part").orderBy(*order)
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.sum("n").over(earlier))
    # a range begins inside one conversation at most, so these are fewer rows than ranges
    before = before.where("before is not null").select("conv_id", "part", "before")
    return (
        ranges.withColumn("here", F.row_number().over(here))
        .join(F.broadcast(before), ["conv_id", "part"], "left")
        .select("conv_id", (F.col("here") + F.coalesce("before", F.lit(0))).alias("pos"), "d1", "d2", "words")
    )


def units(conversations: DataFrame) -> DataFrame:
    """The segments of rebuilt conversations.

    conv_id, seg, last (whether it is the last), s1 and s2 (digest of the turns before it), e1 and e2 (digest with
    its own turns), t1 and t2 (its turns' digests), words, words_behind (in later segments).
    """
    own = cut_lineage(turns(conversations))
    heads = (
        own.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < MOST_SHARED))
        .groupBy(F.col("conv_id").alias("family"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "d1", "d2", "words"))).alias("heads"))
    )
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    convs = cut_lineage(
        own.groupBy("conv_id")
        .agg(F.count(F.lit(1)).alias("size"))
        .withColumns({"h": shared, "family": F.col("conv_id") - F.col("conv_id") % FAMILY})
        .join(heads, "family", "left")
        .withColumn("heads", F.slice(F.coalesce("heads", F.array().cast(heads.schema["heads"].dataType)), 1, F.col("h").cast("int")))
        .select("conv_id", "size", "h", "heads")
    )
    begun = convs.select("conv_id", F.inline("heads")).select("conv_id", F.col("pos").cast("long").alias("pos"), "d1", "d2", "words")
    facts = convs.select("conv_id", "size", "h", F.size("heads").alias("n_heads"))
    rest = join_by_key(own, facts, ["conv_id"], "size").where("pos > h")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("n_heads")).alias("pos"), "d1", "d2", "words")
    lane = lambda c: F.xxhash64(c, "pos")
    rebuilt = begun.unionByName(rest).withColumns({"m1": lane("d1"), "m2": lane("d2"), "seg": F.floor((F.col("pos") - 1) / SEGMENT)})
    cut = rebuilt.groupBy("conv_id", "seg").agg(
        F.sort_array(F.collect_list(F.struct("pos", "d1", "d2", "m1", "m2", "words"))).alias("turns"),
        F.bit_xor("m1").alias("x1"),
        F.bit_xor("m2").alias("x2"),
        F.sum("words").alias("in_words"),
    )
    empty = convs.join(cut.select("conv_id").distinct(), "conv_id", "left_anti").select("conv_id")
    rows = F.array().cast(cut.schema["turns"].dataType)
    empty = empty.select(
        "conv_id", F.lit(0).cast("long").alias("seg"), rows.alias("turns"), *[F.lit(0).cast("long").alias(c) for c in ("x1", "x2", "in_words")]
    )
    # one row per SEGMENT turns meets here
    along = Window.partitionBy("conv_id").orderBy("seg")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    behind = along.rowsBetween(1, Window.unboundedFollowing)
    made = cut.unionByName(empty).withColumns(
        {
            "e1": F.bit_xor("x1").over(so_far),
            "e2": F.bit_xor("x2").over(so_far),
            "words_behind": F.coalesce(F.sum("in_words").over(behind), F.lit(0)),
            "last": F.lead("seg").over(along).isNull(),
        }
    )
    made = made.withColumns({"s1": F.col("e1").bitwiseXOR(F.col("x1")), "s2": F.col("e2").bitwiseXOR(F.col("x2"))})
    parts = {c: F.col(f"turns.{c}") for c in ("d1", "d2", "m1", "m2", "words")}
    return cut_lineage(
        made.select("conv_id", "seg", "last", "s1", "s2", "e1", "e2", "words_behind", *[v.alias(k) for k, v in parts.items()])
    )


class Shard:
    """Units in one trie. A unit's path begins with a code for the node that it starts from, so all starts hang below one root."""

    def __init__(self, units: pa.Table):
        self.units = units
        lists = units.column("d1").combine_chunks()
        self.sizes = np.diff(lists.offsets.to_numpy())
        self.unit = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.conv_id, self.words = self.fixed("conv_id"), self.flat("words")
        starts, start = np.unique(np.stack([self.fixed("s1"), self.fixed("s2")]), axis=1, return_inverse=True)
        _, turn = np.unique(np.stack([self.flat("d1"), self.flat("d2")]), axis=1, return_inverse=True)
        first = np.cumsum(self.sizes) - self.sizes
        # dense ids: starts first, then turns
        codes = np.insert(turn.reshape(-1) + starts.shape[1] + 1, first, start.reshape(-1) + 1)
        trie = Trie(codes, self.sizes + 1)
        begin = first + np.arange(len(first))
        of_turn = np.ones(len(codes), bool)
        of_turn[begin] = False
        #: nodes are numbered densely: those that units start from, and those of their turns
        self.places, node = np.unique(np.concatenate([trie.node[begin], trie.node[of_turn]]), return_inverse=True)
        self.start, self.node = node[: len(begin)], node[len(begin) :]
        self.at_root = self.fixed("seg") == 0
        self.depth = self.fixed("seg")[self.unit] * SEGMENT + np.arange(len(self.unit)) - first[self.unit] + 1
        self.after = [self._digests(f"m{k}", f"s{k}", first) for k in (1, 2)]

    def fixed(self, name: str) -> np.ndarray:
        return self.units.column(name).to_numpy()

    def flat(self, name: str) -> np.ndarray:
        return self.units.column(name).combine_chunks().flatten().to_numpy()

    def _digests(self, mixed: str, start: str, first: np.ndarray) -> np.ndarray:
        """The digest of the prefix that ends with each turn."""
        running = np.concatenate([[0], np.bitwise_xor.accumulate(self.flat(mixed))])
        return running[1:] ^ running[first][self.unit] ^ self.fixed(start)[self.unit]

    def to_end(self, of_turns: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums to the end of the conversation: from each turn on, and from before each unit on."""
        sums = np.concatenate([[0], np.cumsum(of_turns)])
        ends = np.cumsum(self.sizes)
        return sums[ends][self.unit] - sums[:-1] + behind[self.unit], sums[ends] - sums[ends - self.sizes] + behind

    def summed(self, of_turns: np.ndarray, of_units: np.ndarray) -> np.ndarray:
        """Sums by node; whole units count for the root."""
        out = np.zeros(len(self.places), np.int64)
        np.add.at(out, self.node, of_turns)
        np.add.at(out, self.start[self.at_root], of_units[self.at_root])
        return out

    def rows(self, **aggregates: np.ndarray) -> dict[str, np.ndarray]:
        """Nodes with digest, parent's digest, depth, words, and the aggregates given for them.

        The node that a later segment starts from belongs to the segment before and is left out.
        """
        known = np.zeros(len(self.places), bool)
        known[self.start[self.at_root]] = True
        known[self.node] = True
        before = [a ^ self.flat(m) for a, m in zip(self.after, ("m1", "m2"), strict=True)]
        facts = zip(("n1", "n2", "p1", "p2", "depth", "words"), (*self.after, *before, self.depth, self.words), strict=True)
        for name, of_turns in facts:
            aggregates[name] = np.zeros(len(self.places), np.int64)
            aggregates[name][self.node] = of_turns
        return {name: values[known] for name, values in aggregates.items()}


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """Runs of sorted units with SHARD_TURNS to twice as many turns; a unit is never cut."""
    held, n_turns = [], 0
    for batch in batches:
        sizes = np.diff(batch.column(batch.schema.get_field_index("d1")).offsets.to_numpy()) + 1
        piece = np.cumsum(sizes) // SHARD_TURNS
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                held.append(batch.slice(a, b - a))
                n_turns += int(sizes[a:b].sum())
            if n_turns >= SHARD_TURNS:
                yield Shard(pa.Table.from_batches(held))
                held, n_turns = [], 0
    if held:
        yield Shard(pa.Table.from_batches(held))


def _by_shard(rows: DataFrame, names: list[str], make) -> DataFrame:
    """What `make(shard)` gives for the shards of units, as columns of longs."""
    first = {f"key{i}": F.get("d1", F.lit(i)) for i in range(3)}
    order = ["s1", "s2", *first, "conv_id", "seg"]
    schema = pa.schema([(name, pa.int64()) for name in names])

    def kernel(batches):
        for shard in _shards(batches):
            made = make(shard)
            yield pa.RecordBatch.from_arrays([pa.array(made[name]) for name in names], schema=schema)

    ranged = rows.withColumns(first).repartitionByRange(*order).sortWithinPartitions(*order).drop(*first)
    return ranged.mapInArrow(kernel, ", ".join(f"{name} long" for name in names))


def members(rows: DataFrame) -> DataFrame:
    """n1, n2 (digest), p1, p2 (its parent's), depth, words, n_convs and conv_id (smallest member) of every node."""

    def make(shard: Shard) -> dict[str, np.ndarray]:
        least = np.full(len(shard.places), np.iinfo(np.int64).max)
        np.minimum.at(least, shard.node, shard.conv_id[shard.unit])
        np.minimum.at(least, shard.start, shard.conv_id)
        n_convs = shard.summed(np.ones(len(shard.unit), np.int64), np.ones(len(shard.sizes), np.int64))
        return shard.rows(n_convs=n_convs, conv_id=least)

    partial = _by_shard(rows, ["n1", "n2", "p1", "p2", "depth", "words", "n_convs", "conv_id"], make)
    same = [F.min(c).alias(c) for c in ("p1", "p2", "depth", "words")]
    return cut_lineage(partial.groupBy("n1", "n2").agg(*same, F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")))


def below(rows: DataFrame) -> DataFrame:
    """n1, n2, all_words, own_words and n_leaves of every node.

    all_words are of its members' turns from the node on, own_words of the distinct nodes from it on. `rows` are
    units with first_owned (least depth that the conversation owns, past its end if none), leaf (1 if it owns a
    childless node) and own_behind (words of what it owns in later segments).
    """

    def make(shard: Shard) -> dict[str, np.ndarray]:
        leaf = shard.fixed("leaf")
        owned = np.where(shard.depth >= shard.fixed("first_owned")[shard.unit], shard.words, 0)
        return shard.rows(
            all_words=shard.summed(*shard.to_end(shard.words, shard.fixed("words_behind"))),
            own_words=shard.summed(*shard.to_end(owned, shard.fixed("own_behind"))),
            n_leaves=shard.summed(leaf[shard.unit], leaf),
        )

    sums = ["all_words", "own_words", "n_leaves"]
    return _by_shard(rows, ["n1", "n2", *sums], make).groupBy("n1", "n2").agg(*[F.sum(c).alias(c) for c in sums])


def ends(rows: DataFrame) -> DataFrame:
    """n1, n2, ends_sha256 of nodes where conversations end: SHA-256 of their ids, ascending and joined by commas.

    Ids are joined in ranges of ids first, then the ranges of a node stream through one hash, never held together.
    """
    joined = pa.schema([("n1", pa.int64()), ("n2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    hashed = pa.schema([("n1", pa.int64()), ("n2", pa.int64()), ("ends_sha256", pa.string())])

    def join(batches):
        for batch in batches:
            found: dict[tuple, list[int]] = {}
            for n1, n2, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.setdefault((n1, n2), []).append(conv_id)
            columns = [[k[0] for k in found], [k[1] for k in found], [v[0] for v in found.values()]]
            columns.append([",".join(map(str, v)) for v in found.values()])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, joined, strict=True)], schema=joined)

    def digest(batches):
        node, state = None, None
        for batch in batches:
            done = []
            for n1, n2, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                if (n1, n2) == node:
                    state.update(f",{ids}".encode())
                    continue
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (n1, n2), hashlib.sha256(ids.encode())
            columns = zip(*done, strict=True) if done else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, hashed, strict=True)], schema=hashed)
        if node:
            yield pa.RecordBatch.from_pylist([dict(zip(hashed.names, (*node, state.hexdigest()), strict=True))], schema=hashed)

    last = rows.where("last").select(F.col("e1").alias("n1"), F.col("e2").alias("n2"), "conv_id")
    packed = last.repartitionByRange("conv_id").sortWithinPartitions("conv_id")
    packed = packed.mapInArrow(join, "n1 long, n2 long, first long, ids string")
    return packed.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "first").mapInArrow(digest, "n1 long, n2 long, ends_sha256 string")


def nodes(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node."""
    rows = units(conversations)
    found = members(rows)
    children = found.where("depth > 0").groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.count(F.lit(1)).alias("n_children"))
    found = cut_lineage(found.join(children, ["n1", "n2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    owners = found.groupBy("conv_id").agg(
        F.min("depth").alias("first_owned"),
        F.max_by((F.col("n_children") == 0).cast("long"), "depth").alias("leaf"),
        F.sum("words").alias("own_words"),
    )
    past_end = F.lit(2**62)
    weighed = rows.join(owners, "conv_id", "left").withColumns(
        {
            "first_owned": F.coalesce("first_owned", past_end),
            "leaf": F.coalesce("leaf", F.lit(0)),
            # what is owned from this segment or an earlier one on is owned to the end
            "own_behind": F.when(F.col("first_owned") <= (F.col("seg") + 1) * SEGMENT, F.col("words_behind")).otherwise(
                F.coalesce("own_words", F.lit(0))
            ),
        }
    )
    sums = below(cut_lineage(weighed.drop("own_words")))
    parents = found.where("n_children > 0").select(
        F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n_siblings")
    )
    inner = join_by_key(found.where("depth > 0"), cut_lineage(parents), ["p1", "p2"], "n_siblings").drop("n_siblings")
    root = found.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return (
        inner.unionByName(root)
        .join(sums, ["n1", "n2"])
        .join(ends(rows), ["n1", "n2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("all_words") - F.col("own_words")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
