"""Components of documents whose word shingles overlap, by a token-group matrix.

A document's tokens are the 64-bit hashes of its distinct shingles. Equal token
sets form a class, and only classes are compared. A group is the classes with
the same smallest token (near copies mostly share it), dealt by hash into blocks
of about `BLOCK_CLASSES`, so a group of any size is many bounded blocks.

Matrix. Linked sets A and B share ceil(s |A|) tokens at least. So, in any common
order of tokens, the first |A| - ceil(s |A|) + l of A and as many of B, taken by
its size, share l or more. With l as a tenth of the set and one, rows (token,
block, class) of these first tokens are the part of the token-group matrix that
opens blocks. The order puts tokens known to be frequent last, so passages that
many documents share rarely count.

Opening. A class visits a block that holds `bound` of its first tokens or more.
There the bound is taken on the block's whole token union: fewer than
ceil(s |Q|) of the visitor's tokens in it, and no member is looked at. Otherwise
its overlaps with all members are counted at once and each pair is judged
exactly.

Rounds. First every block links its own members, and a class visits the blocks
that are the first ones of enough of its tokens: a cluster of n near copies
makes visits in proportion to n, not to n squared. Components of those links are
taken, and as long as some grow together, each class visits, token by token, the
first block of another component. Only tokens that are then still spread over
several components, of classes that the union of all the others allows a link,
open further blocks, in groups made anew from the tokens they share, and by the
rarest of them. After that no pair that could be linked is untested, except
within one component.

Blocks with many visitors are dealt out in several copies. Nothing is capped:
the table of frequent tokens has a fixed size, but it only orders tokens.

Defined cases: texts of any length are hashed whole, so one set may be as large
as its text; null or wordless texts have empty sets and are linked with
nothing; fewer words than a shingle are one token; rows with a null doc_id are
returned with a null component and take no part; rows that share a doc_id are
separate rows; a component's id is its smallest doc_id; an empty table gives no
rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgrain.llm.common import WordCodes, forget_kept, slices
from fleetgrain.llm.components import components
from fleetgrain.llm.hot_keys import join_by_key
from fleetgrain.session import cut_lineage

WORDS = 5
PERCENT = 80
BLOCK_CLASSES = 256
VISITS_PER_COPY = 4096

#: Frequent tokens known to all tasks, and how they are noticed: in `CHUNK`
#: tokens of one task at least `NOTICED` times.
FREQUENT_KEPT = 200_000
CHUNK = 1_000_000
NOTICED = 3

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def token_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, as uint64."""
    codes = WordCodes(texts, lower=True)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in codes.distinct], np.uint64)
    seq = hashes[codes.codes] if len(codes.codes) else np.zeros(0, np.uint64)
    n = len(seq) - words + 1
    rolled = np.full(max(n, 0), words, np.uint64)
    for i in range(words):
        rolled = rolled * _STEP + seq[i : i + max(n, 0)]
    rolled = _mixed(rolled)
    sets = []
    for a, b in zip(codes.ends, codes.ends[1:], strict=False):
        if b - a >= words:
            sets.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for h in seq[a:b]:
                    whole = whole * _STEP + h
                sets.append(_mixed(np.array([whole])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def needed(n, percent: int = PERCENT):
    """Tokens that a set of n must share with any set it is linked with."""
    return -(-percent * n // 100)


def lead(n):
    """First tokens that a set of n has beyond those it may miss, and so shares with a linked set of its size."""
    return n // 10 + 1


def bound(n: Column, percent: int) -> Column:
    """First tokens of a set of n that are in any set it is linked with: the lead of the smallest such set."""
    smallest = F.floor((percent * n + 99) / 100)
    return F.floor(smallest / 10) + 1


def digest(tokens: np.ndarray) -> tuple[int, int]:
    both = xxhash.xxh128_intdigest(tokens.tobytes())
    return _signed(both >> 64), _signed(both & (2**64 - 1))


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


DESCRIBED = "doc_id long, n int, k1 long, k2 long, least long, token long, seen long"


def describe(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows of documents (n set), and rows (token, seen) of what is frequent in a task (n null)."""
    names = [c.split() for c in DESCRIBED.split(", ")]
    schema = pa.schema([(c, pa.int32() if kind == "int" else pa.int64()) for c, kind in names])

    def rows(**columns):
        size = len(next(iter(columns.values())))
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def frequent(held):
        tokens, seen = np.unique(np.concatenate(held), return_counts=True)
        often = seen >= NOTICED
        return rows(token=tokens[often].view(np.int64), seen=seen[often])

    def kernel(batches):
        forget_kept()
        held, n_held, known = [], 0, set()
        for batch in slices(batches):
            out = {c: [] for c in ("doc_id", "n", "k1", "k2", "least")}
            for doc_id, tokens in zip(batch.column(0).to_pylist(), token_sets(batch.column(1), words), strict=True):
                k1, k2 = digest(tokens)
                least = int(tokens[:1].view(np.int64)[0]) if len(tokens) else None
                for name, value in zip(out, (doc_id, len(tokens), k1, k2, least), strict=True):
                    out[name].append(value)
                if k1 not in known and len(tokens):
                    known.add(k1)
                    held.append(tokens)
                    n_held += len(tokens)
            yield rows(**out)
            if n_held >= CHUNK:
                yield frequent(held)
                held, n_held, known = [], 0, set()
        if held:
            yield frequent(held)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(kernel, DESCRIBED)


def first_tokens(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], words: int, percent: int) -> DataFrame:
    """(token, doc_id) of the first tokens of each distinct set of a task."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    schema = pa.schema([("token", pa.int64()), ("doc_id", pa.int64())])

    def kernel(batches):
        forget_kept()
        common, counts = shared.value
        known = set()
        for batch in slices(batches):
            tokens_out, ids_out = [], []
            for doc_id, tokens in zip(batch.column(0).to_pylist(), token_sets(batch.column(1), words), strict=True):
                if doc_id is None or not len(tokens):
                    continue
                key = digest(tokens)
                if key in known:
                    continue
                known.add(key)
                size = min(len(tokens), len(tokens) - needed(len(tokens), percent) + lead(len(tokens)))
                if len(common):
                    at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
                    often = np.where(common[at] == tokens, counts[at], 0)
                    tokens = tokens[np.argsort(often, kind="stable")]
                tokens_out.append(tokens[:size])
                ids_out.append(np.full(size, doc_id, np.int64))
            if tokens_out:
                arrays = [pa.array(np.concatenate(tokens_out).view(np.int64)), pa.array(np.concatenate(ids_out))]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(kernel, "token long, doc_id long")


class Block:
    """The members of one block: their token union with who holds what, and their own links."""

    def __init__(self, members: dict[int, np.ndarray], percent: int = PERCENT):
        self.ids, sets, self.percent = list(members), list(members.values()), percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.holder = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.union, self.first = np.unique(tokens[order], return_index=True)
        self.first = np.append(self.first, len(tokens))
        self.root = list(range(len(sets)))
        self.links: list[tuple[int, int]] = []
        for i, tokens in enumerate(sets):
            for j in self.linked(tokens):
                if j < i and self.find(i) != self.find(int(j)):
                    self.root[self.find(i)] = self.find(int(j))
                    self.links.append((self.ids[i], self.ids[int(j)]))

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def linked(self, tokens: np.ndarray) -> np.ndarray:
        """Members linked with a set; none is looked at if too few tokens are in the union."""
        at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        at = at[self.union[at] == tokens]
        if len(at) < needed(len(tokens), self.percent):
            return np.zeros(0, np.int64)
        begin, count = self.first[at], self.first[at + 1] - self.first[at]
        places = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        shared = np.bincount(self.holder[places], minlength=len(self.ids))
        return np.flatnonzero((shared > 0) & (100 * shared >= self.percent * (self.sizes + len(tokens) - shared)))

    def visit(self, tokens: np.ndarray) -> list[int]:
        """One member of each of the block's own components that the visitor is linked with."""
        return list({self.find(int(j)): self.ids[int(j)] for j in self.linked(tokens)}.values())


#: A filter of so many bits tells which texts a join needs, whatever their number.
FILTER_BITS = 1 << 26
_BITS_IN_ROW = 32_768


def only_called(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose doc_id may be among `ids` (rep): all of those, and a few others.

    A bitmap of the ids' hashes, at most FILTER_BITS long, is broadcast, so other texts need not be shuffled.
    """
    place = F.pmod(F.xxhash64("rep"), F.lit(FILTER_BITS)) + 1
    bits = (
        ids.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    bits = cut_lineage(bits)  # FILTER_BITS / 8 bytes at most
    at = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    byte = "cast(conv(hex(substring(bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)"
    return (
        docs.withColumns({"of": F.floor(at / _BITS_IN_ROW) + 1, "bit": at % _BITS_IN_ROW})
        .join(F.broadcast(bits), F.col("of") == F.col("bucket"))
        .where(f"shiftright({byte}, cast(bit % 8 as int)) & 1 = 1")
        .select("doc_id", "text")
    )


def open_blocks(docs: DataFrame, calls: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) found by calls (rep, k1, block, visitor, copy).

    The text of a class goes once to a kernel that hashes it again and sends its
    set to every block it is called to.
    """
    to = F.struct("block", "visitor", "copy")
    by_rep = calls.groupBy("rep", "k1").agg(F.collect_list(to).alias("places"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    called = (
        only_called(texts, calls)
        .join(by_rep.hint("shuffle_hash"), F.col("doc_id") == F.col("rep"))
        .select("rep", "k1", "text", F.col("places.block"), F.col("places.visitor"), F.col("places.copy"))
    )
    schema = pa.schema(
        [("block", pa.int64()), ("copy", pa.int32()), ("visitor", pa.bool_()), ("rep", pa.int64()), ("tokens", pa.binary())]
    )

    def sets(batches):
        forget_kept()
        for batch in slices(batches):
            found = token_sets(batch.column(2), words)
            for i, tokens in enumerate(found):
                row = {n: batch.column(batch.schema.get_field_index(n))[i] for n in ("rep", "k1", "block", "visitor", "copy")}
                if digest(tokens)[0] != row["k1"].as_py():
                    continue  # another row with this doc_id
                size = len(row["block"])
                columns = [row["block"].values, row["copy"].values, row["visitor"].values]
                columns += [pa.array([row["rep"].as_py()] * size, pa.int64()), pa.array([tokens.tobytes()] * size, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def links(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        place, members, block = None, {}, None
        forget_kept()
        for batch in batches:
            a, b = [], []

            def close():
                """Links of the members of a block, found in its first copy only."""
                if place is not None and place[1] == 0 and len(members) > 1:
                    made = block or Block(members, percent)
                    a.extend(x for x, _ in made.links)
                    b.extend(y for _, y in made.links)

            names = ("block", "copy", "visitor", "rep", "tokens")
            for of, copy, visitor, rep, raw in zip(*(batch.column(i).to_pylist() for i in range(len(names))), strict=True):
                if (of, copy) != place:
                    close()
                    place, members, block = (of, copy), {}, None
                tokens = np.frombuffer(raw, np.uint64)
                if not visitor:
                    members[rep] = tokens
                elif members:
                    block = block or Block(members, percent)
                    found = block.visit(tokens)
                    a.extend([rep] * len(found))
                    b.extend(found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)
        if place is not None and place[1] == 0 and len(members) > 1:
            made = block or Block(members, percent)
            pairs = [pa.array(x, pa.int64()) for x in zip(*made.links, strict=True)] if made.links else None
            if pairs:
                yield pa.RecordBatch.from_arrays(pairs, schema=schema)

    return (
        called.mapInArrow(sets, "block long, copy int, visitor boolean, rep long, tokens binary")
        .repartition("block", "copy")
        .sortWithinPartitions("block", "copy", "visitor")
        .mapInArrow(links, "a long, b long")
    )


def _calls(classes: DataFrame, visits: DataFrame, own: bool) -> DataFrame:
    """Who goes to which block: its members, and visitors dealt over copies of the block."""
    visited = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / VISITS_PER_COPY).cast("int").alias("copies"))
    opened = visited
    if own:
        several = classes.groupBy("block").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        opened = several.join(visited, "block", "full").select("block", F.coalesce("copies", F.lit(1)).alias("copies"))
    members = classes.join(opened, "block").select(
        "rep", "k1", "block", F.lit(False).alias("visitor"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")
    )
    guests = visits.join(visited, "block").select(
        "rep", "k1", "block", F.lit(True).alias("visitor"), F.pmod(F.xxhash64("rep"), F.col("copies")).cast("int").alias("copy")
    )
    return members.unionByName(guests)


def cluster(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    described = cut_lineage(describe(docs, words))
    rows = described.where("n is not null").select("doc_id", "n", "k1", "k2", "least")
    top = (
        described.where("n is null")
        .groupBy("token")
        .agg(F.sum("seen").alias("seen"))
        .orderBy(F.desc("seen"), "token")
        .limit(FREQUENT_KEPT)
        .toArrow()
    )
    tokens = top.column(0).to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    frequent = (tokens[order], top.column(1).to_numpy()[order])

    distinct = rows.where("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("least").alias("least")
    )
    classes = cut_lineage(_in_blocks(cut_lineage(distinct)).select("k1", "k2", "rep", "n", "block"))
    placed = cut_lineage(rows.join(classes.drop("n"), ["k1", "k2"], "left").select("doc_id", "n", "rep", "block", "k1"))

    by_token = Window.partitionBy("token")
    several = first_tokens(docs, frequent, words, percent).withColumns(
        {"lo": F.min("doc_id").over(by_token), "hi": F.max("doc_id").over(by_token)}
    )
    several = cut_lineage(several.where("lo != hi").select("token", "doc_id"))
    of_class = placed.where("n > 0").select("doc_id", "n", "rep", "block", "k1")
    matrix = several.join(of_class, "doc_id").select("token", "rep", "k1", "block", "n").distinct()
    matrix = matrix.withColumns({"lo": F.min("block").over(by_token), "hi": F.max("block").over(by_token)})
    matrix = cut_lineage(matrix.where("lo != hi").drop("hi"))

    visits = cut_lineage(_enough(matrix.where("block != lo").select("rep", "k1", "n", F.col("lo").alias("block")), percent))
    calls = cut_lineage(_calls(classes, visits, own=True))
    links = cut_lineage(open_blocks(docs, calls, words, percent))
    roots = cut_lineage(components(links))

    joins = None
    while True:
        mixed = cut_lineage(_mixed_tokens(matrix, roots, percent))
        before, joins = joins, roots.where("node != root").count()
        star = cut_lineage(_star_visits(mixed, percent).join(visits, ["rep", "block"], "left_anti"))
        if joins == before or star.isEmpty():
            break
        roots, visits = _open_more(docs, classes, roots, visits, star, words, percent)
    spread = cut_lineage(_spread_tokens(docs, mixed, words, percent))
    if not spread.isEmpty():
        groups = _regrouped(spread)
        rest = cut_lineage(_other_visits(_rarest(spread, percent), groups, percent))
        roots, _ = _open_more(docs, groups, roots, rest, rest, words, percent, own=True)
    return placed.join(roots, F.col("rep") == F.col("node"), "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "rep", "doc_id")).alias("component_id"),
    )


def _open_more(docs, classes, roots, visits, more, words, percent, own=False) -> tuple[DataFrame, DataFrame]:
    """Components and visits after further visits."""
    calls = cut_lineage(_calls(classes, more, own))
    found = cut_lineage(open_blocks(docs, calls, words, percent))
    joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found)
    return cut_lineage(components(joined)), cut_lineage(visits.unionByName(more))


def _enough(shared: DataFrame, percent: int) -> DataFrame:
    """(rep, k1, block) of those rows, one per shared token, that come often enough to allow a link."""
    counted = shared.groupBy("rep", "k1", "n", "block").agg(F.count(F.lit(1)).alias("shared"))
    return counted.where(F.col("shared") >= bound(F.col("n"), percent)).select("rep", "k1", "block")


def _mixed_tokens(matrix: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Rows of tokens that lie in several components, of classes with enough such tokens to be linked with another."""
    by_token = Window.partitionBy("token")
    mixed = cut_lineage(
        matrix.join(roots, F.col("rep") == F.col("node"), "left")
        .select("token", "rep", "k1", "block", "n", F.coalesce("root", "rep").alias("label"))
        .withColumns({"one": F.min("label").over(by_token), "two": F.max("label").over(by_token)})
        .where("one != two")
        .drop("one", "two")
    )
    able = _enough(mixed.select("rep", "k1", "n", F.lit(0).alias("block")), percent)
    return mixed.join(able.select("rep"), "rep", "left_semi")


def _regrouped(spread: DataFrame) -> DataFrame:
    """(rep, k1, block) of classes in new groups, by the smallest of the tokens they share.

    Edited copies of one text differ in their smallest token, mostly one of
    their own, but agree in the smallest that others have too.
    """
    least = cut_lineage(spread.groupBy("rep", "k1").agg(F.min("token").alias("least")))
    return cut_lineage(_in_blocks(least).select("rep", "k1", "block"))


def _in_blocks(classes: DataFrame) -> DataFrame:
    """Classes (k1, least) with the block of their group, groups dealt by hash into blocks of about BLOCK_CLASSES."""
    sizes = cut_lineage(classes.groupBy("least").agg(F.count(F.lit(1)).alias("group")))
    part = F.pmod("k1", F.ceil(F.col("group") / BLOCK_CLASSES))
    return join_by_key(classes, sizes, ["least"], "group").withColumn("block", F.xxhash64("least", part))


def _star_visits(mixed: DataFrame, percent: int) -> DataFrame:
    """For each class and token the first block of another component: as many rows as tokens, however large a group is."""
    by_token = Window.partitionBy("token")
    first = mixed.withColumn("first", F.min(F.struct("block", "label")).over(by_token))
    other = F.when(F.col("label") != F.col("first.label"), F.col("block"))
    chosen = first.withColumn("second", F.min(other).over(by_token)).withColumn(
        "other", F.when(F.col("label") != F.col("first.label"), F.col("first.block")).otherwise(F.col("second"))
    )
    return _enough(chosen.where("other != block").select("rep", "k1", "n", F.col("other").alias("block")), percent)


def _spread_tokens(docs: DataFrame, mixed: DataFrame, words: int, percent: int) -> DataFrame:
    """(rep, k1, n, label, token): all tokens, not the first ones only, that several components have.

    Only of classes with ceil(s n) such tokens or more. This is the bound of a
    block taken on the union of all other components at once: it drops classes
    that share much with a large group and yet too little for any of it.
    """
    reps = cut_lineage(mixed.select("rep", "k1", "n", "label").distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    called = only_called(texts, reps).join(reps.hint("shuffle_hash"), F.col("doc_id") == F.col("rep"))
    names = ("rep", "k1", "n", "label", "token")
    schema = pa.schema([(name, pa.int64()) for name in names])

    def every_token(batches):
        for batch in slices(batches):
            for i, tokens in enumerate(token_sets(batch.column(0), words)):
                facts = [batch.column(c)[i].as_py() for c in range(1, 5)]
                if digest(tokens)[0] == facts[1]:
                    columns = [pa.array(np.full(len(tokens), x, np.int64)) for x in facts]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(tokens.view(np.int64))], schema=schema)

    rows = called.select("text", "rep", "k1", F.col("n").cast("long").alias("n"), "label")
    rows = rows.mapInArrow(every_token, ", ".join(f"{name} long" for name in names)).distinct()
    by_token, by_rep = Window.partitionBy("token"), Window.partitionBy("rep", "k1")
    spread = rows.withColumn("spread", F.min("label").over(by_token) != F.max("label").over(by_token)).where("spread")
    shared = spread.withColumn("shared", F.count(F.lit(1)).over(by_rep))
    return shared.where(F.col("shared") >= F.ceil(F.col("n") * percent / 100)).select(*names)


def _rarest(spread: DataFrame, percent: int) -> DataFrame:
    """The first |A| - ceil(s |A|) + 1 tokens of each class, tokens of one component before, then by rarity.

    Two linked classes of different components share one of these.
    """
    by_token, by_rep = Window.partitionBy("token"), Window.partitionBy("rep", "k1")
    counted = spread.withColumns({"seen": F.count(F.lit(1)).over(by_token), "shared": F.count(F.lit(1)).over(by_rep)})
    place = F.row_number().over(by_rep.orderBy("seen", "token"))
    allowed = F.col("shared") - F.ceil(F.col("n") * percent / 100) + 1
    return counted.withColumn("place", place).where(F.col("place") <= allowed).select(*spread.columns)


def _other_visits(first: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """All visits by classes to blocks that share a first token and hold a class of another component."""
    rows = cut_lineage(first.join(groups, ["rep", "k1"]))
    held = rows.groupBy("token", F.col("block").alias("other")).agg(
        F.min("n").alias("small"), F.max("n").alias("large"), F.min("label").alias("one"), F.max("label").alias("two")
    )
    # and one of a size that allows a link
    fits = f"block > other and not (one = label and two = label) and 100 * large >= {percent} * n and {percent} * small <= 100 * n"
    return rows.join(held, "token").where(fits).select("rep", "k1", F.col("other").alias("block")).distinct()


def keep_first(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents, with all their columns, but one of each component: its smallest doc_id.

    Of rows with one doc_id and text one stays; rows with a null doc_id all do.
    """
    found = cluster(docs.select("doc_id", "text"), words, percent)
    first = found.where("component_id = doc_id").select(F.col("doc_id").alias("first_id")).distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = docs.select(whole, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"))
    kept = (
        rows.join(first.hint("shuffle_hash"), F.col("doc_id") == F.col("first_id"), "left_semi")
        .groupBy("doc_id", "text_key")
        .agg(F.max_by("whole", F.xxhash64("whole")).alias("whole"))
    )
    return kept.select("whole.*").unionByName(docs.where("doc_id is null"))
