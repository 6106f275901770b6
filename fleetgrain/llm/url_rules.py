"""Block and allow rules on hosts and paths, by a sort-merge sweep over ranges.

A host is keyed by its labels in reverse order, each with a dot behind it, so
`www.example.com` becomes `com.example.www.` and a host with all its subdomains
is one interval of keys. Intervals of hosts are nested or disjoint. Pages and
rules are cut at common key boundaries into ranges; a rule goes to each range
that its interval meets (a rule is repeated only where a boundary falls inside
it). Ranges are sorted, and a sweep keeps the stack of hosts whose intervals
hold the present key; the rules of a host are kept by path.

Boundaries come from a sample of page keys; they decide only how even the
ranges are. A boundary is a host key, a path and a hash of the page, so a host
or even a single url with a third of all pages spreads over many ranges.

The longest rule that fits decides (by host and path together, then by host; a
block wins between equal rules); without one the verdict is `default`.

Defined cases: a null url, or one without `://`, has empty host and path and
only the default; hosts and paths of rules are taken as given but for A-Z in
hosts, a null part counts as empty, and a rule with an empty host fits no page;
urls of any length are read whole; repeated pages are judged row by row; without rules all get the default. Other
columns of the inputs are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEYS_PER_RANGE = 50


def page_parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path of every page."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.when(F.instr(F.col("u"), "://") > 0, F.expr("substr(u, instr(u, '://') + 3)")).otherwise(F.lit(""))
    return (
        pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("u"))
        .withColumn("rest", F.substring_index(F.substring_index(rest, "#", 1), "?", 1))
        .withColumn("raw_host", F.substring_index("rest", "/", 1))
        .select(
            "page_id",
            F.translate("raw_host", UPPER, LOWER).alias("host"),
            F.expr("substr(rest, length(raw_host) + 1)").alias("path"),
        )
    )


def host_key(host):
    """Reversed labels, each followed by a dot; an empty host has an empty key."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))
    )


def _end(key: str) -> str:
    """The first key behind all keys that start with `key`, whose last character is a dot."""
    return key[:-1] + chr(ord(".") + 1)


class Sweep:
    """The stack of active hosts while keys come in ascending order."""

    def __init__(self):
        self.stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def move(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, path: str, rule: str, verdict: str) -> None:
        self.move(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, []))
        _, rules, sizes = self.stack[-1]
        if path not in rules and len(path) not in sizes:
            sizes.insert(bisect_left(sizes, len(path)), len(path))
        if rules.get(path, ("", ""))[1] != "block":
            rules[path] = (rule, verdict)

    def judge(self, key: str, path: str) -> tuple[str, str] | None:
        self.move(key)
        best, best_size = None, (-1, -1)
        for held, rules, sizes in self.stack:
            for n in sizes:
                if n <= len(path) and path[:n] in rules:
                    size = (len(held) - 1 + n, len(held))
                    if size >= best_size:
                        best, best_size = rules[path[:n]], size
        return best


def apply_rules(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for pages (page_id, url) and rules (host, path, verdict)."""
    spark = pages.sparkSession
    n_ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = page_parts(pages).select("*", host_key(F.col("host")).alias("key"), F.xxhash64("page_id", "path").alias("tie"))
    n_pages = parts.count()  # from file footers and row counts only
    share = min(1.0, KEYS_PER_RANGE * n_ranges / max(1, n_pages))
    # KEYS_PER_RANGE keys for each range, whatever the size of the input
    sample = parts.select("key", "path", "tie").sample(share, seed=7).collect() if n_pages else []
    keys = sorted(tuple(r) for r in sample)
    bounds = sorted({keys[len(keys) * i // n_ranges] for i in range(1, n_ranges)}) if keys else []
    edges = spark.sparkContext.broadcast(bounds)

    schema = pa.schema(
        [("range_id", pa.int32()), ("key", pa.string()), ("kind", pa.int32()), ("path", pa.string())]
        + [("page_id", pa.int64()), ("host", pa.string()), ("rule", pa.string()), ("verdict", pa.string())]
    )
    ddl = "range_id int, key string, kind int, path string, page_id long, host string, rule string, verdict string"

    def place_pages(batches):
        for b in batches:
            key, path, tie = (b.column(b.schema.get_field_index(n)).to_pylist() for n in ("key", "path", "tie"))
            ids = [bisect_right(edges.value, k) for k in zip(key, path, tie, strict=True)]
            none = pa.nulls(len(ids), pa.string())
            kind = pa.array([1] * len(ids), pa.int32())
            columns = [b.column(b.schema.get_field_index(n)).cast(schema.field(n).type) for n in ("path", "page_id", "host")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int32()), pa.array(key, pa.string()), kind, *columns, none, none], schema=schema
            )

    def place_rules(batches):
        for b in batches:
            out = {n: [] for n in ("range_id", "key", "path", "host", "rule", "verdict")}
            for row in b.to_pylist():
                first = bisect_left(edges.value, (row["key"],))
                last = bisect_left(edges.value, (_end(row["key"]),))
                for k in range(first, last + 1):
                    out["range_id"].append(k)
                    for n in ("key", "path", "host", "verdict"):
                        out[n].append(row[n])
                    out["rule"].append(row["host"] + row["path"])
            out |= {"kind": [0] * len(out["key"]), "page_id": [None] * len(out["key"])}
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    wanted = (
        rules.select(
            F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            F.col("verdict").cast("string").alias("verdict"),
        )
        .where("host != ''")
        .withColumn("key", host_key(F.col("host")))
    )
    result = pa.schema(
        [("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())]
    )

    def sweep(batches):
        state, at = Sweep(), None
        for b in batches:
            out = {f.name: [] for f in result}
            rows = zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True)
            for range_id, key, kind, path, page_id, host, rule, verdict in rows:
                if range_id != at:
                    state, at = Sweep(), range_id
                if kind == 0:
                    state.open(key, path, rule, verdict)
                    continue
                found = state.judge(key, path) or (None, default)
                for name, value in zip(out, (page_id, host, path, *found), strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in result], schema=result)

    placed = parts.mapInArrow(place_pages, ddl).unionByName(wanted.mapInArrow(place_rules, ddl))
    return (
        placed.repartition(n_ranges, "range_id")
        .sortWithinPartitions("range_id", "key", "kind", "path", "verdict")
        .mapInArrow(sweep, "page_id long, host string, path string, rule string, verdict string")
    )
