"""Quality rules whose cutoffs are certified on labelled documents.

A rule compares one measure of a text with a cutoff. For every stratum and rule
the cutoffs are tested from the mildest to the strictest; a test passes while
the exact (Clopper-Pearson) upper bound on the share of good documents that the
cutoff rejects stays at or below `false_share`. The first failure ends the
sequence, so one rule and stratum need no correction among their own cutoffs
(fixed-sequence testing); over rules and strata the error `miss` is divided by
their number (Bonferroni). Hence, with probability 1 - `miss`, no rule rejects
more than `false_share` of the good documents of any stratum. A trial is a
distinct text of a stratum: copies are no further evidence. Among certified
cutoffs the one that removes most bad documents net of `harm` times the good
ones is used, the mildest on ties. A stratum with too few labels certifies
nothing and rejects nothing by rule.

Defined cases: a null or empty text has measures of 0 and fails the base check
for want of words; a text of any length is measured whole, some megabytes at
once; a null doc_id is returned as null and meets no label; a null stratum is a
stratum of its own; repeated rows are measured one by one; labels that are null, or of unknown documents, count for
nothing, and a document or text with contradicting labels counts as bad; without
labels nothing is certified. Other columns of the inputs are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrain.llm.bitsets import bitmap, marked
from fleetgrain.llm.common import WHITE_BYTES, WordCodes, column, encoded, filter_rows, rows_kernel
from fleetgrain.session import cut_lineage

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEVELS = 100
#: Bits of the set of labelled ids; an id that it marks needlessly only costs its measures.
LABEL_BITS = 1 << 26

#: Measures with their rule, each a share of 0 to 1 counted in hundredths, larger is worse.
RULES = ("symbols", "bangs", "capitals", "dup_lines", "repeats", "stutter")


@dataclass(frozen=True)
class RiskLimits:
    min_words: int = 20
    repeat_percent: int = 30
    false_share: float = 0.01
    miss: float = 0.05
    harm: float = 20.0


def repeated_window_words(words: np.ndarray, size: int = WINDOW) -> int:
    """Words inside windows of `size` (a power of two) words that occur twice or more.

    `words` holds a number for each word. Windows are compared exactly: each
    step numbers the pairs of equal half windows, and stops once all differ.
    """
    if len(words) <= size:
        return 0
    names, width = words, 1
    while width < size:
        pairs = names[:-width] * (int(names.max()) + 1) + names[width:]
        seen, names = np.unique(pairs, return_inverse=True)
        if len(seen) == len(pairs):
            return 0
        width *= 2
    twice = np.flatnonzero(np.bincount(names)[names] > 1)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def _hundredths(part: int, whole: int) -> int:
    return min(LEVELS, LEVELS * part // whole) if whole else 0


def measure_text(raw: bytes | None, words: np.ndarray, capital: np.ndarray) -> dict[str, int]:
    """Counts of one UTF-8 text and the level of each rule; `capital` tells which word numbers are in capitals."""
    raw = raw or b""
    n = len(words)
    points = len(raw) if raw.isascii() else len(raw.decode("utf-8"))
    chars = points - (len(raw) - len(raw.translate(None, WHITE_BYTES)))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    repeats = repeated_window_words(words)
    return {
        "n_words": n,
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeats,
        "symbols": _hundredths(symbols, chars),
        "bangs": _hundredths(raw.count(b"!"), n),
        "capitals": _hundredths(int(capital[words].sum()), n),
        "dup_lines": _hundredths(dup_lines, len(lines)),
        "repeats": _hundredths(repeats, n),
        "stutter": _hundredths(int((words[1:] == words[:-1]).sum()), n),
    }


def measure_batch(batch: pa.RecordBatch) -> list[dict[str, int]]:
    words = WordCodes(batch.column(batch.schema.get_field_index("text")))
    capital = np.array([w.isupper() for w in words.distinct], dtype=bool)
    return [measure_text(raw, words[i], capital) for i, raw in enumerate(encoded(batch, "text"))]


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """One row per document: doc_id, stratum, a hash of its text, the counts and the rule levels."""
    fields = [pa.field("doc_id", pa.int64()), pa.field("stratum", pa.string()), pa.field("text_key", pa.int64())]
    fields += [pa.field(n, pa.int64()) for n in COUNTS] + [pa.field(n, pa.int32()) for n in RULES]
    schema = pa.schema(fields)

    def batch_columns(batch):
        measures = measure_batch(batch)
        made = {n: [m[n] for m in measures] for n in (*COUNTS, *RULES)}
        return made | {name: column(batch, name) for name in ("doc_id", "stratum", "text_key")}

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.col(stratum).cast("string").alias("stratum"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
    )
    ddl = "doc_id long, stratum string, text_key long, " + ", ".join(f"{n} long" for n in COUNTS)
    ddl += ", " + ", ".join(f"{n} int" for n in RULES)
    return chosen.mapInArrow(rows_kernel(batch_columns, schema), ddl)


def tail_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial count: k of n is at or below the bound p when this is small."""
    if k >= n:
        return 1.0
    i = np.arange(1, k + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log((n - i + 1) / i))])
    logs += np.arange(k + 1) * math.log(p) + (n - np.arange(k + 1)) * math.log1p(-p)
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def upper_bound(k: int, n: int, error: float) -> float:
    """Clopper-Pearson upper bound on a share seen as k of n, wrong with probability `error`."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if mid < 1 and tail_at_most(k, n, mid) > error else (low, mid)
    return high


def choose_cutoff(good: np.ndarray, bad: np.ndarray, limits: RiskLimits, error: float) -> tuple[int, int, int, float]:
    """The level above which to reject, from counts by level: (cutoff, rejected good, rejected bad, bound)."""
    n = int(good.sum())
    best = (LEVELS, 0, 0, 0.0, 0.0)
    false = caught = 0
    for cutoff in range(LEVELS - 1, -1, -1):
        false += int(good[cutoff + 1])
        caught += int(bad[cutoff + 1])
        if n == 0 or tail_at_most(false, n, limits.false_share) > error:
            break
        if caught - limits.harm * false > best[4]:
            best = (cutoff, false, caught, upper_bound(false, n, error), caught - limits.harm * false)
    return best[:4]


CERTIFIED = "stratum string, rule string, cutoff int, n_good long, false_rejects long, bad_rejects long, bound double"


def certify(measured: DataFrame, labels: DataFrame, limits: RiskLimits = RiskLimits()) -> DataFrame:
    """One row per stratum and rule: the certified cutoff and what it rests on.

    Labels meet measures in one join of narrow rows; counts per level are summed
    before they are shuffled, so a stratum of any size is a few hundred numbers.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    levels = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("level")) for r in RULES])).alias("x")
    trials = measured.join(marks, "doc_id").groupBy("stratum", "text_key").agg(
        F.min("quality").alias("quality"), *[F.first(r).alias(r) for r in RULES]
    )
    counts = cut_lineage(
        trials.select("stratum", "quality", levels)
        .groupBy("stratum", "x.rule", "x.level")
        .agg(F.sum((F.col("quality") > 0).cast("long")).alias("good"), F.sum((F.col("quality") <= 0).cast("long")).alias("bad"))
    )
    tests = max(1, counts.select("stratum", "rule").distinct().count())
    error = limits.miss / tests

    def of_stratum(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for rule, part in frame.groupby("rule"):
            good, bad = np.zeros(LEVELS + 1, np.int64), np.zeros(LEVELS + 1, np.int64)
            good[part["level"]] = part["good"]
            bad[part["level"]] = part["bad"]
            cutoff, false, caught, bound = choose_cutoff(good, bad, limits, error)
            out.append((frame["stratum"].iloc[0], rule, cutoff, int(good.sum()), false, caught, bound))
        return pd.DataFrame(out, columns=[c.split()[0] for c in CERTIFIED.split(", ")])

    return counts.groupBy("stratum").applyInPandas(of_stratum, CERTIFIED)


def judge(docs: DataFrame, labels: DataFrame, limits: RiskLimits = RiskLimits(), stratum: str = "lang") -> DataFrame:
    """doc_id, the counts, base_failed, kept, and the names of the certified rules a text breaks."""
    measured = cut_lineage(measure(docs, stratum))
    cutoffs = certify(measured, labels, limits).groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))
    cutoffs = cut_lineage(cutoffs.select(F.col("stratum").alias("of"), *[F.col(r).alias(f"max_{r}") for r in RULES]))
    broken = F.filter(
        F.array(*[F.when(F.col(r) > F.coalesce(F.col(f"max_{r}"), F.lit(LEVELS)), F.lit(r)) for r in RULES]),
        lambda name: name.isNotNull(),
    )
    base = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")
    )
    return (
        measured.join(cutoffs, F.col("stratum").eqNullSafe(F.col("of")), "left")
        .withColumn("broken_rules", broken)
        .withColumn("base_failed", base)
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))
        .select("doc_id", *COUNTS, "base_failed", "kept", "broken_rules")
    )


def keep(docs: DataFrame, labels: DataFrame, limits: RiskLimits = RiskLimits(), stratum: str = "lang") -> DataFrame:
    """The documents, with all their columns, that pass the base check and break no certified rule.

    Only texts that a bitmap of labelled ids marks are measured for the certificate. All rows are judged with the
    cutoffs, a number per rule and stratum, so no text is shuffled.
    """
    asked = labels.where("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(stratum).alias("stratum"))
    labelled = marked(narrow, [F.col("doc_id")], bitmap(asked, LABEL_BITS), LABEL_BITS, "labelled").where("labelled")
    found = certify(cut_lineage(measure(labelled, "stratum")), labels, limits).select("stratum", "rule", "cutoff").collect()
    cutoffs = {(r["stratum"], r["rule"]): r["cutoff"] for r in found}

    def passes(batch):
        return [
            m["n_words"] >= limits.min_words
            and 100 * m["n_repeat_words"] <= limits.repeat_percent * m["n_words"]
            and all(m[rule] <= cutoffs.get((of, rule), LEVELS) for rule in RULES)
            for m, of in zip(measure_batch(batch), column(batch, stratum), strict=True)
        ]

    return filter_rows(docs, passes)
