"""Language of a text by unigram pieces, summed over all segmentations.

Words are runs of letters, lower-cased, with the vocabulary's mark of a word's
start in front. A language gives every piece of a fixed public vocabulary a
probability; a word's probability is the sum over all ways to cut it into
pieces, by the forward algorithm. Any single character is a piece too (of one
shared unknown kind if the vocabulary lacks it), so every word has a
probability.

Learning: counts of distinct words per language, then a few rounds of
expectation maximisation, each a pass over the word table with the present
probabilities broadcast and expected piece counts summed by Spark. What is
broadcast and summed is bounded by vocabulary times languages. The word table
comes from about `SAMPLE_DOCS` documents of each language, chosen by hash; this
is the bound on the classifier's training sample.

Scoring: a worker keeps the words it has scored, up to a fixed number, so only
new words are cut into pieces; text goes through Arrow as numbered words.

Defined cases: texts of any length are read whole, some megabytes at once; a
null text or one without a letter is `und` with score 0 (signs such as ² or ½
are no letters); languages that differ in case only are two languages; with
nothing to learn from, every text is; documents with a null language or id are
not learned from; a null id is not held out; repeated rows give a row each.
Other columns of the inputs are ignored, and lang, source and doc_id are never
inputs of a prediction.
"""

from __future__ import annotations

import re
import sys
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrain.llm.common import WordCodes, column, kept_by_worker, rows_kernel, slices
from fleetgrain.session import cut_lineage

SAMPLE_DOCS = 1000
ROUNDS = 3
#: Sums over longer words are scaled.
LONGEST_PLAIN = 40
WORDS_KEPT = 300_000
SMOOTHING = 0.1
START = "▁"

_LETTERS = re.compile(r"[^\W\d_]+")


def vocabulary(model_file: str) -> list[str]:
    """The model's pieces of lower-case letters, with or without the start mark, in a fixed order."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if (body := p.removeprefix(START)).isalpha() and body == body.lower())


class Pieces:
    """The vocabulary as a trie in arrays, so that all places of all words step down it together.

    A step is one look-up in a dense table of nodes by letters that longer
    pieces use; pieces of one character are found by code point.
    """

    def __init__(self, pieces: list[str]):
        self.unknown = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        points = range(sys.maxunicode + 1)
        self.single = np.full(len(points), self.unknown, np.int32)
        self.letter = np.zeros(len(points), np.int16)
        letters = sorted({c for p in pieces if len(p) > 1 for c in p})
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        nodes: dict[str, int] = {"": 0}
        for i, p in enumerate(pieces):
            if len(p) == 1:
                self.single[ord(p)] = i
                continue
            for k in range(1, len(p) + 1):
                nodes.setdefault(p[:k], len(nodes))
        self.step = np.zeros((len(nodes), len(letters) + 1), np.int32)
        for text, node in nodes.items():
            if text:
                self.step[nodes[text[:-1]], self.letter[ord(text[-1])]] = node
        self.piece = np.full(len(nodes), -1, np.int32)
        for i, p in enumerate(pieces):
            if len(p) > 1:
                self.piece[nodes[p]] = i

    def edges(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """(word, start, end, piece) of every piece at every place of the marked words."""
        points = np.frombuffer((START + START.join(words)).encode("utf-32-le"), np.uint32) if words else np.zeros(0, np.uint32)
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes)
        start = np.arange(len(points)) - (ends - sizes)[word]
        letters = self.letter[points]
        found = [(word, start, start + 1, self.single[points])]
        at = np.arange(len(points))
        node = self.step[0, letters]
        for size in range(2, self.longest + 1):
            alive = (node > 0) & (at + size <= ends[word[at]])
            at, node = at[alive], node[alive]
            node = self.step[node, letters[at + size - 1]]
            piece = self.piece[node]
            hit = (node > 0) & (piece >= 0)
            found.append((word[at[hit]], start[at[hit]], start[at[hit]] + size, piece[hit]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Lattice:
    """All pieces of a list of words, and sums over the ways to cut the words into them."""

    def __init__(self, words: list[str], pieces: Pieces):
        self.word, self.start, self.end, self.piece = pieces.edges(words)
        self.lengths = np.array([len(w) + 1 for w in words], np.int64)

    def forward(self, odds: np.ndarray) -> np.ndarray:
        """Log sums over all segmentations by (word, language), from a piece's probability by (piece, language)."""
        if self.lengths.max(initial=0) > LONGEST_PLAIN + 1:
            return self._scaled_forward(odds)
        return np.log(self._sums(odds, self.word, self.start, self.end)[self.lengths, np.arange(len(self.lengths))])

    def _sums(self, odds: np.ndarray, word: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Sums of what leads to each place, by (place, word, language); short words need no scaling."""
        n_words, longest, langs = len(self.lengths), int(self.lengths.max(initial=0)), odds.shape[1]
        sums = np.zeros((longest + 1, n_words, langs))
        sums[0] = 1.0
        order = np.argsort(end, kind="stable")
        cuts = np.searchsorted(end[order], np.arange(longest + 2))
        for j in range(1, longest + 1):
            edges = order[cuts[j] : cuts[j + 1]]
            w = word[edges]
            part = sums[start[edges], w] * odds[self.piece[edges]]
            for k in range(langs):
                sums[j, :, k] = np.bincount(w, part[:, k], n_words)
        return sums

    def _scaled_forward(self, odds: np.ndarray) -> np.ndarray:
        return self._log_sums(odds, self.word, self.start, self.end)[self.lengths, np.arange(len(self.lengths))]

    def _log_sums(self, odds: np.ndarray, word: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Logs of what `_sums` gives, for words of any length."""
        n_words, longest, langs = len(self.lengths), int(self.lengths.max(initial=0)), odds.shape[1]
        alpha, scale = np.zeros((longest + 1, n_words, langs)), np.zeros((longest + 1, n_words, langs))
        alpha[0] = 1.0
        order = np.argsort(end, kind="stable")
        cuts = np.searchsorted(end[order], np.arange(longest + 2))
        for j in range(1, longest + 1):
            edges = order[cuts[j] : cuts[j + 1]]
            w, i = word[edges], start[edges]
            # sums of earlier places are scaled; bring them to the scale of the place just before
            part = alpha[i, w] * np.exp(scale[i, w] - scale[j - 1, w]) * odds[self.piece[edges]]
            total = np.stack([np.bincount(w, part[:, k], n_words) for k in range(langs)], axis=1)
            reached = total > 0
            scale[j] = scale[j - 1] + np.log(np.where(reached, total, 1.0))
            alpha[j] = reached
        return scale

    def expected(self, odds: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece by (piece, language), words weighed by counts of (word, language)."""
        scaled = self.lengths.max(initial=0) > LONGEST_PLAIN + 1
        sums = self._log_sums if scaled else self._sums
        before = sums(odds, self.word, self.start, self.end)
        # the same sums from the words' ends
        size = self.lengths[self.word]
        behind = sums(odds, self.word, size - self.end, size - self.start)
        total = before[self.lengths, np.arange(len(self.lengths))]
        if scaled:
            logs = before[self.start, self.word] + np.log(odds)[self.piece] + behind[size - self.end, self.word]
            chance = np.exp(logs - total[self.word]) * counts[self.word]
        else:
            chance = before[self.start, self.word] * odds[self.piece] * behind[size - self.end, self.word]
            chance *= (counts / total)[self.word]
        return np.stack([np.bincount(self.piece, chance[:, k], len(odds)) for k in range(odds.shape[1])], axis=1)


def by_length(words: list[str]) -> Iterator[list[int]]:
    """Places of words of like length together, as shorter ones would wait for longer ones; long words apart."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    plain = bisect_right(order, LONGEST_PLAIN, key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        stop = plain if at < plain else len(order)
        longest = len(words[order[min(at + 4096, stop) - 1]])
        part = order[at : min(stop, at + max(1, min(4096, 200_000 // (longest + 1))))]
        yield part
        at += len(part)


def runs(chunk: str) -> list[str]:
    """The lower-cased letter runs of a white-space separated piece of text; number signs such as ² are no letters."""
    found = _LETTERS.findall(chunk.lower())
    if all(map(str.isalpha, found)):
        return found
    return "".join(c if c.isalpha() else " " for c in " ".join(found)).split()


def learnable(docs: DataFrame) -> DataFrame:
    """doc_id, text and lang of what may be learned from: crc32 of the id's text mod 3 is not 1."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    return chosen.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def word_counts(docs: DataFrame, sample_docs: int) -> tuple[DataFrame, dict[str, int]]:
    """(word, [(lang, n)]) of a sample of about `sample_docs` documents of each language, and documents by language.

    A language is its number in the order of the second result, so its name may be any text.
    """
    open_docs = learnable(docs)
    sizes = cut_lineage(open_docs.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")))
    held = {r["lang"]: r["docs"] for r in sorted(sizes.collect())}  # one row per language
    numbered = [(lang, k, n) for k, (lang, n) in enumerate(held.items())]
    sizes = docs.sparkSession.createDataFrame(numbered, "lang string, number int, docs long")
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6 < sample_docs / F.col("docs")
    # one row per language, each of which the model has a column for
    sample = open_docs.join(F.broadcast(sizes), "lang").where(share).select(F.col("number").alias("lang"), "text")
    schema = pa.schema([("lang", pa.int32()), ("word", pa.string()), ("n", pa.int64())])

    def count(batches):
        for batch in slices(batches):
            found = Counter()
            words = WordCodes(batch.column(1), lower=True)
            for i, lang in enumerate(batch.column(0).to_pylist()):
                codes, n = np.unique(words[i], return_counts=True)
                for code, times in zip(codes.tolist(), n.tolist(), strict=True):
                    for run in runs(words.distinct[code]):
                        found[lang, run] += times
            columns = [[k[0] for k in found], [k[1] for k in found], list(found.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    counted = sample.mapInArrow(count, "lang int, word string, n long")
    by_word = counted.groupBy("word", "lang").agg(F.sum("n").alias("n"))
    return cut_lineage(by_word.groupBy("word").agg(F.collect_list(F.struct("lang", "n")).alias("counts"))), held


def learn(docs: DataFrame, model_file: str, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> dict | None:
    """Languages, log priors and log probabilities of pieces, or nothing without documents to learn from."""
    table, held = word_counts(docs, sample_docs)
    langs = list(held)
    if not langs:
        return None
    pieces = vocabulary(model_file)
    size = len(pieces) + 1
    spark = docs.sparkSession
    odds = np.full((size, len(langs)), 1.0 / size)
    schema = pa.schema([("piece", pa.int32()), ("lang", pa.int32()), ("uses", pa.float64())])
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((pieces, odds))

        def count(batches, shared=shared):
            names, odds = shared.value
            pieces = Pieces(names)
            uses = np.zeros(odds.shape)
            for batch in batches:
                if batch.num_rows:
                    counts, n = batch.column(1), np.zeros((batch.num_rows, odds.shape[1]))
                    of = np.repeat(np.arange(batch.num_rows), pc.list_value_length(counts).to_numpy())
                    lang, times = (c.to_numpy() for c in counts.flatten().flatten())
                    n[of, lang] = times
                    words = batch.column(0).to_pylist()
                    for part in by_length(words):
                        uses += Lattice([words[i] for i in part], pieces).expected(odds, n[part])
            piece, lang = np.nonzero(uses)
            columns = [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(uses[piece, lang])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

        summed = table.mapInArrow(count, "piece int, lang int, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses"))
        found = summed.toArrow()  # vocabulary times languages at most
        uses = np.zeros(odds.shape)
        uses[found.column(0).to_numpy(), found.column(1).to_numpy()] = found.column(2).to_numpy()
        # sums of doubles in another order differ in the last digits; rounding makes reruns agree
        odds = np.round(uses, 4) + SMOOTHING
        odds /= odds.sum(axis=0)
    prior = np.log(np.array([held[k] for k in langs], float) / sum(held.values()))
    return {"langs": langs, "pieces": pieces, "odds": odds, "prior": prior}


class Scorer:
    """Log probabilities of white-space separated pieces of text, kept by piece of text and by word."""

    def __init__(self, model: dict):
        self.pieces, self.odds = Pieces(model["pieces"]), model["odds"]
        self.chunks = Kept(self.odds.shape[1], self._chunks)
        self.words = Kept(self.odds.shape[1], self._words)

    def _words(self, words: list[str]) -> np.ndarray:
        logs = np.zeros((len(words), self.odds.shape[1]))
        for part in by_length(words):
            logs[part] = Lattice([words[i] for i in part], self.pieces).forward(self.odds)
        return logs

    def _chunks(self, chunks: list[str]) -> np.ndarray:
        found = [runs(c) for c in chunks]
        words = list({w for f in found for w in f})
        place = dict(zip(words, range(len(words)), strict=True))
        rows = self.words.of(words)
        of = np.repeat(np.arange(len(found)), [len(f) for f in found])
        at = [place[w] for f in found for w in f]
        return np.stack([np.bincount(of, rows[at, k], len(found)) for k in range(rows.shape[1])], axis=1)

    def of(self, chunks: list[str]) -> np.ndarray:
        """A row of log probabilities for each chunk; chunks without letters have zeros."""
        return self.chunks.of(chunks)


class Kept:
    """Rows of numbers by text, made when first asked for; emptied when there are too many."""

    def __init__(self, width: int, make):
        self.width, self.make = width, make
        self._empty()

    def _empty(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1024, self.width))

    def of(self, texts: list[str]) -> np.ndarray:
        if len(self.place) > WORDS_KEPT:
            self._empty()
        new = [t for t in texts if t not in self.place]
        if new:
            held = len(self.place)
            if held + len(new) > len(self.rows):
                grown = np.zeros((2 * (held + len(new)), self.width))
                grown[:held] = self.rows[:held]
                self.rows = grown
            self.rows[held : held + len(new)] = self.make(new)
            self.place.update(zip(new, range(held, held + len(new)), strict=True))
        return self.rows[[self.place[t] for t in texts]]


RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def batch_columns(batch):
        model = shared.value
        made = {"doc_id": column(batch, "doc_id"), "held_out": column(batch, "held_out"), "lang_pred": [], "score": []}
        if not model:
            return made | {"lang_pred": ["und"] * batch.num_rows, "score": [0.0] * batch.num_rows}
        scorer = kept_by_worker("language", key, lambda: Scorer(model))
        words = WordCodes(batch.column(batch.schema.get_field_index("text")), lower=True)
        rows = scorer.of(words.distinct) if words.distinct else np.zeros((0, len(model["langs"])))
        doc = np.repeat(np.arange(len(words)), np.diff(words.ends))
        sums = np.stack([np.bincount(doc, rows[words.codes, k], len(words)) for k in range(rows.shape[1])], axis=1)
        for total in sums:
            if not total.any():  # a word's log probability is never 0
                made["lang_pred"].append("und")
                made["score"].append(0.0)
                continue
            total = total + model["prior"]
            best = int(np.argmax(total))
            made["lang_pred"].append(model["langs"][best])
            made["score"].append(float(1.0 / np.exp(total - total[best]).sum()))
        return made

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = chosen.withColumn("held_out", held_out(F.col("doc_id")))
    return chosen.mapInArrow(rows_kernel(batch_columns, schema), RESULT)
