"""Token ids in files of fixed-width bit fields.

A file holds ids in the fewest bits that the vocabulary needs, in blocks of
`BLOCK` ids, so a block's place follows from a table at the file's end and any
range of ids can be read alone. 64 ids of b bits fill exactly b words of 64
bits, which lets numpy pack and unpack lane by lane.

    magic "BITIDS01" | blocks | doc ids int64 | doc known uint8 | doc ends uint64
    | block offsets uint64 | tail: bits, block size, docs, ids, blocks, offset of
    the doc table (6 x uint64) | magic

Documents are cut into ranges of doc_id and each task writes one file in
ascending order. Names are unique to an attempt and only the files named by the
manifest, a table that Spark commits, count: a lost or repeated task leaves at
most an unread file behind. The folder must be visible to every executor.

Defined cases: texts of any length are encoded whole, one at least at a time; a
null text is an empty one and gets the end id alone; null
doc_ids come first; equal doc_ids are ordered by a hash of their text and keep
a row each; without documents no file and no row results. Other columns of the
input are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetgrain.llm.common import WordCodes, kept_by_worker, slices, whole
from fleetgrain.session import cut_lineage, shared_dir

MAGIC = b"BITIDS01"
BLOCK = 1 << 16
LANES = 64
TAIL = "<6Q8s"

#: Words a worker keeps with their ids; a bound on memory, not on what is encoded.
WORDS_KEPT = 150_000
JOINED_WORDS = 256


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    lanes = np.zeros(-(-len(ids) // LANES) * LANES, np.uint64)
    lanes[: len(ids)] = ids
    lanes = np.ascontiguousarray(lanes.reshape(-1, LANES).T)
    words = np.zeros((bits, lanes.shape[1]), np.uint64)
    for lane in range(LANES):
        word, shift = divmod(lane * bits, 64)
        words[word] |= lanes[lane] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= lanes[lane] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").tobytes()


def unpack(raw: bytes, bits: int, n: int) -> np.ndarray:
    words = np.ascontiguousarray(np.frombuffer(raw, "<u8").reshape(-1, bits).T)
    lanes = np.empty((LANES, words.shape[1]), np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(LANES):
        word, shift = divmod(lane * bits, 64)
        lanes[lane] = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            lanes[lane] |= words[word + 1] << np.uint64(64 - shift)
        lanes[lane] &= mask
    return np.ascontiguousarray(lanes.T).reshape(-1)[:n].astype("<u4")


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"\w+:", uri):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", uri))
    return pafs.LocalFileSystem(), uri


class TokenFileWriter:
    def __init__(self, uri: str, bits: int):
        system, path = file_system(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.bits = system.open_output_stream(path), bits
        self.out.write(MAGIC)
        self.offsets, self.doc_ids, self.doc_ends, self.n = [len(MAGIC)], [], [], 0
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def add(self, doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents with their numbers of ids, and all their ids."""
        self.doc_ids += doc_ids
        self.doc_ends += (self.n + np.cumsum(sizes)).tolist()
        self.n += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK:
            held = np.concatenate(self.waiting)
            whole = len(held) // BLOCK * BLOCK
            for at in range(0, whole, BLOCK):
                self._block(held[at : at + BLOCK])
            self.waiting, self.n_waiting = [held[whole:]], len(held) - whole

    def _block(self, ids: np.ndarray) -> None:
        raw = pack(ids, self.bits)
        self.out.write(raw)
        self.offsets.append(self.offsets[-1] + len(raw))

    def close(self) -> None:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        self.out.write(np.array([i or 0 for i in self.doc_ids], "<i8").tobytes())
        self.out.write(np.array([i is not None for i in self.doc_ids], "<u1").tobytes())
        self.out.write(np.array(self.doc_ends, "<u8").tobytes())
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        counts = (self.bits, BLOCK, len(self.doc_ids), self.n, len(self.offsets) - 1, self.offsets[-1])
        self.out.write(struct.pack(TAIL, *counts, MAGIC))
        self.out.close()


class TokenFile:
    """Random access to the ids of one file."""

    def __init__(self, uri: str):
        system, path = file_system(uri)
        self.file = system.open_input_file(path)
        tail = struct.calcsize(TAIL)
        self.file.seek(self.file.size() - tail)
        self.bits, self.block, docs, self.n, blocks, at, magic = struct.unpack(TAIL, self.file.read(tail))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        self.file.seek(at)
        doc_ids = np.frombuffer(self.file.read(8 * docs), "<i8")
        known = np.frombuffer(self.file.read(docs), "<u1")
        self.doc_ids = [int(i) if k else None for i, k in zip(doc_ids, known, strict=True)]
        self.doc_ends = np.frombuffer(self.file.read(8 * docs), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(self.file.read(8 * (blocks + 1)), "<u8").astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        self.file.seek(int(self.offsets[first]))
        raw = self.file.read(int(self.offsets[last + 1] - self.offsets[first]))
        held = min(self.n, (last + 1) * self.block) - first * self.block
        return unpack(raw, self.bits, held)[start - first * self.block : stop - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.doc_ends[i - 1]) if i else 0, int(self.doc_ends[i]))

    def close(self) -> None:
        self.file.close()


# letters whose small and composed forms are single, beyond ASCII those of Latin-1 and Latin Extended-A but İ and ŉ
_LETTER = "A-Za-zÀ-ÖØ-öø-įı-ňŊ-ž"
# ASCII punctuation but the apostrophe
_SIGN = r"!-&(-/:-@\[-`{-~"
_PLAIN = f"^[{_LETTER}0-9{_SIGN}]+$"
# signs between letters, digits and white space, where the tokenizer parts them and nothing joins across
_BETWEEN = f"(^|[{_LETTER}0-9 \\t-\\r])([{_SIGN}]+)([{_LETTER}0-9 \\t-\\r]|$)"
# what the tokenizer takes as one: letters, one digit, or signs
_RUN = f"[{_LETTER}]+|[0-9]|[{_SIGN}]+"


class KeptIds:
    """Ids of words, one after the other in one array; a word is a number."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, "<u4")
        self.ends = np.zeros(1 << 14, np.int64)

    def add(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        held = len(self.number)
        end = int(self.ends[held])
        self.ids = _room(self.ids, end + len(ids))
        self.ends = _room(self.ends, held + len(words) + 1)
        self.ids[end : end + len(ids)] = ids
        self.ends[held + 1 : held + len(words) + 1] = end + np.cumsum(sizes)
        self.number.update(zip(words, range(held, held + len(words)), strict=True))


def _room(held: np.ndarray, size: int) -> np.ndarray:
    return held if size <= len(held) else np.concatenate([held, np.zeros(max(size, 2 * len(held)) - len(held), held.dtype)])


def gathered(pool: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ranges of a pool one after the other."""
    before = np.cumsum(sizes) - sizes
    return pool[np.repeat(first - before, sizes) + np.arange(int(sizes.sum()))]


class WordEncoder:
    """Ids of white-space separated words, equal to those of the whole text.

    The tokenizer drops white space and never joins across it, nor between a
    letter and a sign, so such places are parted and distinct words, far fewer
    without their punctuation, are encoded once and kept. Plain words are encoded many in one call;
    the tokenizer parts letters, digits and signs and marks the last id of each
    such run, so a word ends with as many marks as it has runs. What isn't plain
    goes to the tokenizer alone.

    Two generations are kept: when the young one is full it becomes the old one,
    and words of the old one that come again move on without being encoded.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.bits = bits_for(self.tokenizer.get_vocab_size())
        size = max(self.tokenizer.get_vocab().values()) + 1
        self.ends_run = np.zeros(size, bool)
        self.ends_run[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.young, self.old = KeptIds(), KeptIds()

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Encode words that are new and keep their ids."""
        found = pa.array(words, pa.string())
        plain = pc.match_substring_regex(found, _PLAIN)
        alone = pc.filter(found, pc.invert(plain)).to_pylist()
        found = pc.filter(found, plain)
        runs = pc.count_substring_regex(found, _RUN).to_numpy()
        found = found.to_pylist()
        cuts = range(0, len(found), JOINED_WORDS)
        for at, ids in zip(cuts, self._encode([" ".join(found[i : i + JOINED_WORDS]) for i in cuts]), strict=True):
            group, of_word = found[at : at + JOINED_WORDS], runs[at : at + JOINED_WORDS]
            marks = np.flatnonzero(self.ends_run[ids])
            if len(marks) == of_word.sum():
                ends = marks[np.cumsum(of_word) - 1] + 1
                self.young.add(group, np.diff(ends, prepend=0), ids)
            else:
                alone += group
        if alone:
            ids = self._encode(alone)
            self.young.add(alone, np.array([len(x) for x in ids]), np.concatenate(ids))

    def words(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids held, and of each word the first of its ids and their number."""
        if len(self.young.number) > WORDS_KEPT:
            self.young, self.old = KeptIds(), self.young
        new = [w for w in distinct if w not in self.young.number]
        again = [w for w in new if w in self.old.number] if self.old.number else []
        if again:
            at = np.fromiter(map(self.old.number.__getitem__, again), np.int64, len(again))
            sizes = self.old.ends[at + 1] - self.old.ends[at]
            self.young.add(again, sizes, gathered(self.old.ids, self.old.ends[at], sizes))
            new = [w for w in new if w not in self.old.number]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.young.number.__getitem__, distinct), np.int64, len(distinct))
        return self.young.ids, self.young.ends[at], self.young.ends[at + 1] - self.young.ends[at]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of each text, and all ids one after the other."""
        texts = pc.fill_null(whole(texts), "")
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(special), "", texts) if special.any() else texts
        words = WordCodes(pc.replace_substring_regex(plain, _BETWEEN, r"\1 \2 \3"), lower=True)
        pool, first, counts = self.words(words.distinct)
        sizes = counts[words.codes]
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = gathered(pool, first[words.codes], sizes)
        ends = before[words.ends]
        if not special.any():
            return np.diff(ends), ids
        parts = [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        for i in np.flatnonzero(special):
            parts[i] = self._encode([texts[int(i)].as_py()])[0]
        return np.array([len(p) for p in parts], np.int64), np.concatenate(parts)


def with_end(sizes: np.ndarray, ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's ids followed by the end id."""
    return sizes + 1, np.insert(ids, np.cumsum(sizes), end_id).astype("<u4")


MANIFEST = "file string, part int, n_docs long, n_ids long"


def write_ids(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 1) -> DataFrame:
    """Encode and write all documents; the manifest has a row per file: file, part, n_docs, n_ids, start."""
    folder = folder or f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    schema = pa.schema([("file", pa.string()), ("part", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def write(batches):
        encoder = kept_by_worker("words", tokenizer, lambda: WordEncoder(tokenizer))
        part = TaskContext.get().partitionId()
        name, writer = f"{folder}/{part:06d}-{uuid.uuid4().hex}.ids", None
        for batch in slices(batches):
            writer = writer or TokenFileWriter(name, encoder.bits)
            sizes, ids = with_end(*encoder.texts(batch.column(1)), end_id)
            writer.add(batch.column(0).to_pylist(), sizes, ids)
        if writer:
            writer.close()
            row = [[name], [part], [len(writer.doc_ids)], [writer.n]]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    manifest = cut_lineage(ordered.mapInArrow(write, MANIFEST))
    # one row per file, so one small window gives each file's first id
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_ids(manifest: DataFrame, kernel, schema: str, n_files: int) -> DataFrame:
    """Run `kernel(TokenFile, start)`, which yields record batches, on every file, one task each."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["file"])
                yield from kernel(file, row["start"])
                file.close()

    return manifest.select("file", "start").repartitionByRange(max(1, n_files), "start").mapInArrow(read, schema)


DIGESTS = "doc_id long, start long, n_tokens long, ids_crc32 long"
IDS_AT_ONCE = 1 << 20


def _digests(file: TokenFile, start: int):
    schema = pa.schema([(c.split()[0], pa.int64()) for c in DIGESTS.split(", ")])
    ends = file.doc_ends
    first = 0
    while first < len(ends):
        begin = int(ends[first - 1]) if first else 0
        # documents of about IDS_AT_ONCE ids, one at least
        stop = max(first + 1, int(np.searchsorted(ends, begin + IDS_AT_ONCE, "right")))
        raw = file.ids(begin, int(ends[stop - 1])).tobytes()
        cuts = np.concatenate([[begin], ends[first:stop]]) - begin
        crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        rows = [file.doc_ids[first:stop], (start + begin + cuts[:-1]).tolist(), np.diff(cuts).tolist(), crcs]
        yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], schema=schema)
        first = stop


def digests(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 1) -> DataFrame:
    """Write all documents, read the files back: doc_id, start, n_tokens, ids_crc32."""
    manifest = cut_lineage(write_ids(docs, tokenizer, folder, end_id))
    return read_ids(manifest, _digests, DIGESTS, manifest.count())
