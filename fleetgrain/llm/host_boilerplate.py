"""Main text of web pages: markup for what it tells, runs of words repeated on a host for the rest.

A page is cut into blocks of text, each from one of three places: inside an
article or main element, inside an element that markup or its class and id
names as boilerplate (menus, headers, footers, sidebars, notices, adverts,
forms, comments), or open, which is neither.

A page's stream is its words outside articles. Every run of `RUN` words of a
host's distinct streams is counted over the whole host, however many pages it
has; runs of `PAGES` streams or more are repeated substrings, and longer ones
are covered by overlapping runs. Runs are named by 128 bits of a hash with their
host's, counted before they are shuffled, and joined back to their places, so
neither a host nor its pages meet in one task. All pages are counted and every
page's text is judged by the counts.

Pages without an article element keep their open blocks, but an open block whose
words are all covered is boilerplate and goes. Of another one
the repeated runs that lie inside it go and all other words stay; a run that
reaches into it from a neighbour, as from a menu into the first words of a text,
is no evidence against those words.

Pages with an article keep only what is inside it. A block of it goes if every run
of it repeats outside articles and `PAGES` distinct article texts of the host or more
have the whole block: a notice that markup doesn't name. A headline that others list
is in one article only, and a paragraph of copied articles isn't repeated outside.
Which blocks may go is told by a bitmap of the repeated runs first, so only those
are shuffled. If nothing at all would stay, the open blocks or the article do.

Repetition alone can't tell an article that a host shows on several pages from
a menu, so what repeats inside articles only stays, and pages whose open
text is the same count as one, as do pages with the same article.

Defined cases: pages of any length are read whole, in time in proportion to
them; null or empty html, or none but markup, gives an empty text; a
null url belongs to the host ""; broken markup is read as far as it goes (an
unclosed comment or script runs to the end); white space, a no-break space
too, is one space inside a block; repeated rows give a row each. Other columns of the
input are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrain.llm.bitsets import BITS_IN_ROW
from fleetgrain.llm.common import column, rows_kernel
from fleetgrain.session import cut_lineage

RUN = 8
PAGES = 3

#: Bits of the bitmap of repeated runs, 8 MB for any input.
N_BITS = 1 << 26

ARTICLE, OPEN, BOILERPLATE = range(3)

_RAW = "script|style|textarea|title"
_ATTRIBUTES = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b{_ATTRIBUTES}>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9:-]*)({_ATTRIBUTES})>|<[!?/a-z][^>]*>?",
    re.IGNORECASE | re.DOTALL,
)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)

# Elements of HTML that break text, and those that only hold others.
_BREAKS = frozenset(
    "p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd section article main header footer nav aside blockquote pre table thead "
    "tbody tfoot tr td th caption figure figcaption hr address form fieldset legend details summary dialog body html menu option".split()
)
_HOLDERS = frozenset(
    "div section article main header footer nav aside ul ol dl table form fieldset figure details dialog menu span p li button "
    "blockquote body html a".split()
)
_BOILERPLATE_TAGS = frozenset(
    "nav header footer aside form fieldset dialog menu button label select noscript template iframe svg object math".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_NAMES_OUTSIDE = frozenset("nav navbar navigation header footer masthead breadcrumb breadcrumbs topbar toolbar pagination pager".split())
_NAMES = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo banner sidebar menu cookie cookies consent notice "
    "notification popup modal newsletter subscribe signup share sharing social related comment comments disqus respond replies widget".split()
)


def _is_boilerplate(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _BOILERPLATE_TAGS and not (in_article and tag == "header"):
        return True
    for m in _NAMED.finditer(attributes) if attributes.strip() else ():
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name == "role" and value in _ROLES:
            return True
        if name in ("class", "id"):
            parts = set(re.split(r"[^a-z0-9]+", value))
            if parts & _NAMES or not in_article and parts & _NAMES_OUTSIDE:
                return True
    return False


def blocks(page: str) -> list[tuple[int, str]]:
    """(place, text) of the blocks of a page in order, without empty ones."""
    found: list[tuple[int, str]] = []
    held: list[str] = []
    # open elements that hold others: tag, and the place of what is inside
    stack: list[tuple[str, int]] = []
    # how many of them have a tag or lie in a place
    n_open: Counter = Counter()
    place, at = OPEN, 0

    def flush():
        text = " ".join(entities.unescape("".join(held)).split())
        if text:
            found.append((place, text))
        held.clear()

    def close(depth: int) -> int:
        for element in stack[depth:]:
            n_open.subtract(element)
        del stack[depth:]
        return stack[-1][1] if stack else OPEN

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag in _BREAKS:
            flush()
        elif tag == "br":
            held.append(" ")
        if tag not in _HOLDERS and tag not in _BOILERPLATE_TAGS:
            continue
        if m[2]:
            # an end tag inside an article without a start there doesn't end the article
            if n_open[tag]:
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)
                if stack[depth][1] != (stack[depth - 1][1] if depth else OPEN):
                    flush()
                place = close(depth)
            continue
        # a paragraph ends where the next block starts, an item where the next item does
        if stack and (stack[-1][0] == "p" and tag in _BREAKS or stack[-1][0] == tag == "li"):
            place = close(len(stack) - 1)
        inside = place
        if place == BOILERPLATE and tag in ("article", "main") and not n_open[ARTICLE]:
            # a menu or advert that was never closed, not comments or related items inside an article
            place = OPEN
        if place != BOILERPLATE:
            if _is_boilerplate(tag, m[4] or "", place == ARTICLE):
                inside = BOILERPLATE
            elif tag in ("article", "main"):
                inside = ARTICLE
            else:
                inside = place
        if inside != place:
            flush()
        stack.append((tag, inside))
        n_open.update(stack[-1])
        place = inside
    held.append(page[at:])
    flush()
    return found


def _hash(text: str) -> np.ndarray:
    """128 bits as two numbers."""
    return np.frombuffer(hashlib.blake2b(text.encode(), digest_size=16).digest(), np.uint64)


class WordHashes(dict):
    """Places of words in a table of their hashes; a word is hashed when it is first met."""

    def __init__(self):
        self.table = np.zeros((1024, 2), np.uint64)

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at] = _hash(word)
        return at


def run_keys(words: list[str], names: WordHashes, host: str = "", run: int = RUN) -> np.ndarray:
    """A key of two numbers for the run of words of a host that starts at each place; `names` keeps hashes of words."""
    n = len(words) - run + 1
    if n <= 0:
        return np.zeros((0, 2), np.int64)
    at = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
    hashed = np.ascontiguousarray(names.table[at].T)
    keys = np.repeat(_hash(f"host {host}")[:, None], n, axis=1)
    for i in range(run):
        # an odd factor for each place
        keys += hashed[:, i : i + n] * (_hash(f"place {i}") | np.uint64(1))[:, None]
    return keys.view(np.int64).T


def distinct_keys(keys: np.ndarray) -> np.ndarray:
    pairs = np.ascontiguousarray(keys).view([("a", np.int64), ("b", np.int64)]).ravel()
    return np.unique(pairs).view(np.int64).reshape(-1, 2)


def covered_by(starts, n: int, run: int = RUN) -> np.ndarray:
    """Which of n words lie in a run that starts at one of the places."""
    edge = np.zeros(n + 1, np.int64)
    starts = np.asarray(starts, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + run, -1)
    return np.cumsum(edge)[:n] > 0


def covered_words(streams: list[list[str]], run: int = RUN, pages: int = PAGES) -> list[np.ndarray]:
    """For each page's words, which lie in a substring of `run` words or more found in `pages` distinct pages or more."""
    names = WordHashes()
    keys = [run_keys(s, names, run=run) for s in streams]
    seen: dict[tuple, int] = {}
    for found in keys:
        for key in map(tuple, distinct_keys(found).tolist()):
            seen[key] = seen.get(key, 0) + 1
    return [
        covered_by([i for i, key in enumerate(map(tuple, found.tolist())) if seen[key] >= pages], len(s), run)
        for s, found in zip(streams, keys, strict=True)
    ]


def open_text(outside: list[tuple[int, str]], starts: list[int]) -> str:
    """What stays of a page without an article, given where repeated runs start in its stream."""
    parts = [(place, text.split(" ")) for place, text in outside]
    starts = np.sort(np.asarray(starts, np.int64))
    covered = covered_by(starts, sum(len(words) for _, words in parts))
    at, unique, every = 0, [], []
    for place, words in parts:
        end = at + len(words)
        if place == OPEN:
            every.append(" ".join(words))
            if not covered[at:end].all():
                first, last = np.searchsorted(starts, [at, max(at, end - RUN + 1)])
                inside = covered_by(starts[first:last] - at, len(words))
                unique.append(" ".join(w for w, gone in zip(words, inside, strict=True) if not gone))
        at = end
    return "\n".join([t for t in unique if t] or every)


def article_text(inside: list[str], gone: list[int]) -> str:
    """What stays of an article, given the numbers of its repeated blocks."""
    dropped = set(gone)
    return "\n".join([t for i, t in enumerate(inside) if i not in dropped] or inside)


BLOCKS = "array<struct<place int, text string>>"

# the key of what is judged of a page, its article or else its stream
KEY = ["key_a", "key_b"]


def _parsed(pages: DataFrame) -> DataFrame:
    """Every page with its blocks, the key of its words outside articles, and the key of what is judged of it."""
    url = F.coalesce("url", F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html"
    ).withColumn("host", F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)))
    lists = pa.list_(pa.struct([("place", pa.int32()), ("text", pa.string())]))
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("article", pa.bool_()), ("open", pa.bool_())]
        + [(n, pa.int64()) for n in ("stream_a", "stream_b", *KEY)]
        + [("blocks", lists)]
    )

    def parse(batch):
        made = {n: column(batch, n) for n in ("page_id", "url", "host")} | {f.name: [] for f in schema if f.name not in ("page_id", "url", "host")}
        for host, page in zip(made["host"], column(batch, "html"), strict=True):
            found = blocks(page or "")
            inside = [t for p, t in found if p == ARTICLE]
            words = " ".join(t for p, t in found if p != ARTICLE)
            stream = _hash(f"{len(host)} {host} {words}").view(np.int64).tolist()
            key = _hash("\n".join(["article", host, *inside])).view(np.int64).tolist() if inside else stream
            made["article"].append(bool(inside))
            made["open"].append(not inside and any(p == OPEN for p, _ in found))
            for name, value in zip(("stream_a", "stream_b", *KEY), (*stream, *key), strict=True):
                made[name].append(value)
            made["blocks"].append([{"place": p, "text": t} for p, t in found])
        return made

    ddl = f"page_id long, url string, host string, article boolean, open boolean, stream_a long, stream_b long, key_a long, key_b long, blocks {BLOCKS}"
    return keyed.mapInArrow(rows_kernel(parse, schema), ddl)


def _runs(streams: DataFrame, places: bool) -> DataFrame:
    """Keys of the runs of each stream: distinct ones, or with the stream and the place of each."""
    names = ["run_a", "run_b", *(["stream_a", "stream_b", "place"] if places else [])]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def batch_runs(batch):
        known = WordHashes()
        made = [np.zeros((0, len(names)), np.int64)]
        for host, text, a, b in zip(*(column(batch, n) for n in ("host", "text", "stream_a", "stream_b")), strict=True):
            keys = run_keys(text.split(" "), known, host)
            if places:
                n = len(keys)
                made.append(np.column_stack([keys, np.full(n, a), np.full(n, b), np.arange(n)]))
            else:
                made.append(distinct_keys(keys))
        return dict(zip(names, np.concatenate(made).T, strict=True))

    return streams.mapInArrow(rows_kernel(batch_runs, schema), ", ".join(f"{n} long" for n in names))


def _bits(runs: DataFrame) -> np.ndarray:
    """Bitmap of the runs, at most `N_BITS` however many there are."""
    place = (F.pmod("run_a", F.lit(N_BITS)) + 1).alias("place")
    rows = runs.select(place).groupBy(F.bitmap_bucket_number("place").alias("row"))
    bits = np.zeros(N_BITS // 8, np.uint8)
    for r in rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect():
        first = (r["row"] - 1) * BITS_IN_ROW // 8
        bits[first : first + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _maybe_repeated(parsed: DataFrame, repeated: DataFrame) -> DataFrame:
    """Blocks of articles whose runs are all in the bitmap of the repeated ones, with their host, article and number."""
    shared = parsed.sparkSession.sparkContext.broadcast(_bits(repeated))
    schema = pa.schema(
        [("host", pa.string()), ("text", pa.string())] + [(n, pa.int64()) for n in ("stream_a", "stream_b", *KEY, "nth")]
    )

    def look(batch):
        bits, known = shared.value, WordHashes()
        made = {f.name: [] for f in schema}
        for host, a, b, found in zip(*(column(batch, n) for n in ("host", *KEY, "blocks")), strict=True):
            inside = [x["text"] for x in found if x["place"] == ARTICLE]
            words = [t.split(" ") for t in inside]
            at = run_keys(list(chain.from_iterable(words)), known, host)[:, 0] % N_BITS
            strange = np.concatenate([[0], np.cumsum(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 0)])
            first = 0
            for nth, (text, parts) in enumerate(zip(inside, words, strict=True)):
                n = len(parts) - RUN + 1
                if n > 0 and strange[first] == strange[first + n]:
                    block = _hash(f"{len(host)} {host} {text}").view(np.int64).tolist()
                    for name, value in zip(schema.names, (host, text, *block, a, b, nth), strict=True):
                        made[name].append(value)
                first += len(parts)
        return made

    ddl = "host string, text string, stream_a long, stream_b long, key_a long, key_b long, nth long"
    return parsed.where("article").select("host", *KEY, "blocks").mapInArrow(rows_kernel(look, schema), ddl)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    parsed = cut_lineage(_parsed(pages))
    stream, run = ["stream_a", "stream_b"], ["run_a", "run_b"]
    outside = F.transform(F.filter("blocks", lambda x: x["place"] != ARTICLE), lambda x: x["text"])
    # a stream given by several pages of a host counts once
    streams = cut_lineage(
        parsed.select("host", *stream, "open", F.array_join(outside, " ").alias("text"))
        .groupBy("host", *stream)
        .agg(F.max("open").alias("open"), F.first("text").alias("text"))
    )
    repeated = cut_lineage(
        _runs(streams, False).groupBy(*run).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= PAGES).select(*run)
    )
    starts = (
        _runs(streams.where("open"), True)
        .join(repeated, run, "left_semi")
        .groupBy(F.col("stream_a").alias("key_a"), F.col("stream_b").alias("key_b"))
        .agg(F.collect_list("place").alias("at"))
    )
    maybe = cut_lineage(_maybe_repeated(parsed, repeated))
    common = (
        maybe.groupBy(*stream)
        .agg(F.count_distinct(*KEY).alias("articles"), F.first("host").alias("host"), F.first("text").alias("text"))
        .where(F.col("articles") >= PAGES)
    )
    common = cut_lineage(common.withColumn("n", F.size(F.split("text", " ")) - (RUN - 1)))
    # the bitmap may take a run for a repeated one
    notices = (
        _runs(common, True)
        .join(repeated, run, "left_semi")
        .groupBy(*stream)
        .agg(F.count(F.lit(1)).alias("found"))
        .join(common, stream)
        .where(F.col("found") == F.col("n"))
        .select(*stream)
    )
    gone = maybe.join(notices, stream, "left_semi").groupBy(*KEY).agg(F.collect_set("nth").alias("at"))
    judged = cut_lineage(starts.unionByName(gone))
    result = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def judge(batch):
        texts = []
        for found, at in zip(column(batch, "blocks"), column(batch, "at"), strict=True):
            inside = [x["text"] for x in found if x["place"] == ARTICLE]
            texts.append(article_text(inside, at or []) if inside else open_text([(x["place"], x["text"]) for x in found], at or []))
        return {"page_id": column(batch, "page_id"), "url": column(batch, "url"), "text": texts}

    texts = (
        parsed.join(judged, KEY, "left")
        .select("page_id", "url", "blocks", "at")
        .mapInArrow(rows_kernel(judge, result), "page_id long, url string, text string")
    )
    return texts.withColumn("n_chars", F.length("text").cast("long"))
