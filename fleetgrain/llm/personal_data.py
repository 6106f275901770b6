"""Personal data in texts, plain and disguised, with places in the original text.

Plain identifiers (email, ip, card, phone) are found in the text itself. Then a
chain of transducers rewrites disguises: look-alike and full-width characters
and foreign digits to ASCII, invisible characters to nothing, spelled digits to
digits, and `(at)`, `[dot]`, ` at ... dot ... ` to signs; words may stand
between any white space, lines too, and a domain may mix plain, spelled and
bracketed dots. Each rewritten character remembers the source characters it stands for, the same detectors run
over the result, and what they find goes back to the source. A disguised find
that lies inside a plain one of its kind is the same find and is not added.

Most texts hold no hint of a disguise and are not rewritten.

Defined cases: null and empty texts have no finds; a text of any length is read
whole, in time in proportion to it; a null doc_id is returned as null; repeated
rows give a row each; a text without finds has the digest of the empty string
and empty spans; an empty table gives no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_right
from operator import itemgetter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrain.llm.common import column, rows_kernel

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a digit before the start could only repeat a failed try, so runs are tried once
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> list[Span]:
    """Leftmost matches: each @ with the local characters before it and a domain behind it."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def detect(text: str) -> dict[str, list[Span]]:
    found = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            found["ip"].append(m.span())
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = re.sub("[ -]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
                found["phone"].append(m.span())
    return found


# Letters that look like ASCII ones, and signs written otherwise.
_LOOK_ALIKES = dict(
    zip(
        "асеорхуіѕјһԁԛԝАВЕКМНОРСТХУІЅЈαοερνιΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aceopxyisjhdqwABEKMHOPCTXYISJaoepviABEZHIKMNOPTYX",
        strict=True,
    )
) | {"。": ".", "․": ".", "‧": ".", "·": ".", "﹫": "@", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", chr(0xA0): " "}
# soft hyphen, zero-width space and joiners, word joiner, byte-order mark
_INVISIBLE = "".join(map(chr, (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)))
# Digits in words.
_SPELLED = {
    word: str(value)
    for words in (
        "zero one two three four five six seven eight nine",
        "oh",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for value, word in enumerate(words.split())
}
_TIMES = {"double": 2, "triple": 3}

# digits of other scripts, from the character database
_FOREIGN_DIGITS = "".join(c for c in map(chr, range(128, 0x1FC00)) if unicodedata.decimal(c, None) is not None)
_STRANGE_SET = f"{_INVISIBLE}{''.join(map(re.escape, _LOOK_ALIKES))}！-～{_FOREIGN_DIGITS}"
_STRANGE = re.compile(f"[{_STRANGE_SET}]")
_DIGIT_WORD = f"(?:(?:{'|'.join(_TIMES)})[ ])?(?:{'|'.join(sorted(_SPELLED, key=len, reverse=True))})"
_DIGIT_RUN = re.compile(
    rf"(?<!\w)(?:plus[ ,]+)?{_DIGIT_WORD}(?:[ ,\n-]{{1,2}}(?:{_DIGIT_WORD}|[0-9]|dot(?=[ ,]))(?!\w)){{3,}}", re.IGNORECASE
)
_WHITE = f"[{''.join(c for c in map(chr, range(sys.maxunicode)) if c.isspace())}]"
# white space is taken from where it starts only, so a long run is walked once
_OPEN, _CLOSE = rf"(?:(?<!{_WHITE}){_WHITE}+)?[\[({{<]{_WHITE}*", rf"{_WHITE}*[\])}}>]{_WHITE}*"
_DOT_WORD = "(?:dot|punkt|punto|point)"
_LABEL = "[A-Za-z0-9-]++"
_SIGNS = [
    (re.compile(rf"{_OPEN}(?:at|@|arroba){_CLOSE}", re.IGNORECASE), "@"),
    # before bracketed dots are read: a domain with plain dots up to one that is spelled or in brackets
    (
        re.compile(
            rf"(?<=[A-Za-z0-9]){_WHITE}+(?:at|arroba){_WHITE}+(?!(?:the|an?|this|that){_WHITE})"
            rf"(?={_LABEL}(?:\.{_LABEL})*+(?:{_WHITE}+{_DOT_WORD}{_WHITE}+|{_OPEN}(?:{_DOT_WORD}|\.){_CLOSE})[A-Za-z0-9-])",
            re.IGNORECASE,
        ),
        "@",
    ),
    (re.compile(rf"{_OPEN}(?:{_DOT_WORD}|\.){_CLOSE}", re.IGNORECASE), "."),
    (re.compile(r"(?<=[A-Za-z0-9])[ ]+@[ ]*(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])@[ ]+(?=[A-Za-z0-9])"), "@"),
]
# a spelled or parted dot counts around an @ only
_SPELLED_DOT = f"{_WHITE}++{_DOT_WORD}{_WHITE}++"
# every chain of words and spelled dots is taken whole, with or without an address behind it, so none is walked twice
_DOTTED = re.compile(
    rf"(?<![A-Za-z0-9])[A-Za-z0-9]++(?:{_SPELLED_DOT}[A-Za-z0-9]++)*+"
    rf"(?P<host>@[A-Za-z0-9-]++(?:(?:\.|{_SPELLED_DOT}|[ ]++\.[ ]++)[A-Za-z0-9-]++)++)?",
    re.IGNORECASE,
)
_DOT = re.compile(rf"{_SPELLED_DOT}|[ ]+\.[ ]+", re.IGNORECASE)
# for Arrow's linear-time matcher: every text that some rule above can change matches one of them
_HINTS = (
    f"[{_STRANGE_SET}]",
    rf"(?i){_DIGIT_WORD}(?:[ ,\n-]{{1,2}}(?:{_DIGIT_WORD}|[0-9]|dot)){{3}}",
    rf"(?i)[\[({{<]{_WHITE}*(?:at|@|arroba|{_DOT_WORD}|\.){_WHITE}*[\])}}>]|[ ]@|@[ ]|@[A-Za-z0-9.-]+(?:{_WHITE}+{_DOT_WORD}{_WHITE}|[ ]+\.[ ])",
    rf"(?i){_WHITE}(?:at|arroba){_WHITE}+[A-Za-z0-9.-]+{_WHITE}+{_DOT_WORD}{_WHITE}|{_WHITE}{_DOT_WORD}{_WHITE}+[A-Za-z0-9]+@",
)


def hinted(texts: pa.Array) -> list[bool]:
    """Which texts may hold a disguise."""
    found = pc.match_substring_regex(texts, _HINTS[0])
    for pattern in _HINTS[1:]:
        found = pc.or_(found, pc.match_substring_regex(texts, pattern))
    return found.to_pylist()


class Rewritten:
    """A text with the source place of each of its characters."""

    def __init__(self, text: str):
        self.text = text
        self.starts: list[int] = list(range(len(text)))
        self.ends: list[int] = list(range(1, len(text) + 1))

    def replace(self, pieces: list[tuple[int, int, str]]) -> None:
        """Put strings in place of ranges, in ascending order; each stands for the whole range."""
        text, starts, ends, at = [], [], [], 0
        for a, b, new in pieces:
            text += [self.text[at:a], new]
            starts += self.starts[at:a] + [self.starts[a]] * len(new)
            ends += self.ends[at:a] + [self.ends[b - 1]] * len(new)
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.starts = starts + self.starts[at:]
        self.ends = ends + self.ends[at:]

    def source(self, span: Span) -> Span:
        return self.starts[span[0]], self.ends[span[1] - 1]


def _plain_character(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    if c in _LOOK_ALIKES:
        return _LOOK_ALIKES[c]
    if "！" <= c <= "～":
        return chr(ord(c) - 0xFEE0)
    return str(unicodedata.digit(c, "")) or c


def _digits(run: str) -> str:
    out, times = [], 1
    for word in re.findall(r"\w+", run.lower()):
        if word in _TIMES:
            times = _TIMES[word]
            continue
        out.append("+" if word == "plus" else "." if word == "dot" else _SPELLED.get(word, word) * times)
        times = 1
    return "".join(out)


def rewrite(text: str) -> Rewritten:
    """The text without its disguises."""
    out = Rewritten(text)
    out.replace([(*m.span(), _plain_character(m[0])) for m in _STRANGE.finditer(out.text)])
    out.replace([(*m.span(), _digits(m[0])) for m in _DIGIT_RUN.finditer(out.text)])
    for pattern, sign in _SIGNS:
        out.replace([(*m.span(), sign) for m in pattern.finditer(out.text)])
    if "@" in out.text:
        chains = [m for m in _DOTTED.finditer(out.text) if m["host"]]
        out.replace([(m.start() + d.start(), m.start() + d.end(), ".") for m in chains for d in _DOT.finditer(m[0])])
    return out


def _inside(span: Span, plain: list[Span]) -> bool:
    """Whether one of the plain finds, which are in order and apart, holds a range."""
    at = bisect_right(plain, span[0], key=itemgetter(0))
    return at > 0 and span[1] <= plain[at - 1][1]


def find(text: str, hint: bool = True) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Plain finds, and all finds, by kind, as half-open ranges of code points."""
    base = detect(text)
    rewritten = rewrite(text) if hint else None
    if rewritten is None or rewritten.text == text:
        return base, base
    every = {}
    for kind, spans in detect(rewritten.text).items():
        new = {rewritten.source(s) for s in spans}
        new = {s for s in new if not _inside(s, base[kind])}
        every[kind] = sorted([*base[kind], *new])
    return base, every


def listed(found: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in found[kind])


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, plain finds by kind, digest of the plain spans, all spans, and how many disguised ones were added."""
    names = [c.split() for c in RESULT.split(", ")]
    schema = pa.schema([(n, pa.int64() if kind == "long" else pa.string()) for n, kind in names])

    def batch_columns(batch):
        made = {f.name: [] for f in schema}
        made["doc_id"] = column(batch, "doc_id")
        texts = pc.fill_null(batch.column(batch.schema.get_field_index("text")), "")
        for text, hint in zip(texts.to_pylist(), hinted(texts), strict=True):
            base, every = find(text, hint)
            for kind in KINDS:
                made[f"n_{kind}"].append(len(base[kind]))
            made["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
            made["spans"].append(listed(every))
            made["n_added"].append(sum(len(every[k]) - len(base[k]) for k in KINDS))
        return made

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(rows_kernel(batch_columns, schema), RESULT)
