"""Personal data by anchors: Aho-Corasick finds cues, small parsers expand and validate around them.

One automaton scans a text for at-signs, plus signs before digits, digits, URL schemes and
identifier words. Each anchor is handed to the parser of its kind, which extends it to the left
and right as far as the kind's alphabet goes and then checks it. Nothing else is looked at.
"""

from __future__ import annotations

import hashlib
import re
import string
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sightline.llm.text import map_texts, with_long_id

#: fixed values: kinds in the order in which spans of one start are listed
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url_login", "iban", "account", "secret")

DIGITS = frozenset(string.digits)
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
LABEL = frozenset(string.ascii_letters + string.digits + "-")
DIALLED = frozenset(string.digits + " ().-")
ALNUM = frozenset(string.ascii_letters + string.digits)
TOKEN = frozenset(string.ascii_letters + string.digits + "_-./+=")

#: fixed values: words that announce an identifier, by the kind they announce
CUES = {
    "account": "account acct konto compte cuenta ssn passport",
    "iban": "iban",
    "secret": "password passwd pwd secret token api_key apikey akia",
}
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "postgres://", "mysql://", "redis://")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Anchors of all kinds. Words are entered in lower, upper and title case."""
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    for d in string.digits:
        found.add_word(d, ("digit", 1))
        found.add_word("+" + d, ("phone", 2))
    for scheme in SCHEMES:
        found.add_word(scheme, ("scheme", len(scheme)))
    for kind, listed in CUES.items():
        for word in listed.split():
            for form in {word, word.upper(), word.title()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def run_right(text: str, at: int, allowed: frozenset) -> int:
    while at < len(text) and text[at] in allowed:
        at += 1
    return at


def run_left(text: str, at: int, allowed: frozenset, least: int) -> int:
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def email(text: str, at: int, free: int) -> Span | None:
    """``at`` is the place of the at-sign; nothing before ``free`` may be used."""
    start = run_left(text, at, LOCAL, free)
    end = run_right(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    dots = 0
    while text[end : end + 1] == "." and (further := run_right(text, end + 1, LABEL)) > end + 1:
        end, dots = further, dots + 1
    return Span("email", start, end) if dots else None


def addresses(text: str, at: int) -> tuple[list[Span], int]:
    """Dotted quads of the chain of numbers that starts at ``at``, and where the chain ends."""
    ends = [run_right(text, at, DIGITS)]
    starts = [at]
    while text[ends[-1] : ends[-1] + 1] == "." and (further := run_right(text, ends[-1] + 1, DIGITS)) > ends[-1] + 1:
        starts.append(ends[-1] + 1)
        ends.append(further)
    spans = []
    for i in range(0, len(ends) - 3, 4):
        parts = [text[starts[k] : ends[k]].lstrip("0") for k in range(i, i + 4)]
        if all(len(x) < 4 and int(x or 0) <= 255 for x in parts):
            spans.append(Span("ip", starts[i], ends[i + 3]))
    return spans, ends[-1]


def card(text: str, at: int) -> tuple[Span | None, int]:
    """The longest run of digits with at most one blank or hyphen between two, and its end."""
    end = run_right(text, at, DIGITS)
    while text[end : end + 1] in (" ", "-") and text[end + 1 : end + 2] in DIGITS:
        end = run_right(text, end + 1, DIGITS)
    n = end - at
    if n < 14:
        return None, end
    digits = text[at:end].replace(" ", "").replace("-", "")
    return (Span("card", at, end) if 14 <= len(digits) <= 19 and luhn(digits) else None), end


def phone(text: str, at: int) -> tuple[Span | None, int]:
    """``at`` is the place of a plus sign before a digit; also where the search goes on."""
    end = run_right(text, at + 2, DIALLED)
    while end > at + 2 and text[end - 1] not in DIGITS:
        end -= 1
    if end < at + 4:  # a digit, one character at least, and a last digit
        return None, at + 1
    digits = sum(c in DIGITS for c in text[at:end])
    return (Span("phone", at, end) if 10 <= digits <= 15 else None), end


#: what ends the authority of a URL, besides the end of the text
AUTHORITY = re.compile(r"[^\s\"'<>/?#]*", re.ASCII)


def url_login(text: str, at: int) -> Span | None:
    """A URL that carries a user name and password; ``at`` is where its scheme ends."""
    authority = AUTHORITY.match(text, at)[0]
    user, sign, host = authority.rpartition("@")
    if not sign or ":" not in user or not host:
        return None
    return Span("url_login", run_left(text, at - 3, ALNUM, 0), at + len(authority))


def iban(text: str, at: int) -> Span | None:
    """An IBAN after its cue, by country code, length and check digits modulo 97."""
    start = at
    while start < len(text) and text[start] in " :=#.-\"'":
        start += 1
    taken, end = "", start
    for i in range(start, min(len(text), start + 45)):
        if text[i] in ALNUM:
            taken, end = taken + text[i].upper(), i + 1
        elif text[i] != " " or len(taken) >= 34:
            break
        if 15 <= len(taken) <= 34 and taken[:2].isalpha() and taken[2:4].isdigit():
            moved = taken[4:] + taken[:4]
            if int("".join(str(int(c, 36)) for c in moved)) % 97 == 1:
                return Span("iban", start, end)
    return None


def labelled(text: str, start: int, at: int, kind: str, seen: int) -> tuple[Span | None, int]:
    """A value after a cue word, an account number with digits or a secret of mixed signs, and how far
    values have been read.

    A secret whose value would begin before ``seen`` is the tail of one that was read: that one was
    taken, or it had no digit or was too short, and so is its tail.
    """
    if start and text[start - 1] in ALNUM or text[at : at + 1] in ALNUM and kind != "secret":
        return None, seen
    begin = at
    if kind == "secret" and text[start:at] == "AKIA":  # the cue is the head of the key
        end = at + run_right(text[at : start + 21], 0, ALNUM)  # one character more tells a longer run
        return (Span(kind, start, end) if end - start == 20 else None), seen
    if kind == "account":  # "account no. 123", "account number: 123"
        begin = run_right(text, begin, frozenset(" "))
        for word in ("number", "no.", "no", "nr.", "nr", "#"):
            if text[begin : begin + len(word)].lower() == word:
                begin += len(word)
                break
    signs = run_right(text, begin, frozenset(" :=\"'"))
    if kind == "secret" and not set(text[begin:signs]) & {":", "="}:
        return None, seen
    if kind == "secret" and signs < seen:
        return None, seen
    end = run_right(text, signs, TOKEN if kind == "secret" else DIGITS | {"-"})
    value = text[signs:end].rstrip(".-")
    digits = sum(c in DIGITS for c in value)
    if kind == "account" and not 6 <= digits <= 17 or kind == "secret" and (len(value) < 8 or not digits):
        return None, max(seen, end) if kind == "secret" else seen
    return Span(kind, signs, signs + len(value)), max(seen, end) if kind == "secret" else seen


def spans_of(text: str | None) -> list[Span]:
    """All spans of a text, by start and then kind. Spans of one kind do not overlap.

    A null or empty text has none. Positions count code points; the end is exclusive. The time grows
    with the length of the text, also without any white space.
    """
    out: list[Span] = []
    free = dict.fromkeys(("email", "ip", "card", "phone", *KINDS), 0)
    read = 0

    def take(span: Span | None) -> None:
        if span and span.start >= free[span.kind]:
            out.append(span)
            free[span.kind] = span.end

    for last, (anchor, size) in automaton().iter(text) if text else ():
        if anchor == "email":
            take(email(text, last, free["email"]))
        elif anchor == "digit":
            if last >= free["card"]:
                found, free["card"] = card(text, last)
                if found:
                    out.append(found)
            if last >= free["ip"]:
                quads, free["ip"] = addresses(text, last)
                out.extend(quads)
        elif anchor == "phone":
            start = last - 1
            if start >= free["phone"]:
                found, free["phone"] = phone(text, start)
                if found:
                    out.append(found)
        elif anchor == "scheme":
            take(url_login(text, last + 1))
        elif anchor == "iban":
            take(iban(text, last + 1))
        else:
            found, read = labelled(text, last + 1 - size, last + 1, anchor, read)
            take(found)
    order = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s.start, order[s.kind], s.end))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the union is replaced."""
    out, at = [], 0
    for span in spans:
        if span.end <= at:
            continue
        if span.start >= at:
            out += [text[at : span.start], f"<{span.kind}>"]
        at = span.end
    return "".join([*out, text[at:]])


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: an array of (kind, start, end) for every row; further columns are ignored.

    Null and empty texts give an empty array, repeated rows one array each, an empty table no rows.
    """

    def make(texts, kept):
        return kept["doc_id"], [[(s.kind, s.start, s.end) for s in spans_of(t)] for t in texts]

    return map_texts(with_long_id(docs), "text", ["doc_id"], make, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def digest(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans, and all spans as one string."""

    def make(texts, kept):
        counts: dict[str, list] = {kind: [] for kind in BASE_KINDS}
        hashes, listed = [], []
        for text in texts:
            spans = spans_of(text)
            name = [f"{s.kind}:{s.start}:{s.end}" for s in spans]
            for kind in BASE_KINDS:
                counts[kind].append(sum(s.kind == kind for s in spans))
            base = ",".join(n for n, s in zip(name, spans, strict=True) if s.kind in counts)
            hashes.append(hashlib.sha256(base.encode()).hexdigest())
            listed.append(",".join(name))
        return kept["doc_id"], *counts.values(), hashes, listed

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_texts(with_long_id(docs), "text", ["doc_id"], make, schema)


def scrubbed(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by ``<kind>``; a null text stays null. ``n_chars`` follows."""
    others = [c for c in docs.columns if c != "text"]

    def make(texts, kept):
        return *(kept[c] for c in others), [t and redacted(t, spans_of(t)) for t in texts]

    schema = StructType([docs.schema[c] for c in others]).add("text", "string")
    out = map_texts(docs, "text", others, make, schema).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
