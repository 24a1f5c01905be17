"""HTML field extraction (H22) and the unreadable-payload gate (F20), as column expressions.

The original walks a parsed DOM with an ordered list of selectors and takes
the first that yields non-empty text.  Over a table of pages the same
contract is an ordered ``coalesce``: of regex extractions for fields of a whole
page (``first_text``), and of elements for cards (``select_text``): the page is
split into tags and texts, and an element reaches from its tag to the closing tag
at the same depth, whatever is nested in it and however its attributes are ordered. Elements are
found in Arrow batches, by a walk over the page's tags.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .text import WS

# Ordered fallbacks (first non-empty wins).
TITLE_PATTERNS = [r"(?s)<title[^>]*>(.*?)</title>", r"(?s)<h1[^>]*>(.*?)</h1>"]
BODY_PATTERNS = [r"(?s)<article[^>]*>.*?<p[^>]*>(.*?)</p>", r"(?s)<p[^>]*>(.*?)</p>"]
LANG_PATTERN = r"<html[^>]*\slang=\"([^\"]*)\""
# Entities decoded after tag stripping; '&amp;' last so it is not decoded twice.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


NUMBER = r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def decode_entities(s: Column) -> Column:
    """Named entities of the list, and all by number (decimal or hexadecimal); ``&amp;`` last."""
    def by_number(acc: Column, ent: Column) -> Column:
        digits = F.regexp_extract(ent, r"&#[xX]?([0-9a-fA-F]+);", 1)
        code = F.when(ent.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long")
        fine = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(fine, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.replace(acc, ent, char)

    numbers = F.array_distinct(F.regexp_extract_all(s, F.lit(NUMBER), F.lit(0)))
    out = F.when(F.contains(s, F.lit("&#")), F.aggregate(numbers, s, by_number)).otherwise(s)
    for ent, rep in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(rep))
    return out


def strip_tags(x) -> Column:
    s = F.regexp_replace(_c(x), r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(decode_entities(s), WS, " "))


def first_text(html, patterns: Sequence[str]) -> Column:
    """Text of the first pattern that yields non-empty text, else ''."""
    parts = [F.nullif(strip_tags(F.regexp_extract(_c(html), p, 1)), F.lit("")) for p in patterns]
    return F.coalesce(*parts, F.lit(""))


# --------------------------------------------------------------------------- elements

TOKEN = r"(?s)<!--.*?-->|<(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>|<|[^<]+"
OPENING, CLOSING = r"^<([a-zA-Z][^\s/>]*)", r"^</([a-zA-Z][^\s/>]*)"
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


@dataclass(frozen=True)
class Selector:
    """An element by tag name, by a part of its class, or by an attribute that it has; ``value`` is the attribute whose
    value is wanted instead of the element's text."""

    tag: str | None = None
    cls: str | None = None
    attr: str | None = None
    value: str | None = None


# Fields of a listing card: ordered fallbacks.
CARD_FIELDS = {
    "precio": [Selector(attr="data-price", value="data-price"), Selector(cls="price")],
    "expensas": [Selector(cls="expenses")],
    "direccion": [Selector(cls="address"), Selector(tag="h2")],
    "detalles": [Selector(cls="features")],
}


def _attribute(name: str) -> str:
    return rf"(?is)^<[^\s>]+(?:\"[^\"]*\"|'[^']*'|[^\"'])*?\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"


def attribute(tag: Column, name: str) -> Column:
    """An attribute of a tag wherever it stands, quoted or not; NULL if the tag hasn't any."""
    found = F.regexp_extract(tag, _attribute(name), 1)
    return F.when(found != "", F.regexp_replace(found, r"^[\"']|[\"']$", ""))


_OPENING, _CLOSING, _TOKEN, _NUMBER = (re.compile(x, re.ASCII) for x in (OPENING, CLOSING, TOKEN, NUMBER))


@cache
def _attribute_pattern(name: str) -> re.Pattern:
    return re.compile(_attribute(name), re.ASCII)


@lru_cache(8192)
def _value(tag: str, name: str) -> str | None:
    """``attribute`` of one tag."""
    found = _attribute_pattern(name).search(tag)
    return re.sub(r"^[\"']|[\"']$", "", found[1]) if found else None


@lru_cache(8192)
def _tag(token: str) -> tuple[str, str]:
    """The names that a token opens and closes, '' for none. Most tags of a page come again and again."""
    opens, closes = _OPENING.match(token), _CLOSING.match(token)
    return opens[1].lower() if opens else "", closes[1].lower() if closes else ""


def _tags(toks: list[str]) -> list[tuple[int, str, str]]:
    """Place, opened and closed name of each token that is a tag."""
    return [(i, *_tag(t)) for i, t in enumerate(toks) if t[:1] == "<"]


def matches(token: str, name: str, s: Selector) -> bool:
    """Whether an opening tag (and its name) is what the selector names."""
    return (name != "" and (not s.tag or name == s.tag)
            and (not s.cls or (s.cls in token and s.cls in (_value(token, "class") or "")))
            and (not s.attr or (s.attr in token and _value(token, s.attr) is not None)))


def _end(toks: list[str], tags: list[tuple[int, str, str]], k: int) -> int:
    """Where the element that the tag ``k`` opens ends: after the closing tag at the same depth of its name, or at the end
    where that is missing; a void or self-closed element is its tag alone."""
    at, name, _ = tags[k]
    if name in VOID or toks[at].endswith("/>"):
        return at + 1
    depth = 0
    for i, opens, closes in tags[k:]:
        if opens == name:
            depth += not toks[i].endswith("/>")
        elif closes == name:
            depth -= 1
            if depth <= 0:
                return i + 1
    return len(toks)


def _elements(toks: list[str], s: Selector) -> list[list[str]]:
    found, upto, tags = [], 0, _tags(toks)
    for k, (i, name, _) in enumerate(tags):
        if i >= upto and matches(toks[i], name, s):
            upto = _end(toks, tags, k)
            found.append(toks[i:upto])
    return found


def _text(raw: str | None) -> str:
    """``decode_entities`` of one text, white space collapsed; '' for none."""
    if not raw:
        return ""
    if "&" in raw:
        for ent in dict.fromkeys(_NUMBER.findall(raw)):
            code = int(ent[3:-1], 16) if ent[2] in "xX" else int(ent[2:-1])
            fine = 0 < code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF
            raw = raw.replace(ent, chr(code if fine else 0xFFFD))
        for ent, rep in ENTITIES:
            raw = raw.replace(ent, rep)
    return " ".join(raw.split())


def _first(toks: list[str], tags: list[tuple[int, str, str]], s: Selector) -> str:
    """The text (pieces parted by spaces) or the attribute of the first element that matches."""
    part = s.cls or s.attr or ""
    for k, (i, name, _) in enumerate(tags):
        if part in toks[i] and matches(toks[i], name, s):
            if s.value:
                return _text(_value(toks[i], s.value))
            return _text(" ".join([t for t in toks[i:_end(toks, tags, k)] if t[:1] != "<" or t == "<"]))
    return ""


def elements(html, s: Selector) -> Column:
    """The token arrays of all elements of a page that match, outermost ones only."""
    @F.arrow_udf("array<array<string>>")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([None if x is None else _elements(_TOKEN.findall(x), s) for x in pages.to_pylist()],
                        pa.list_(pa.list_(pa.string())))
    return run(_c(html))


def _texts(toks, fields: Sequence[Sequence[Selector]]) -> Column:
    """For each field the first text of its selectors that isn't empty, else ''; a card is gone through once."""
    @F.arrow_udf("array<string>")
    def run(cards: pa.Array) -> pa.Array:
        every, at, out = cards.values.to_numpy(zero_copy_only=False).tolist(), cards.offsets.to_pylist(), []
        for lo, hi in zip(at, at[1:]):  # a missing card is an empty one
            x = every[lo:hi]
            tags = _tags(x)
            out.append([next((got for s in own if (got := _first(x, tags, s))), "") for own in fields])
        return pa.array(out, pa.list_(pa.string()))
    return run(_c(toks))


def select_text(toks, selectors: Sequence[Selector]) -> Column:
    """H22 by element: the first selector whose first element has a text (or attribute) that isn't empty, else ''."""
    return _texts(toks, [selectors])[0]


def cards(html) -> Column:
    """The tokens of each listing card of a page."""
    return elements(html, Selector(tag="article"))


def card_fields(card) -> dict[str, Column]:
    """One text per field of a card's tokens ('' where no selector yields any)."""
    texts = _texts(card, list(CARD_FIELDS.values()))
    return {name: texts[i] for i, name in enumerate(CARD_FIELDS)}


def count_tag(html, tag: str) -> Column:
    low = F.lower(_c(html))
    marker = f"<{tag} "
    return ((F.length(low) - F.length(F.replace(low, F.lit(marker), F.lit("")))) / len(marker)).cast("long")


def looks_binary(data, sample: int = K.BINARY_SAMPLE_BYTES, share: float = K.BINARY_SHARE) -> Column:
    """share of bytes outside 9-13 and 32-126 among the first ``sample`` bytes > ``share``."""
    head = F.decode(F.substring(_c(data), 1, sample), "ISO-8859-1")
    n = F.length(head)
    bad = n - F.length(F.regexp_replace(head, r"[^\x09-\x0d\x20-\x7e]", ""))
    return F.when(n > 0, (bad / n) > F.lit(share)).otherwise(F.lit(False))
