"""Elements of HTML pages, by a tokenizer that keeps the stack of open elements, in Arrow batches.

``elements`` gives an array of the elements that match a rule: tag, attributes
and visible text.  A rule is a tag, an attribute and its value or one of its
words, and may ask for an element to lie within another.  Nested elements of
one tag are told apart; void tags, missing end tags, comments, attributes in any
order and quoting, entities, scripts and styles are handled as the parser of
Python's library does, which only makes tokens here.  A character reference is one that
is known and ends with its semicolon; any other ampersand is a plain one.

Defined cases: null pages give NULL, pages without a match an empty array; an end
tag without its start is ignored; elements that are still open at the end of
the page, or at the end of an element around them, end there; a paragraph or
list item ends where the next one begins; runs of the five white spaces of HTML
are one blank, other blanks (as no-break spaces) stay.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: elements without an end tag, and those that a like one ends
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ENDED_BY = {"p": {"p", "div", "ul", "ol", "table", "article", "section", "h1", "h2", "h3", "h4", "h5", "h6"}, "li": {"li"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
UNSEEN = {"script", "style", "template", "noscript"}
_REFERENCE = re.compile(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")
_WHITE = re.compile(r"[\t\n\f\r ]+")
SCHEMA = "array<struct<tag: string, attributes: map<string, string>, text: string, depth: int>>"


@dataclass(frozen=True)
class Rule:
    """What an element must be: all that is given must hold; ``value`` is the attribute's value or one of its words."""

    tag: str | None = None
    attribute: str | None = None
    value: str | None = None
    within: Rule | None = None

    def holds(self, tag: str, attributes: dict[str, str], around: Sequence[tuple[str, dict[str, str]]]) -> bool:
        if self.tag is not None and tag != self.tag:
            return False
        if self.attribute is not None:
            found = attributes.get(self.attribute)
            if found is None or self.value is not None and found != self.value and self.value not in found.split():
                return False
        return self.within is None or any(self.within.holds(*x, around[:i]) for i, x in enumerate(around))


class _Reader(HTMLParser):
    def __init__(self, rule: Rule):
        super().__init__(convert_charrefs=True)
        self.rule, self.open, self.found = rule, [], []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        ends = next((i for i in range(len(self.open) - 1, -1, -1) if tag in ENDED_BY.get(self.open[i][0], ())), None)
        # a like one further out is not ended by what lies in a list or table within it
        if ends is not None and not {x[0] for x in self.open[ends + 1 :]} & {"ul", "ol", "table", "dl", "div"}:
            del self.open[ends:]
        attributes = {}
        for name, value in attrs:
            attributes.setdefault(name, value or "")
        element = None
        if self.rule.holds(tag, attributes, [x[:2] for x in self.open]):
            element = {"tag": tag, "attributes": attributes, "text": [], "depth": len(self.open)}
            self.found.append(element)
        if tag not in VOID:
            self.open.append((tag, attributes, element))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        if any(x[0] in UNSEEN for x in self.open):
            return
        for _, _, element in self.open:
            if element is not None:
                element["text"].append(data)


def _plain_ampersands(page: str) -> str:
    """A page whose ampersands that begin no reference are written as references, so that the parser guesses none."""
    return _REFERENCE.sub(lambda m: m[0] if m[1] and (m[1][0] == "#" or m[1] in html5) else f"&amp;{m[1] or ''}", page)


def elements_of(page: str, rule: Rule) -> list[dict]:
    """The elements of one page that a rule holds for, in the order of their start."""
    reader = _Reader(rule)
    reader.feed(_plain_ampersands(page))
    reader.close()
    return [{**x, "text": _WHITE.sub(" ", "".join(x["text"])).strip(" ")} for x in reader.found]


def elements(html: Column, rule: Rule) -> Column:
    """An array of (tag, attributes, text, depth) of the elements that a rule holds for."""

    def each(pages: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else elements_of(p, rule) for p in pages], dtype=object)

    return F.pandas_udf(each, SCHEMA)(html)


def texts(html: Column, rule: Rule) -> Column:
    """The visible texts of the elements that a rule holds for."""
    return F.transform(elements(html, rule), lambda x: x["text"])


def attribute(html: Column, rule: Rule, name: str) -> Column:
    """An attribute of the elements that a rule holds for, where they have it."""
    return F.array_compact(F.transform(elements(html, rule), lambda x: F.try_element_at(x["attributes"], F.lit(name))))
