"""Licence scans: Aho-Corasick over words and tags, and a shunting-yard parser for licence expressions.

A document becomes its words joined by single spaces. One automaton finds the notice phrases in it, whatever stood
between the words; a second one finds identifier tags in the raw text. What follows a tag, to the end of the line, is a
licence expression (and, or, with, parentheses): it is put in postfix order with two stacks and evaluated against a
licence policy. Scanning is per document, in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import batch_udf, col, plain_words, raw

#: Fixed values of the contract: phrase, label.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notice phrases of this method.
NOTICES = {
    "gnu general public license": "gpl", "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl", "mozilla public license": "mpl", "bsd 3 clause license": "bsd-3-clause",
    "bsd 2 clause license": "bsd-2-clause", "creative commons attribution noncommercial": "cc-by-nc",
    "isc license": "isc", "released into the public domain": "public-domain", "all rights reserved": "proprietary",
    "permission is hereby granted free of charge": "mit", "licensed under the apache license": "apache-2",
    "redistribution and use in source and binary forms": "bsd", "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa", "eclipse public license": "epl", "boost software license": "bsl-1", "gnu gpl": "gpl",
    "gnu lgpl": "lgpl", "the unlicense": "unlicense", "zlib license": "zlib", "under the bsd license": "bsd",
}
TAGS = ("spdx-license-identifier:",)
#: Identifier prefixes and their labels, the longest that fits wins.
FAMILIES = {"mit": "mit", "apache-2": "apache-2", "cc-by-nc": "cc-by-nc", "agpl": "agpl", "lgpl": "lgpl", "gpl": "gpl",
            "mpl": "mpl", "bsd-2-clause": "bsd-2-clause", "bsd-3-clause": "bsd-3-clause", "isc": "isc"}
PERMISSIVE = frozenset({"mit", "apache-2", "bsd-2-clause", "bsd-3-clause", "isc", "public-domain"})
RANK = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_BLANK = re.compile(r"[ \t]*")
_ENDS = re.compile(r"(?!\w)|(?=v?[0-9])")


@dataclass(frozen=True)
class Expression:
    """What a licence expression says: its labels, and whether the policy's licences satisfy it."""

    labels: frozenset[str]
    allowed: bool


def label(identifier: str) -> str:
    """The label of an identifier: its family's, if the family's name ends where the identifier does or before anything but
    a letter (``gpl-3.0``, ``gplv3``; not ``mittens`` or ``iscsi``); else the identifier in lower case."""
    name = identifier.lower()
    fit = max((p for p in FAMILIES if name.startswith(p) and _ENDS.match(name, len(p))), key=len, default=None)
    return FAMILIES[fit] if fit else name


def postfix(text: str) -> list[str] | None:
    """The expression at the start of ``text`` in postfix order; None if it has none or is broken."""
    parsed = parse(text)
    return None if parsed is None else parsed[0]


def parse(text: str, at: int = 0) -> tuple[list[str], int] | None:
    """The expression at place ``at`` of ``text`` in postfix order by two stacks, and where it ends; None if there is none
    or it is broken.

    Two identifiers in a row end it, and so do a closing parenthesis too many and any other character."""
    output: list[str] = []
    waiting: list[str] = []
    operand = False  # whether the last token was one
    end = at
    while m := _TOKEN.match(text, at):
        token, word = m[0], m[0].lower()
        if word in RANK:
            if not operand:
                return None
            while waiting and RANK.get(waiting[-1], 0) >= RANK[word]:
                output.append(waiting.pop())
            waiting.append(word)
            operand = False
        elif token == "(":
            if operand:
                break
            waiting.append(token)
        elif token == ")":
            if "(" not in waiting:
                break
            if not operand:
                return None
            while waiting[-1] != "(":
                output.append(waiting.pop())
            waiting.pop()
        else:
            if operand:
                break
            output.append(token)
            operand = True
        at = end = m.end()
        while at < len(text) and text[at] in " \t":
            at += 1
    if not operand or "(" in waiting:
        return None
    return output + waiting[::-1], end


def evaluate(text: str, policy: frozenset[str] = PERMISSIVE) -> Expression | None:
    """``or`` needs one side, ``and`` both; ``with`` keeps the licence's verdict and adds no label of its own."""
    order = postfix(text)
    return None if order is None else verdict(order, policy)


def verdict(order: list[str], policy: frozenset[str] = PERMISSIVE) -> Expression:
    """What an expression in postfix order says."""
    stack: list[Expression] = []
    for token in order:
        if token in RANK:
            b, a = stack.pop(), stack.pop()
            if token == "with":
                stack.append(a)
            else:
                stack.append(Expression(a.labels | b.labels, (a.allowed or b.allowed) if token == "or"
                                        else (a.allowed and b.allowed)))
        else:
            name = label(token)
            stack.append(Expression(frozenset([name]), name in policy))
    return stack[0]


@lru_cache
def automata():
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for text, name in {**NOTICES, **BASE}.items():
        phrases.add_word(f" {text} ", (len(text) + 2, text, name))
    for tag in TAGS:
        tags.add_word(tag, tag)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


_ASCII_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def scan_text(text: bytes | None, policy: frozenset[str] = PERMISSIVE) -> dict:
    """n_words, base places (word, label), notices (word, label), expressions (text, labels, allowed)."""
    words = plain_words(text)
    base, notices, expressions = [], [], []
    if not words:
        return {"n_words": 0, "base": base, "notices": notices, "expressions": expressions}
    phrases, tags = automata()
    line = " " + b" ".join(words).decode() + " "
    at = count = 0
    hits = sorted((end - size + 1, phrase, name) for end, (size, phrase, name) in phrases.iter(line))
    for start, phrase, name in hits:
        count += line.count(" ", at, start)
        at = start
        (base if phrase in BASE else notices).append({"word": count, "label": name})
    low = text.translate(_ASCII_LOWER)
    if any(t.encode() in low for t in TAGS):  # cheap; the automaton says where
        shown = text.decode()
        for end, _ in tags.iter(low.decode()):  # A-Z only are lowered, so places agree
            start = _BLANK.match(shown, end + 1).end()  # an expression has no line feed: it is read in place
            if (parsed := parse(shown, start)) is not None:
                e = verdict(parsed[0], policy)
                expressions.append({"text": shown[start:parsed[1]], "labels": sorted(e.labels), "allowed": e.allowed})
    return {"n_words": len(words), "base": base, "notices": notices, "expressions": expressions}


_PLACE = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
_TYPE = pa.struct([("n_words", pa.int64()), ("base", _PLACE), ("notices", _PLACE),
                   ("expressions", pa.list_(pa.struct([("text", pa.string()), ("labels", pa.list_(pa.string())),
                                                       ("allowed", pa.bool_())])))])
SCAN = ("n_words long, base array<struct<word: long, label: string>>, notices array<struct<word: long, label: string>>, "
        "expressions array<struct<text: string, labels: array<string>, allowed: boolean>>")


def scan(docs: DataFrame, out: str = "licences", policy: frozenset[str] = PERMISSIVE) -> DataFrame:
    """``docs`` with a struct column ``out`` as of ``scan_text``. A null text counts as empty: no words, no labels.
    A tag without a sound expression adds nothing. Repeated rows are scanned alike, an empty table gives none, and a text's
    length or number of tags costs in proportion."""

    def make():
        return lambda batch: pa.array([scan_text(t, policy) for t in raw(batch)], _TYPE)

    return docs.withColumn(out, batch_udf(make, SCAN)(col("text")))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and allowed (null without a tag).

    score: 1 with an identifier tag, else 0.9 with a base phrase, else 0.6 with another notice, else 0."""
    got = scan(docs.select("doc_id", "text"))
    x = F.col("licences")
    base, notices = F.col("licences.base"), F.col("licences.notices")
    tagged = F.flatten(F.transform(x["expressions"], lambda e: e["labels"]))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    words = F.transform(base, lambda p: p["word"])
    of = lambda places: F.transform(places, lambda p: p["label"])
    return got.select(
        "doc_id", x["n_words"].alias("n_words"), F.size(base).cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        joined(of(base)).alias("base_labels"), joined(F.concat(of(base), of(notices), tagged)).alias("labels"),
        F.when(F.size(tagged) > 0, 1.0).when(F.size(base) > 0, 0.9).when(F.size(notices) > 0, 0.6).otherwise(0.0)
        .alias("score"),
        F.when(F.size(x["expressions"]) > 0, F.forall(x["expressions"], lambda e: e["allowed"])).alias("allowed"))
