"""Licences of texts: notice phrases and identifier tags by Aho-Corasick, tagged expressions by a shunting-yard parser.

Phrases are sought among a text's words (lower-cased A-Z, digits and characters beyond ASCII), so that punctuation, case and
line breaks between their words do not matter. Tags such as ``SPDX-License-Identifier:`` are sought in the lower-cased text
itself, as the expression behind them has a syntax of its own: identifiers joined by AND, OR, WITH and parentheses.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import ALNUM, cut, lower_ascii, pieces, text_bytes

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases, as the public licence texts word them, and their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "boost software license": "bsl",
    "isc license": "isc",
    "bsd 2 clause license": "bsd",
    "bsd 3 clause license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "all rights reserved": "proprietary",
}
# Texts before which an expression or identifier stands.
TAGS = ("spdx-license-identifier:", "license-expression:", "spdx-licence-identifier:")
# Identifier families and what they ask of users: 0 nothing to 3 sharing all, 4 use not granted.
FAMILIES = {
    "0bsd": ("0bsd", 0),
    "agpl": ("agpl", 3),
    "apache": ("apache", 0),
    "bsd": ("bsd", 0),
    "bsl": ("bsl", 0),
    "cc-by": ("cc-by", 1),
    "cc-by-nc": ("cc-by-nc", 4),
    "cc-by-nd": ("cc-by-nd", 4),
    "cc-by-sa": ("cc-by-sa", 2),
    "cc0": ("cc0", 0),
    "epl": ("epl", 2),
    "eupl": ("eupl", 3),
    "gpl": ("gpl", 3),
    "isc": ("isc", 0),
    "lgpl": ("lgpl", 2),
    "mit": ("mit", 0),
    "mpl": ("mpl", 2),
    "proprietary": ("proprietary", 4),
    "unlicense": ("unlicense", 0),
    "zlib": ("zlib", 0),
}
UNKNOWN = 4
_STRENGTH = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[^\s()]+")
_IDENTIFIER = re.compile(r"[a-z0-9][a-z0-9.+:-]*\Z")


class ExpressionError(ValueError):
    """What stands behind a tag is no licence expression."""


def family(identifier: str) -> tuple[str, int]:
    """Label and duties of an identifier: its longest known beginning, cut at a hyphen or digit; else itself."""
    name = identifier.rstrip("+").removesuffix("-only").removesuffix("-or-later")
    while name:
        if name in FAMILIES:
            return FAMILIES[name]
        name = name.rpartition("-")[0]
    return identifier, UNKNOWN


def postfix(expression: str) -> list[str]:
    """The expression in postfix order (shunting-yard): WITH binds before AND, AND before OR; equal ones from the left."""
    out: list[str] = []
    waiting: list[str] = []
    operand = False  # an operand has just ended
    for token in _TOKEN.findall(expression):
        if token == "(":
            if operand:
                raise ExpressionError(expression)
            waiting.append(token)
        elif token == ")":
            if not operand:
                raise ExpressionError(expression)
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                raise ExpressionError(expression)
            waiting.pop()
        elif token in _STRENGTH:
            if not operand:
                raise ExpressionError(expression)
            while waiting and _STRENGTH.get(waiting[-1], 0) >= _STRENGTH[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = False
        else:
            if operand or not _IDENTIFIER.match(token):
                raise ExpressionError(expression)
            out.append(token)
            operand = True
    if not operand or "(" in waiting:
        raise ExpressionError(expression)
    return out + waiting[::-1]


def evaluate(expression: str) -> tuple[frozenset[str], int]:
    """Labels and duties of an expression: of OR the side that asks for less counts, of AND the one that asks for more.

    WITH keeps the licence's label, and an exception lets its duties fall by one where they are to share (2 or 3).
    """
    stack: list[tuple[frozenset[str], int]] = []
    for token in postfix(expression):
        if token in _STRENGTH:
            (right, more), (left, duty) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left, duty - 1 if duty in (2, 3) else duty))
            else:
                stack.append((left | right, min(duty, more) if token == "or" else max(duty, more)))
        elif token.endswith("-exception") or "-exception-" in token:
            stack.append((frozenset(), UNKNOWN))
        else:
            label, duty = family(token)
            stack.append((frozenset([label]), duty))
    return stack[0]


def tagged_expression(line: str) -> str | None:
    """The longest beginning of what stands behind a tag that is an expression; comment ends and prose after it are left."""
    tokens: list[str] = []
    depth, operand, whole = 0, False, 0
    for match in _TOKEN.finditer(line):
        token = match[0]
        ends = token.rstrip(".,;")
        if token == "(" and not operand:
            depth += 1
        elif token == ")" and operand and depth:
            depth -= 1
        elif token in _STRENGTH and operand:
            operand = False
        elif not operand and token not in _STRENGTH and _IDENTIFIER.match(ends):
            operand = True
        else:
            break
        tokens.append(ends if operand and token != ")" else token)
        if operand and not depth:
            whole = len(tokens)
        if ends != token:  # a full stop or comma ends the expression
            break
    return " ".join(tokens[:whole]) or None


def _automaton(words: Mapping[str, object]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for word, value in words.items():
        machine.add_word(word, (len(word), value))
    machine.make_automaton()
    return machine


RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "labels array<string>, places array<struct<word:long,phrase:string>>, expressions array<string>, duties int"
)


def scan_licences(
    docs: DataFrame, base: Mapping[str, str] = BASE, notices: Mapping[str, str] = NOTICES, tags: tuple[str, ...] = TAGS
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``; null is empty, other columns are not read), as in ``RESULT``.

    ``places``: each place of a base phrase; ``expressions``: the tagged ones; ``duties``: the greatest of all that was found,
    0 nothing to 3 sharing all, 4 not granted or unknown, null if nothing was found. One scan, no shuffle; matches that
    overlap are all found, and none crosses from one document to the next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = _automaton({f" {p} ": (p, label, p in base) for p, label in [*notices.items(), *base.items()]})
        tag_finder = _automaton({t: t for t in tags})
        for batch in pieces(batches):
            yield _scan(batch, phrases, tag_finder)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def _scan(batch: pa.RecordBatch, phrases, tag_finder) -> pa.RecordBatch:
    raw, offsets = text_bytes(batch.column("text"))
    data = lower_ascii(raw)
    words = cut(data, offsets, ALNUM)
    n = batch.num_rows
    places: list[list[tuple[int, str]]] = [[] for _ in range(n)]
    base_labels: list[set[str]] = [set() for _ in range(n)]
    labels: list[set[str]] = [set() for _ in range(n)]
    found: list[list[str]] = [[] for _ in range(n)]
    duties: list[int | None] = [None] * n

    def add(doc: int, label: set[str] | frozenset[str], duty: int) -> None:
        labels[doc] |= label
        duties[doc] = max(duty, duties[doc] or 0)

    # All words, one blank between two; a line end parts documents, so that no phrase crosses it. Latin-1 keeps bytes apart.
    lengths = words.ends - words.starts
    doc = words.doc
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    size = lengths + 1 + 2 * new  # a document begins with a line end and a blank
    ends = np.cumsum(size)
    line = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    starts = ends - 1 - lengths
    index = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    source = np.repeat(words.starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    line[index] = data[source]
    line[(starts - 2)[new]] = 0x0A
    place = words.place
    for end, (length, (phrase, label, is_base)) in phrases.iter(line.tobytes().decode("latin-1")):
        w = int(np.searchsorted(starts, end - length + 2, "left"))
        d = int(doc[w])
        add(d, {label}, FAMILIES.get(label, ("", UNKNOWN))[1])
        if is_base:
            places[d].append((int(place[w]), phrase))
            base_labels[d].add(label)
    text = data.tobytes().decode("latin-1")
    for end, _ in tag_finder.iter(text):
        d = int(np.searchsorted(offsets, end, "right")) - 1
        stop = text.find("\n", end + 1, int(offsets[d + 1]))
        rest = text[end + 1 : stop if stop >= 0 else int(offsets[d + 1])]
        expression = tagged_expression(rest)
        if expression:
            own, duty = evaluate(expression)
            add(d, own, duty)
            found[d].append(expression)
    firsts = [min(p)[0] if p else None for p in places]
    lasts = [max(p)[0] if p else None for p in places]
    return pa.record_batch(
        {
            "doc_id": batch.column("doc_id"),
            "n_words": pa.array(words.counts, pa.int64()),
            "n_base": pa.array([len(p) for p in places], pa.int64()),
            "first_word": pa.array(firsts, pa.int64()),
            "last_word": pa.array(lasts, pa.int64()),
            "base_labels": pa.array([sorted(x) for x in base_labels], pa.list_(pa.string())),
            "labels": pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
            "places": pa.array(
                [[{"word": w, "phrase": p} for w, p in sorted(x)] for x in places],
                pa.list_(pa.struct([("word", pa.int64()), ("phrase", pa.string())])),
            ),
            "expressions": pa.array(found, pa.list_(pa.string())),
            "duties": pa.array(duties, pa.int32()),
        }
    )


def licence_digest(docs: DataFrame) -> DataFrame:
    """Counts, labels as text, and a score: 0 where nothing was found, else how free the text is to use, 0.2 to 1."""
    found = scan_licences(docs)
    score = F.when(F.col("duties").isNull(), 0.0).otherwise(1 - F.col("duties") / 5)
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        score.cast("double").alias("score"),
        F.array_join("expressions", "; ").alias("expressions"),
    )
