"""License scan: one Aho-Corasick pass finds tags and notice phrases, a shunting-yard parser reads
the licence expressions that follow the tags.

The text is normalised to words and scanned once for all patterns. Phrases give labels; a tag such
as ``SPDX-License-Identifier:`` is mapped back to its place in the original text, where the rest of
the line is parsed as an expression of licence ids, ``and``, ``or``, ``with`` and parentheses, and
evaluated against the ids that a corpus may use. Documents are mapped where they lie: no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import BOOLEAN, DOUBLE, LONG, STRING, mapped
from .words import WORD, normalised, space_places, word_at, word_count

BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wordings of public licence notices, the label each stands for, and how sure it makes.
NOTICE_PHRASES = {
    "lesser general public license": ("lgpl", 0.8),
    "affero general public license": ("agpl", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "boost software license": ("bsl", 0.8),
    "isc license": ("isc", 0.7),
    "bsd license": ("bsd", 0.7),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "permission is hereby granted free of charge": ("mit", 0.8),
    "permission to use copy modify and or distribute this software": ("isc", 0.8),
    "this is free and unencumbered software released into the public domain": ("unlicense", 0.9),
    "creative commons attribution": ("cc-by", 0.7),
    "cc by sa": ("cc-by-sa", 0.7),
    "cc by nc": ("cc-by-nc", 0.7),
    "cc by nd": ("cc-by-nd", 0.7),
    "cc by": ("cc-by", 0.6),
    "cc0": ("cc0", 0.7),
    "all rights reserved": ("proprietary", 0.5),
}
TAG_PHRASES = ("spdx license identifier", "license expression")
PERMITTED = ("mit", "apache", "bsd", "isc", "bsl", "unlicense", "cc0", "cc-by")
FAMILIES = (
    ("agpl", "agpl"), ("lgpl", "lgpl"), ("gpl", "gpl"), ("apache", "apache"), ("mit", "mit"), ("bsd", "bsd"), ("0bsd", "bsd"), ("mpl", "mpl"), ("epl", "epl"), ("bsl", "bsl"), ("isc", "isc"), ("unlicense", "unlicense"),
    ("cc0", "cc0"), ("cc-by-nc", "cc-by-nc"), ("cc-by-sa", "cc-by-sa"), ("cc-by-nd", "cc-by-nd"), ("cc-by", "cc-by"),
)
BASE_WEIGHT, TAG_WEIGHT = 0.7, 0.95

TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+-]*|[()]")
AFTER_TAG = re.compile(r"[ \t\"']*[:=]")
PRECEDENCE = {"with": 3, "and": 2, "or": 1}

SCAN = T.StructType(
    [
        T.StructField("doc_id", LONG), T.StructField("n_words", LONG), T.StructField("n_base", LONG), T.StructField("first_word", LONG), T.StructField("last_word", LONG),
        T.StructField("base_labels", STRING), T.StructField("labels", STRING), T.StructField("score", DOUBLE), T.StructField("expressions", T.ArrayType(STRING)), T.StructField("permitted", BOOLEAN),
    ]
)


def family(identifier: str) -> str:
    """The label of a licence id: its family, or the lower-cased id itself."""
    low = identifier.lower()
    return next((label for start, label in FAMILIES if low == start or low.startswith(f"{start}-")), low)


def shunting_yard(tokens: Iterable[str]) -> list[str] | None:
    """Postfix form of the longest prefix of ``tokens`` that is an expression; None if none is.

    An operand must not follow an operand, so trailing prose ends the expression; no token after
    that is read. Time is linear: outside parentheses the stack holds one operator a precedence.
    """
    out, stack, operand, depth, best = [], [], True, 0, None
    for t in tokens:
        low = t.lower()
        if operand:
            if t == "(":
                stack.append(t)
                depth += 1
                continue
            if t == ")" or low in PRECEDENCE:
                break
            out.append(t)
            operand = False
        elif t == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
            depth -= 1
        elif low in PRECEDENCE:
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = True
            continue
        else:
            break
        if not depth:
            best = len(out), stack[::-1]
    return out[: best[0]] + best[1] if best else None


def evaluate(postfix: list[str], permitted: tuple[str, ...] = PERMITTED) -> bool:
    """Whether the expression can be met by permitted licences; an exception only loosens its licence."""
    stack: list[bool] = []
    for t in postfix:
        if t in PRECEDENCE:
            b, a = stack.pop(), stack.pop()
            stack.append(a and b if t == "and" else a or b if t == "or" else a)
        else:
            stack.append(family(t) in permitted)
    return stack[0]


def licences_in(postfix: list[str]) -> list[str]:
    """Labels of the operands without the exceptions after ``with``."""
    found, starts = [], []  # labels, and where those of each operand on the stack start
    for t in postfix:
        if t in PRECEDENCE:
            start = starts.pop()
            if t == "with":
                del found[start:]
        else:
            starts.append(len(found))
            found.append(family(t))
    return found


def build_automaton():
    import ahocorasick

    kinds: dict[str, list[tuple]] = {}
    for phrase, label in BASE_PHRASES.items():
        kinds.setdefault(phrase, []).append(("base", label, BASE_WEIGHT))
    for phrase, (label, weight) in NOTICE_PHRASES.items():
        kinds.setdefault(phrase, []).append(("notice", label, weight))
    for phrase in TAG_PHRASES:
        kinds.setdefault(phrase, []).append(("tag", "", TAG_WEIGHT))
    made = ahocorasick.Automaton()
    for phrase, what in kinds.items():
        made.add_word(f" {phrase} ", (phrase.count(" ") + 1, what))
    made.make_automaton()
    return made


def scan_text(text: str | None, patterns) -> dict:
    norm = normalised(text)
    spaces, base, labels, base_labels, doubt, tags = None, [], set(), set(), 1.0, []
    for place, (length, kinds) in patterns.iter(norm):
        if spaces is None:
            spaces = space_places(norm)
        last = word_at(spaces, place)
        for kind, label, weight in kinds:
            if kind == "tag":
                tags.append(last)
                continue
            if label not in labels:
                doubt *= 1 - weight
            labels.add(label)
            if kind == "base":
                base_labels.add(label)
                base.append(last - length + 1)
    expressions, verdicts = [], []
    if tags:
        wanted, ends = set(tags), []
        for k, m in enumerate(WORD.finditer(text)):
            if k in wanted:
                ends.append(m.end())
        stop = -1
        for end in ends:
            if stop < end:
                stop = text.find("\n", end)
                stop = len(text) if stop < 0 else stop
            postfix = shunting_yard(m.group() for m in TOKEN.finditer(text, end, stop)) if AFTER_TAG.match(text, end, stop) else None
            if postfix:
                doubt *= 1 - TAG_WEIGHT
                labels.update(licences_in(postfix))
                expressions.append(" ".join(postfix))
                verdicts.append(evaluate(postfix))
    return {
        "n_words": word_count(norm), "n_base": len(base), "first_word": min(base, default=None), "last_word": max(base, default=None),
        "base_labels": ",".join(sorted(base_labels)), "labels": ",".join(sorted(labels)), "score": 1 - doubt, "expressions": expressions, "permitted": all(verdicts) if verdicts else None,
    }


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): base places and labels, all labels, score, expressions.

    A null or empty text has no words and score 0; texts, lines and expressions of any length are read whole;
    overlapping phrases all count; repeated rows are judged alike; a null id stays null; an empty table gives an empty result; further columns are ignored.
    ``permitted`` is null where no expression was found.
    """

    def work(frames):
        patterns = build_automaton()
        for frame in frames:
            rows = [scan_text(t, patterns) for t in frame.column("text").to_pylist()]
            columns = [frame.column("doc_id")] + [pa.array([r[f.name] for r in rows], kind) for f, kind in zip(SCAN.fields[1:], _ARROW)]
            yield pa.RecordBatch.from_arrays(columns, names=SCAN.names)

    return mapped(docs.select("doc_id", "text"), work, SCAN)


_ARROW = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string()), pa.bool_()]
