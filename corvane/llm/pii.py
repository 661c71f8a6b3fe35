"""Personal data: high-recall generators, boosted trees over candidates, calibrated thresholds.

The base spans (emails, IPv4 addresses, payment cards, international phone numbers) are exact
patterns and always stay. Beside them, generators propose overlapping candidates for national phone
numbers, social-security numbers, account numbers, secrets, IPv6, spelled-out emails, and cards that
other digits touch, which the exact pattern takes into one long number and drops. Each
candidate gets format features (digits, letters, entropy, checksums, grouping) and context features
(keywords before it, the characters around it). Boosted trees, grown on a synthetic labelled set
that ``training_set`` makes from a seed, score it; a threshold for each kind, found on calibration
rows that the trees have not seen and one half at least, decides. Of overlapping chosen spans the surest stays.

Documents are mapped where they lie; the trees (some 100 KB) travel with the function. Every
pattern runs in time linear in the text.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pii_examples
from .boosting import BoostedTrees, precise_threshold
from .common import DOUBLE, LONG, STRING, mapped, schema

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("national_phone", "ssn", "iban", "secret", "ipv6", "spelled_email", "adjacent_card")
KINDS = BASE_KINDS + EXTRA_KINDS
FAMILIES = (EXTRA_KINDS[:-1], EXTRA_KINDS[-1:])  # kinds that share trees: what tells a card says nothing of the others
PRECISION = 0.97  # that each kind's threshold reaches on the calibration rows
ROUNDING = 1e-9  # a threshold is some row's own probability, whose last bits may differ between processors
SEED, EXAMPLES = 20240229, 500  # of the synthetic training set: examples of each kind, and look-alikes
CONTEXT = 40  # characters before a candidate in which keywords count

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """As the pattern finds them, leftmost first; each @ looks back over its local part once."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _AT.match(text, at) if start < at else None
        free = found.end() if found else at + 1
        if found:
            out.append((start, found.end()))
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the exact patterns, leftmost non-overlapping within each kind."""
    out = []
    if "@" in text:
        out += [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 40 and 14 <= len(d := _only_digits(m.group())) <= 19 and luhn(d):
                out.append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_only_digits(m.group())) <= 15:
                    out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], BASE_KINDS.index(s[2])))


_CARD_FORM = r"(?:[2-6][0-9]{14,15}|[3-6][0-9]{3}(?:[ -][0-9]{4}){3}|3[0-9]{3}[ -][0-9]{6}[ -][0-9]{5})"
_GENERATORS = {
    "national_phone": (re.compile(r"(?<![0-9A-Za-z+./-])(?:\(?[0-9]{2,5}\)?(?:[ ./-]{1,2}[0-9]{2,9}){1,5}|0[0-9]{8,11})(?![0-9A-Za-z])"), "digit"),
    "ssn": (re.compile(r"(?<![0-9-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9-])"), "digit"),
    "iban": (re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"), "digit"),
    "secret": (re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]{8,}+){1,2}|(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,}+|(?<=[=:])[ \t]?[\"']?[^\s\"',;]{8,}+"), "any"),
    "ipv6": (re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"), "colon"),
    "spelled_email": (re.compile(r"(?<![A-Za-z0-9._])[A-Za-z0-9._]{2,}+ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{2,}+(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]{2,}+|\.[A-Za-z0-9-]{2,}+)++"), "bracket"),
    "adjacent_card": (re.compile(rf"(?<![0-9])(?=({_CARD_FORM}(?![0-9])))(?:(?<![0-9][ -])|(?={_CARD_FORM}(?![0-9]|[ -][0-9]{{4}})))"), "digit"),  # first or last in a run of digits, so no column of numbers
}
_INNER = re.compile(r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,}+|(?<=[=:])[^=:&]{8,}+")  # tokens and values inside a longer value
_LONG_VALUE = 128  # characters; a longer value, or a link, is proposed whole and by what it holds
_PHONE_WORDS = re.compile(r"(?i)(?:\b(?:tel|phone|call|mobile|mobil|cell|fax|tél|appel|llam|handy|num[eé]ro|número|dial|whatsapp|ring|portable|móvil)|rufnummer|phone)")
_ID_WORDS = re.compile(r"(?i)(?:ssn|social|security|iban|account|konto|compte|cuenta)")
_SECRET_WORDS = re.compile(r"(?i)(?:passw|pwd|secret|token|api[_ -]?key|credential|auth|bearer|private|access[_-]?key)")
_OWN_NAME = re.compile(r"([A-Za-z0-9_:-]*)[\"']?\s?[=:]\s?[\"']?$|(?:[Bb]earer|is|to) $")  # what a value is given to
_LINK_NAME = re.compile(r"(?i)(?:href|src|srcset|action|url|link|poster|cite|content|from)$")
_TAG_NAME = re.compile(r"(?i)(?:class|id|style|rel|type|name|title|alt|lang|target|role|property|media|for|label|color|width|height|display|placeholder|onclick|integrity)$")
_LINK_START = re.compile(r"(?i)(?:[a-z][a-z0-9+.-]*:)?//|\.{0,2}/|#|www\.|[a-z]:\\|mailto:|data:")
_FILE_END = re.compile(r"\.(?:[a-z]{2,5}|woff2|mp[34])(?:[?#].*)?/?$")
_HOST = re.compile(r"(?<=[a-z0-9])\.(?:com|org|net|edu|gov|info|io|de|fr|es|uk|co)\b")
_WORDLIKE = re.compile(r"[A-Z]?[a-z]{3,}+|[A-Z]{3,}+")
_HARSH = re.compile(r"[bcdfghjklmnpqrstvwxz]{5,}|[aeiou]{5,}|[a-z][A-Z][a-z][A-Z]")  # what hardly stands in a word
_KEY_START = re.compile(r"(?:AKIA|ASIA|ghp_|gho_|github_pat_|sk_live_|sk_test_|sk-|xox[abp]-|AIza|eyJ|glpat-)")  # fixed values: how public services' keys begin
_OTHER_WORDS = re.compile(r"(?i)(?:order|invoice|version|isbn|issue|page|sku|commit|sha|sha256|md5|checksum|date|price|total|uuid|id|score|final|won|sets|results?|zip|population|merged in|integrity|part|lot)\b")


def candidates(text: str) -> list[tuple[int, int, str]]:
    """Overlapping spans of the generators; a cheap test first tells which generators can match."""
    digit = bool(_DIGIT.search(text))
    can = {"digit": digit, "any": digit or "=" in text, "colon": "::" in text or text.count(":") > 2, "bracket": "at)" in text or "at]" in text or "AT)" in text or "AT]" in text}
    out = []
    for kind, (pattern, need) in _GENERATORS.items():
        if can[need]:
            for m in pattern.finditer(text):
                start, end = m.span(pattern.groups)  # the group where the pattern looks ahead
                while start < end and text[start] in " \t\"'":
                    start += 1
                if end > start:
                    out.append((start, end, kind))
                if kind == "secret" and (end - start > _LONG_VALUE or text.find("//", start, end) >= 0 or text.find("@", start, end) >= 0):
                    out += [(*i.span(), kind) for i in _INNER.finditer(text, start, end) if i.span() != (start, end)]
    return out


def _nearness(words: re.Pattern, before: str) -> float:
    """0 without a keyword, towards 1 the nearer the last one stands."""
    last = None
    for last in words.finditer(before):
        pass
    return 1 - (len(before) - last.end()) / (CONTEXT + 1) if last else 0.0


def _value_features(span: str, before: str) -> list[float]:
    """What tells links, files, attributes, code and words from random text."""
    n, own = len(span), _OWN_NAME.search(before)
    name = own[1] or "" if own else ""
    lower = span.lower()
    letters = sum("a" <= c <= "z" for c in lower)
    words = [m.group() for m in _WORDLIKE.finditer(span)]
    in_words = sum(len(w) for w in words if any(c in "aeiouyAEIOUY" for c in w) and not _HARSH.search(w.lower()))
    opened, closed = before.rfind("<"), before.rfind(">")
    return [
        in_words / n, max(map(len, words), default=0), sum(c in "aeiou" for c in lower) / max(1, letters), float(bool(_HARSH.search(span))), span.count("."), span.count("/"), span.count("-") + span.count("_"), sum(c in "()[]{}<>;|$\\`" for c in span), sum(c in "=&?%+" for c in span),
        float(bool(_LINK_START.match(span))), float(bool(_FILE_END.search(lower))), float(bool(_HOST.search(lower))), float(opened > closed), float(bool(_LINK_NAME.search(name))), float(bool(_TAG_NAME.search(name))), float(bool(_SECRET_WORDS.search(name))), float(bool(own)), float(bool(name)),
        float(before.endswith("base64,")), float(before[-1:] in ("/", ".", "?", "&", "#", "-")), float(before.rfind("://") >= 0 and " " not in before[before.rfind("://") :]), float(len(set(span)) / n), float(lower == span), float(not span.isascii()), max((len(g) for g in re.findall(r"[0-9]+", span)), default=0),
    ]


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    span, before = text[start:end], text[max(0, start - CONTEXT) : start]
    n = len(span)
    digits = sum("0" <= c <= "9" for c in span)
    letters = sum(c.isalpha() for c in span)
    upper = sum(c.isupper() for c in span)
    hexes = sum(c in "0123456789abcdefABCDEF" for c in span)
    counts = np.array(list(Counter(span).values())) / n
    groups = re.split(r"[^0-9A-Za-z]+", span)
    compact = re.sub(r"[^0-9A-Za-z]", "", span)
    turned = sum((a.isdigit() != b.isdigit()) for a, b in zip(compact, compact[1:]))
    mod97 = 0.0
    if kind == "iban" and compact.isalnum() and compact.isascii():
        mod97 = float(int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1)
    near = before[-3:]
    return [
        *[float(kind == k) for k in EXTRA_KINDS],
        n, digits, digits / n, letters / n, upper / n, hexes / n, float(-(counts * np.log2(counts)).sum()), turned, len(groups), max(map(len, groups)), min(map(len, groups)), len(groups[-1]), len(groups[0]),
        mod97, float(luhn(_only_digits(span))) if digits else 0.0, float("(" in span), float("." in span), float("-" in span), float(" " in span), float("::" in span), float("/" in span), float("_" in span),
        float(near.rstrip(" \"'")[-1:] in ("=", ":")), float(near[-1:] in ("\"", "'")), float(before[-1:] in ("$", "€", "#", "v", "/")), float(text[end : end + 1] in ("%", "€", "$", "/", "°")),
        *[_nearness(words, before) for words in (_PHONE_WORDS, _ID_WORDS, _SECRET_WORDS, _OTHER_WORDS)],
        *_value_features(span, before),
        float(groups[0] in ("19", "20") or bool(re.match(r"(?:19|20)[0-9]{2}$", groups[0]))), float(compact[:3] in ("000", "666") or compact[:1] == "9"), float(bool(_KEY_START.match(span))),
    ]


def training_set(family: tuple[str, ...], seed: int = SEED, examples: int = EXAMPLES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, outcomes and kinds (their places in ``family``) of the candidates that the generators make of made-up examples.

    A candidate is right if it is the example's span and of its kind. One that meets the span in part, but
    is of its kind, is left out, and so is a number that happens to pass as a card; any other that meets it is wrong, so the kinds are told from each other.
    """
    x, y, kinds = [], [], []
    for text, start, end, kind in pii_examples.examples(seed, examples, luhn):
        for a, b, k in candidates(text):
            real = k == "adjacent_card" and luhn(_only_digits(text[a:b]))  # by chance, in a look-alike of something else
            if k in family and a < end and start < b and ((k != kind and not real) or (a, b) == (start, end)):
                x.append(features(text, a, b, k))
                y.append(k == kind)
                kinds.append(family.index(k))
    order = list(range(len(x)))
    random.Random(seed).shuffle(order)
    return np.array(x)[order], np.array(y, float)[order], np.array(kinds)[order]


class Model:
    def __init__(self, seed: int = SEED, examples: int = EXAMPLES, precision: float = PRECISION):
        self.trees, self.thresholds, right = {}, {}, []
        for family in FAMILIES:
            x, y, kinds = training_set(family, seed, examples)
            a, b = len(x) * 6 // 10, len(x) * 9 // 10  # grown, calibrated and thresholded, held out
            trees = BoostedTrees().fit(x[:a], y[:a]).calibrate(x[a:b], y[a:b])
            p = trees.probability(x[a:b])
            self.thresholds |= {k: max(0.5, precise_threshold(p[at], y[a:b][at], precision) - ROUNDING) for i, k in enumerate(family) for at in [kinds[a:b] == i]}
            chosen = trees.probability(x[b:]) >= np.array([self.thresholds[family[k]] for k in kinds[b:]])
            self.trees |= dict.fromkeys(family, trees)
            right.append(np.stack([y[b:], chosen]))
        y, chosen = np.concatenate(right, 1)
        self.held_out = {"precision": float(y[chosen > 0].mean()), "recall": float(chosen[y > 0].mean())}

    def probability(self, texts: list[str], found: list[tuple[int, tuple[int, int, str]]]) -> np.ndarray:
        """Of candidates (number of the text, span)."""
        p = np.zeros(len(found))
        for family in FAMILIES:
            at = [k for k, (_, s) in enumerate(found) if s[2] in family]
            if at:
                p[at] = self.trees[family[0]].probability(np.array([features(texts[found[k][0]], *found[k][1]) for k in at]))
        return p

    def choose(self, texts: list[str]) -> list[list[tuple[int, int, str, float]]]:
        """Of each text the base spans, and the candidates that pass and overlap no surer span."""
        base = [base_spans(t) for t in texts]
        found = [(i, s) for i, t in enumerate(texts) for s in candidates(t) if s[2] != "adjacent_card" or not _overlaps([b[:2] for b in base[i]], *s[:2])]
        p = self.probability(texts, found)
        out = [[(*s, 1.0) for s in b] for b in base]
        passed = [(i, s, float(v)) for (i, s), v in zip(found, p) if v >= self.thresholds[s[2]]]
        for i, group in _grouped(passed):
            taken = sorted((a, b) for a, b, _, _ in out[i])
            for (start, end, kind), v in sorted(group, key=lambda g: (-g[1], g[0])):
                if not _overlaps(taken, start, end):
                    _insert(taken, (start, end))
                    out[i].append((start, end, kind, v))
            out[i].sort(key=lambda s: (s[0], KINDS.index(s[2])))
        return out


def _grouped(passed):
    by: dict[int, list] = {}
    for i, span, v in passed:
        by.setdefault(i, []).append((span, v))
    return by.items()


def _overlaps(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    from bisect import bisect_left

    # base spans of different kinds may overlap each other, so look back over a few of them
    at = bisect_left(taken, (end, -1))
    return any(b > start for _, b in taken[max(0, at - len(BASE_KINDS) - 1) : at])


def _insert(taken: list[tuple[int, int]], span: tuple[int, int]) -> None:
    from bisect import insort

    insort(taken, span)


@cache
def model() -> Model:
    return Model()


SPANS = T.ArrayType(T.StructType([T.StructField("start", LONG), T.StructField("end", LONG), T.StructField("kind", STRING), T.StructField("probability", DOUBLE)]))


def _chosen(docs: DataFrame, out: T.StructType, build) -> DataFrame:
    """Maps batches of documents; the trees are grown once on the driver and travel along."""
    grown = model()

    def work(frames):
        for frame in frames:
            texts = [t or "" for t in frame.column("text").to_pylist()]
            yield build(frame, texts, grown.choose(texts))

    return mapped(docs, work, out)


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id and spans (start, end, kind, probability) of every row of ``docs`` (doc_id, text).

    A null or empty text has no spans; texts are read whole; repeated rows are judged alike; an
    empty table gives an empty result; further columns are ignored.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("probability", pa.float64())]))

    def build(frame, texts, chosen):
        rows = [[{"start": a, "end": b, "kind": k, "probability": p} for a, b, k, p in spans] for spans in chosen]
        return pa.RecordBatch.from_arrays([frame.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    return _chosen(docs.select("doc_id", "text"), schema(doc_id=docs.schema["doc_id"].dataType, spans=SPANS), build)


def redact_text(text: str, spans: list[tuple]) -> str:
    """Each span's characters replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for start, end, kind, *_ in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns, the chosen spans of ``text`` replaced and ``n_chars`` counted anew, where it is there.

    A null text stays null, an empty one empty; texts and spans of any length are replaced whole; repeated
    rows are treated alike; other columns stay, whatever their names; an empty table gives an empty result.
    """

    def build(frame, texts, chosen):
        raw = frame.column("text").to_pylist()
        new = [None if t is None else redact_text(t, s) for t, s in zip(raw, chosen)]
        at = frame.schema.get_field_index("text")
        return frame.set_column(at, frame.schema.field("text"), pa.array(new, frame.schema.field("text").type))

    out = _chosen(docs, docs.schema, build)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans as text, and the number of added spans.

    One row a row of ``docs`` (doc_id, text). A null text counts as an empty one, which has no spans; texts
    are read whole; repeated rows are judged alike; a null id stays null; an empty table gives an empty
    result; further columns are ignored.
    """
    out = schema(doc_id=LONG, n_email=LONG, n_ip=LONG, n_card=LONG, n_phone=LONG, base_sha256=STRING, spans=STRING, n_added=LONG)

    def joined(spans):
        return ",".join(f"{k}:{a}:{b}" for a, b, k, _ in spans)

    def build(frame, texts, chosen):
        base = [[s for s in spans if s[2] in BASE_KINDS] for spans in chosen]
        counts = [[sum(s[2] == k for s in b) for b in base] for k in BASE_KINDS]
        columns = [frame.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts]]
        columns += [pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base]), pa.array([joined(c) for c in chosen]), pa.array([len(c) - len(b) for c, b in zip(chosen, base)], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=out.names)

    return _chosen(docs.select("doc_id", "text"), out, build)
