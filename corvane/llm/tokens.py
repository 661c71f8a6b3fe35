"""Token ids of whole texts by a public tokenizer, through a bounded memory of chunks.

A tokenizer whose words end in a suffix (``</w>``) drops white space, and its pre-tokenizer never
joins characters across it; so a text's ids are the joined ids of its chunks between white space.
A chunk of plain letters and a tail of full stops and commas is two such chunks. Most chunks recur;
their ids are looked up instead of computed again, and new plain words are encoded many at a time.
Other tokenizers get the whole text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence

import numpy as np

_LETTERS = "a-zß-öø-ÿ"
CHUNK = re.compile(rf"[{_LETTERS}]++(?=[.,]*+(?:[ \t\n\r]|\Z))|[.,]++(?=[ \t\n\r]|\Z)|[^ \t\n\r]++")
PLAIN = re.compile(rf"[{_LETTERS}]{{1,64}}+")
#: Beyond Latin letters, lower-casing and composing of characters may not commute; < opens a special token.
KEEP_CASE = re.compile(r"[̀-\U0010ffff]|<\|")
MEMORY_CHUNKS = 600_000  # chunks remembered in a worker, some 120 MB; beyond, only those of the batch at hand stay
MEMORY_CHARS = 64  # longer chunks are not remembered


def _keeps_case(text: str) -> bool:
    return "<|" in text if text.isascii() else KEEP_CASE.search(text) is not None


class ChunkTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        self.suffix = made["model"].get("end_of_word_suffix") or ""
        steps = [s["type"] for s in (made.get("normalizer") or {}).get("normalizers", [])]
        self.by_chunk, self.known = bool(self.suffix) and steps == ["NFC", "Replace", "Lowercase"], {}
        if self.by_chunk:  # for plain lower-case words, which the normalizer leaves as they are
            self.words = Tokenizer.from_file(path)
            self.words.normalizer = normalizers.Sequence([])
            self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
                self.ends[number] = token.endswith(self.suffix)

    def ids(self, texts: Sequence[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self.by_chunk:
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]
        split = [CHUNK.findall(t if _keeps_case(t) else t.encode().lower().decode()) for t in texts]
        here = set().union(*split)
        if len(self.known) > MEMORY_CHUNKS:
            self.known = {c: self.known[c] for c in here.intersection(self.known)}
        known, new = self.known, here.difference(self.known)
        self._learn_words([c for c in new if PLAIN.fullmatch(c)])
        large: dict[str, bytes] = {}
        rest = [c for c in new if c not in known]
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            for chunk, found in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                (known if len(chunk) <= MEMORY_CHARS else large)[chunk] = np.array(found.ids, "<u4").tobytes()
        if large:
            return [b"".join([known[c] if c in known else large[c] for c in chunks]) for chunks in split]
        return [b"".join(map(known.__getitem__, chunks)) for chunks in split]

    def _learn_words(self, words: list[str]) -> None:
        """Ids of many words in one call, told apart by the tokens that end a word."""
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            ids = np.array(self.words.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some):
                raw, start = ids.tobytes(), 0
                for word, stop in zip(some, (4 * stops).tolist()):
                    self.known[word] = raw[start:stop]
                    start = stop


_loaded: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    """One tokenizer a worker and path."""
    if path not in _loaded:
        _loaded[path] = ChunkTokenizer(path)
    return _loaded[path]


def batches(texts: Sequence[str], most: int = 2_000_000):
    """Index ranges of about ``most`` characters, so that one batch of long texts stays small."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
