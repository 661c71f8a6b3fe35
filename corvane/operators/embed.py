"""Embedding papers: pluggable embedders run over Arrow batches, with retries and failure rows."""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import vector as V
from ..functions.text import PROMPTS
from ..session import mapped
from . import requests

TITLE_PREFIX, ABSTRACT_PREFIX = PROMPTS["title"], PROMPTS["abstract"]


class Embedder(Protocol):
    def __call__(self, text: str) -> Sequence[float] | None:
        """The text's vector; None or an exception if it could not be made."""


class HashEmbedder:
    """Signed feature hashing of words to unit vectors: deterministic and offline."""

    MEMORY = 200_000  # words whose places are remembered

    def __init__(self, dim: int = 64):
        self.dim, self.known = dim, {}

    def _place(self, word: str) -> int:
        """The word's dimension, moved by ``dim`` if its sign is negative."""
        at = self.known.get(word)
        if at is None:
            h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
            if len(self.known) >= self.MEMORY:
                self.known.clear()
            at = self.known[word] = h % self.dim + (0 if h >> 63 else self.dim)
        return at

    def __call__(self, text: str) -> list[float]:
        counts = np.bincount([self._place(w) for w in text.lower().split()], minlength=2 * self.dim).astype(float)
        v = counts[: self.dim] - counts[self.dim :]
        if not v.any():  # no words, or words that cancel out
            v[len(text) % self.dim] = 1.0
        return (v / np.linalg.norm(v)).tolist()


class HttpEmbedder:
    """A model server: ``openai`` or ``tei`` requests, tried again after waiting.

    Status 429 waits twice as long each time; ``retry_status`` says whether other statuses are tried
    again too. ``watch``, if it is set, is called at each 429. ``open_url`` can be replaced in tests.
    """

    watch: Callable[[], None] | None = None

    def __init__(self, url: str, model: str = "", api: str = "openai", retries: int = 3, delay: float = 1.0, timeout: float = 30.0, normalize: bool | None = False, retry_status: bool = False, open_url: Callable | None = None):
        self.url, self.model, self.api, self.retries, self.delay, self.timeout, self.normalize, self.retry_status, self.open_url = url, model, api, retries, delay, timeout, normalize, retry_status, open_url

    def _body(self, text: str) -> dict:
        if self.api == "openai":
            return {"model": self.model, "input": text}
        return {"inputs": text} | ({} if self.normalize is None else {"normalize": self.normalize})

    def __call__(self, text: str) -> list[float]:
        request = urllib.request.Request(self.url, json.dumps(self._body(text)).encode(), {"Content-Type": "application/json"})
        for attempt in range(self.retries):
            last = attempt == self.retries - 1
            try:
                with (self.open_url or urllib.request.urlopen)(request, timeout=self.timeout) as answer:
                    found = json.loads(answer.read())
                return found["data"][0]["embedding"] if self.api == "openai" else found[0]
            except urllib.error.HTTPError as e:
                if e.code == 429 and self.watch:
                    self.watch()
                if last or e.code != 429 and not self.retry_status:
                    raise
                time.sleep(self.delay * 2**attempt if e.code == 429 else self.delay)
            except (OSError, ValueError):
                if last:
                    raise
                time.sleep(self.delay)
        raise RuntimeError("no attempt was made")


class LocalModelEmbedder:
    """A sentence-transformers model, loaded at the first text of a task; needs that library on the executors."""

    def __init__(self, model: str, normalize: bool = True, max_tokens: int | None = None):
        self.model, self.normalize, self.max_tokens, self.loaded = model, normalize, max_tokens, None

    def __call__(self, text: str) -> list[float]:
        if self.loaded is None:
            from sentence_transformers import SentenceTransformer

            self.loaded = SentenceTransformer(self.model)
            if self.max_tokens:
                self.loaded.max_seq_length = self.max_tokens
        return self.loaded.encode(text, normalize_embeddings=self.normalize).tolist()


class TransformersEmbedder:
    """A transformers model: the state of the last token that the mask keeps, at length 1; loaded at the first text of a task.

    ``load`` gives tokenizer and model, by default from that library, which the executors then need; tests
    can give others.
    """

    def __init__(self, model: str, max_tokens: int = 4096, load: Callable | None = None):
        self.model, self.max_tokens, self.load, self.loaded = model, max_tokens, load, None

    def _load(self):
        if self.load:
            return self.load(self.model)
        from transformers import AutoModel, AutoTokenizer

        return AutoTokenizer.from_pretrained(self.model), AutoModel.from_pretrained(self.model).eval()

    def __call__(self, text: str) -> list[float]:
        if self.loaded is None:
            self.loaded = self._load()
        tokenizer, model = self.loaded
        tokens = tokenizer([text], max_length=self.max_tokens, truncation=True, return_tensors="pt")
        states = model(**tokens).last_hidden_state[0]
        mask = np.asarray(tokens["attention_mask"][0]) > 0
        kept = np.asarray(states.detach().float().cpu() if hasattr(states, "detach") else states, float)[np.flatnonzero(mask)[-1]]
        length = np.linalg.norm(kept)
        return (kept / length if length else kept).tolist()


class WordCounter:
    """Length by a tokenizer file, or where it cannot be loaded by words between white space."""

    def __init__(self, path: str | None = None):
        self.tokenizer = None
        if path:
            try:
                from tokenizers import Tokenizer

                self.tokenizer = Tokenizer.from_file(path)
            except Exception:  # no library or no such file: count words
                self.tokenizer = None

    def __call__(self, text: str) -> int:
        return len(self.tokenizer.encode(text).ids) if self.tokenizer else len(text.split())


RESULT = "paper_id string, title_embedding array<float>, abstract_embedding array<float>, error string"


BATCH_ROWS, MEMORY_MB = 1000, 2048


def embed_papers(
    papers: DataFrame, make: Callable[[], Embedder], concurrency: int = 1, title_prefix: str = TITLE_PREFIX, abstract_prefix: str = ABSTRACT_PREFIX, partitions: int | None = None,
    batch_rows: int = BATCH_ROWS, memory_mb: float = MEMORY_MB, memory: Callable[[], float] = requests.resident_mb,
) -> DataFrame:
    """paper_id, both vectors, error of papers (id, title, abstract), and their row_index if they have one.

    ``make`` builds the embedder once a task. Up to ``concurrency`` requests are under way in a task, titles and
    abstracts alike, in a window that follows the server (``requests``); with the number of task slots that bounds
    what a server sees. Papers come as they are done. They are given on once there are ``batch_rows``, or
    once the worker's memory has grown by more than ``memory_mb``. Texts come to a worker in batches of bounded size (``mapped``),
    so its memory doesn't grow with the input. A failed paper is a row with its error and null vectors.
    Tasks may be repeated, so an embedder must not depend on being called once. ``partitions`` deals the
    papers anew before, where the input has too few splits for the work.
    """
    if partitions:
        papers = papers.repartition(partitions)
    placed = "row_index" in papers.columns
    names = ["paper_id", "title_embedding", "abstract_embedding", "error"] + ["row_index"] * placed

    def work(frames):
        embedder, window = make(), requests.RequestWindow(concurrency)
        if hasattr(embedder, "watch"):
            embedder.watch = window.busy
        kind, before = None, memory()  # with the model that ``make`` may have loaded

        def one(text):
            try:
                found = embedder(text)
                return (found, None) if found is not None else (None, "no vector")
            except Exception as e:  # a paper's failure is a result
                return None, f"{type(e).__name__}: {e}"

        def texts():
            """(the paper's row, which side, text); a row holds its id, its place and the answers."""
            nonlocal kind
            for frame in frames:
                kind = frame.column("id").type
                for i, row in enumerate(zip(*(frame.column(c).to_pylist() for c in ("id", "title", "abstract")))):
                    held = [row[0], frame.column("row_index")[i].as_py() if placed else None, None, None]
                    yield held, 2, title_prefix + (row[1] or "")
                    yield held, 3, abstract_prefix + (row[2] or "")

        def answers():
            if concurrency > 1:
                yield from requests.sliding(texts(), lambda item: one(item[2]), window)
            else:
                yield from ((item, one(item[2])) for item in texts())

        def batch(rows):
            errors = [r[2][1] or r[3][1] for r in rows]
            vectors = [pa.array([None if e else r[side][0] for r, e in zip(rows, errors)], pa.list_(pa.float32())) for side in (2, 3)]
            columns = [pa.array([r[0] for r in rows], kind), *vectors, pa.array(errors, pa.string())] + ([pa.array([r[1] for r in rows], pa.int64())] if placed else [])
            return pa.RecordBatch.from_arrays(columns, names=names)

        rows = []
        for (held, side, _), found in answers():
            held[side] = found
            if held[2] and held[3]:
                rows.append(held)
                if len(rows) >= batch_rows or memory() - before > memory_mb:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)

    columns = ["id", "title", "abstract"] + [F.col("row_index").cast("long").alias("row_index")] * placed
    return mapped(papers.select(*columns), work, RESULT + ", row_index bigint" * placed)


def write_results(results: DataFrame, path: str) -> dict[str, float]:
    """Writes the results of ``embed_papers`` once and tells succeeded, failed and seconds, all from that one pass.

    Whatever is made of them reads the written rows, so no paper goes to the model a second time.
    """
    observed, began = Observation(), time.monotonic()
    error = F.col("error").isNotNull()
    results.observe(observed, F.count_if(~error).alias("succeeded"), F.count_if(error).alias("failed")).write.mode("overwrite").parquet(path)
    return {**observed.get, "seconds": time.monotonic() - began}


def succeeded(results: DataFrame) -> DataFrame:
    return results.where("error is null").drop("error")


def failures(results: DataFrame) -> DataFrame:
    return results.where("error is not null").select("paper_id", "error")


def token_lengths(texts: DataFrame, column: str, make: Callable[[], Callable[[str], int]]) -> DataFrame:
    """``texts`` with ``length`` by a tokenizer that ``make`` builds once a task."""
    from pyspark.sql import types as T

    out = T.StructType([*texts.schema.fields, T.StructField("length", T.LongType())])

    def work(frames):
        count = make()
        for frame in frames:
            lengths = pa.array([count(t or "") for t in frame.column(column).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*frame.columns, lengths], names=out.names)

    return mapped(texts, work, out)


def reembedded(sampled: DataFrame, papers: DataFrame, make: Callable[[], Embedder], concurrency: int = 1) -> DataFrame:
    """paper_id, title_similarity, abstract_similarity of stored and fresh vectors of the sampled rows.

    Only papers with title and abstract are compared; a failed one has null similarities.
    """
    texts = papers.where("title <> '' and abstract <> ''").join(sampled.select(F.col("paper_id").alias("id")), "id", "left_semi")
    fresh = embed_papers(texts, make, concurrency).select("paper_id", F.col("title_embedding").alias("t"), F.col("abstract_embedding").alias("a"))
    both = sampled.select("paper_id", "title_embedding", "abstract_embedding").join(fresh, "paper_id")
    return both.select("paper_id", F.when(F.col("t").isNotNull(), V.cosine("title_embedding", "t")).alias("title_similarity"), F.when(F.col("a").isNotNull(), V.cosine("abstract_embedding", "a")).alias("abstract_similarity"))
