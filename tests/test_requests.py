"""The window of requests, against servers that are slow, busy, or broken; the server is simulated here and nowhere else."""

import json
import threading
import time

import pytest

from corvane.operators import embed, requests
from corvane.sources import sinks, stores
from corvane.streaming import incremental


def in_flight(limit=None, seconds=0.002):
    """A server's work: counts what is under way; beyond ``limit`` it refuses."""
    state = {"now": 0, "most": 0, "refused": 0, "calls": 0}
    lock = threading.Lock()

    def work(_):
        with lock:
            state["calls"] += 1
            state["now"] += 1
            state["most"] = max(state["most"], state["now"])
            refuse = limit is not None and state["now"] > limit
            state["refused"] += refuse
        time.sleep(seconds)
        with lock:
            state["now"] -= 1
        return not refuse

    return work, state


def test_one_slow_text_holds_up_no_other():
    began, done = time.perf_counter(), {}

    def work(n):
        time.sleep(1.0 if n == 5 else 0.002)
        return n

    for n, found in requests.sliding(range(200), work, requests.RequestWindow(4)):
        done[n] = time.perf_counter() - began
        assert n == found
    assert sorted(done) == list(range(200)) and done[5] >= 1.0
    assert sum(t < 0.9 for t in done.values()) == 199  # all others, though they came in batches after it


def test_a_storm_of_refusals_keeps_the_window_small():
    work, state = in_flight(limit=4)
    window, sizes = requests.RequestWindow(64), []

    def patient(n):
        while not work(n):
            window.busy()
            time.sleep(0.001)
        return n

    for i, _ in enumerate(requests.sliding(range(2000), patient, window)):
        if i > 300:
            sizes.append(window.size)
    assert window.least <= 4 and sum(sizes) / len(sizes) < 8
    assert state["refused"] < 0.5 * state["calls"]


def test_the_window_grows_back_and_halves_when_answers_take_longer():
    now = [0.0]
    window = requests.RequestWindow(32, clock=lambda: now[0])
    latency = [0.1]

    def answer():
        window.timed(lambda: now.__setitem__(0, now[0] + latency[0]))()

    for _ in range(100):
        answer()
    assert window.size == 32
    latency[0] = 1.0
    for _ in range(100):
        answer()
    assert window.size <= 2
    latency[0] = 0.1
    for _ in range(1000):
        answer()
    assert window.size == 32


def test_one_burst_halves_once():
    window = requests.RequestWindow(32, clock=iter(range(10**6)).__next__)
    for n in range(10):
        window.local.began = 0  # all began before any was refused
        window.busy()
    assert window.size == 16


def test_results_are_given_on_at_a_count_or_at_a_bound_of_memory(spark):
    papers = spark.range(90).selectExpr("string(id) id", "'t' title", "'a' abstract").coalesce(1)
    sizes = lambda **more: [r["n"] for r in embed.embed_papers(papers, lambda: len_, concurrency=3, **more).mapInArrow(batches, "n long").collect()]

    def len_(text):
        return [float(len(text))]

    def batches(frames):
        import pyarrow as pa

        for f in frames:
            yield pa.RecordBatch.from_arrays([pa.array([f.num_rows])], names=["n"])

    # the downstream stage may join what it gets, so the bound is asked of the rows that are held at once
    assert sum(sizes(batch_rows=7)) == 90 and sum(sizes(memory_mb=100, memory=lambda: 101.0)) == 90
    assert requests.resident_mb() > 10


class Held:
    """Memory at the start, and then more than the bound beyond it whenever three papers are held."""

    asked = -1

    def __call__(self):
        self.asked += 1
        return 1000.0 + (200.0 if self.asked and self.asked % 3 == 0 else 50.0)


def test_memory_bound_empties_what_is_held(monkeypatch):
    """The task's function itself, without Spark around it."""
    import pyarrow as pa

    frames = [pa.RecordBatch.from_pydict({"id": [f"{b}{i}" for i in range(10)], "title": ["t"] * 10, "abstract": ["a"] * 10}) for b in range(3)]
    made = {}

    class Papers:
        columns = ["id", "title", "abstract"]

        def select(self, *_):
            return self

        def mapInArrow(self, work, kind):  # noqa: N802
            made["out"] = [f.num_rows for f in work(iter(frames))]

    embed.embed_papers(Papers(), lambda: lambda text: [1.0], memory_mb=100, memory=Held())
    assert made["out"] == [3] * 10
    embed.embed_papers(Papers(), lambda: lambda text: [1.0], batch_rows=12, memory=lambda: 0.0)
    assert made["out"] == [12, 12, 6]


@pytest.fixture
def server():
    """Busy at each text's first request; cannot take texts of some lengths."""

    def make():  # made here, so that workers get it by value
        import io
        import json
        import urllib.error

        seen = set()

        def open_url(request, timeout):
            body = request.data.decode()
            text = json.loads(body)["input"]
            if len(text) % 5 == 0:
                raise urllib.error.HTTPError(request.full_url, 500, "no", {}, None)
            if body not in seen:
                seen.add(body)
                raise urllib.error.HTTPError(request.full_url, 429, "busy", {}, None)
            return io.BytesIO(json.dumps({"data": [{"embedding": [float(len(text)), 1.0]}]}).encode())

        return embed.HttpEmbedder("http://localhost/", delay=0, open_url=open_url)

    return make


def test_papers_through_a_busy_server(spark, server):
    papers = spark.createDataFrame([(str(i), "t" * i, "a" * (i % 7), i) for i in range(40)], "id string, title string, abstract string, row_index long")
    found = {r["paper_id"]: r for r in embed.embed_papers(papers.repartition(2), server, concurrency=4).collect()}
    for i in range(40):
        t, a = len("Title: ") + i, len("Abstract: ") + i % 7
        r = found[str(i)]
        assert (r["error"] is not None) == (t % 5 == 0 or a % 5 == 0) and r["row_index"] == i
        assert r["error"] or (r["title_embedding"][0], r["abstract_embedding"][0]) == (t, a)


@pytest.fixture
def counted(tmp_path):
    """An embedder that leaves a line a call, so that calls in other processes are counted."""
    log = str(tmp_path / "calls")

    def make():
        def embedder(text):
            with open(log, "a") as f:
                f.write("x\n")
            return None if "bad" in text else [float(len(text)), 1.0]

        return embedder

    return make, lambda: open(log).read().count("x")


def test_counts_come_from_the_pass_that_writes(spark, tmp_path, counted):
    make, calls = counted
    papers = spark.createDataFrame([(str(i), "bad" if i % 10 == 0 else "t", "a") for i in range(50)], "id string, title string, abstract string")
    counts = embed.write_results(embed.embed_papers(papers, make), str(tmp_path / "r"))
    assert (counts["succeeded"], counts["failed"]) == (45, 5) and calls() == 100
    info = sinks.run_info(counts, "m", 2).first()
    assert (info["total_papers"], info["failed_papers"], info["success_rate"]) == (45, 5, "90.00%") and info["papers_per_second"] > 0
    assert calls() == 100 and embed.failures(spark.read.parquet(str(tmp_path / "r"))).count() == 5


def test_a_batch_that_is_run_again_calls_the_model_no_more(spark, tmp_path, counted, monkeypatch):
    make, calls = counted
    store, failed, check = (str(tmp_path / n) for n in ("store", "failed", "check"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one").write_text("".join(json.dumps({"id": str(i), "title": "bad" if i == 3 else "t", "abstract": "a"}) + "\n" for i in range(10)))
    run = lambda: incremental.embed_stream(incremental.paper_stream(spark, str(tmp_path / "in")), store, failed, check, make).awaitTermination(120)
    plain = incremental.with_positions
    monkeypatch.setattr(incremental, "with_positions", lambda *a, **k: 1 / 0)  # broken off after the results were written
    with pytest.raises(Exception, match="ZeroDivisionError|division by zero"):
        run()
    before = calls()
    monkeypatch.setattr(incremental, "with_positions", plain)
    run()
    assert calls() == before == 20
    assert sorted(r["row_index"] for r in spark.read.parquet(store).collect()) == list(range(9))
    assert [tuple(r)[:3] for r in incremental.runs(spark, failed).collect()] == [(0, 9, 1)]
    assert [r["paper_id"] for r in incremental.still_failed(spark, store, failed).collect()] == ["3"]


def test_two_that_append_at_once_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "v")
    with stores.appending(spark, path, "one") as start:
        assert start == 0
        with pytest.raises(RuntimeError, match="by one"), stores.appending(spark, path, "two"):
            pass
        with stores.appending(spark, path, "one") as again:  # the same run, broken off and begun anew
            assert again == 0
    with stores.appending(spark, path, "two") as start:
        assert start == 0


def test_sentence_transformers_model(monkeypatch):
    import sys
    import types

    class Model:
        max_seq_length = 512

        def __init__(self, name):
            self.name = name

        def encode(self, text, normalize_embeddings):
            import numpy as np

            return np.array([len(text), self.max_seq_length, float(normalize_embeddings)])

    monkeypatch.setitem(sys.modules, "sentence_transformers", types.SimpleNamespace(SentenceTransformer=Model))
    assert embed.LocalModelEmbedder("m", normalize=False, max_tokens=77)("four") == [4.0, 77.0, 0.0]
    assert embed.LocalModelEmbedder("m")("four") == [4.0, 512.0, 1.0]


def test_texts_come_in_batches_of_bounded_size(spark):
    """What a worker is given at once is bounded, whatever Spark's own bounds are."""
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("10000", str(256 << 20))):
            spark.conf.set(k, v)
        papers = spark.range(3000).selectExpr("string(id) id", "'t' title", "repeat('a ', 10000) abstract").coalesce(1)
        given = embed.embed_papers(papers, lambda: lambda text: [1.0], batch_rows=1 << 30)
        assert given.count() == 3000 and int(spark.conf.get(keys[0])) <= 2000 and int(spark.conf.get(keys[1])) <= 8 << 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
