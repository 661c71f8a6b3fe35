import re
from itertools import permutations

import numpy as np
import pytest

from corvane.llm import filteraudit as A


def fails(text, copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = {"A"} if len(words) < 200 else set()
    out |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
    out |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
    out |= {"D"} if re.search(r"[#$%&*|]", text) else set()
    return out | ({"E"} if copy else set())


def brute(docs, labels):
    """Each filter applied to each document, in each order."""
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    out = {}
    for part in {s or "" for *_, s in docs}:
        own = [(d, fails(t or "", d is not None and least[t or ""] < d)) for d, t, s in docs if (s or "") == part]
        rows, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [(d, x) for d, x in left if f in x]
                left = [(d, x) for d, x in left if f not in x]
                total[f] += len(gone)
                rows.append(("".join(order), step, f, len(left), len(gone), sum(f in x for _, x in own) - len(gone), sum(x == {f} for _, x in own), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
        out |= {(part, o, s): (*rest, total[f]) for o, s, f, *rest in rows}
    return out


def found(df):
    return {tuple(r[:3]): tuple(r[3:]) for r in df.collect()}


def test_all_rows_of_a_small_table(spark, few_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in few_docs.collect()]
    assert found(A.audit(few_docs, labels)) == brute(docs, [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()])


def test_odd_rows(spark, edge_docs, no_docs):
    labels = [(1, 1, None), (1, 0, 1), (2, None, None), (4, 1, 0), (None, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in edge_docs.collect()]
    assert found(A.audit(edge_docs, frame)) == brute(docs, labels[:4] + labels[5:])
    assert A.audit(no_docs, frame).count() == 0 and found(A.audit(edge_docs, frame.limit(0))) == brute(docs, [])


def test_copies_over_parts_and_null_sources(spark):
    docs = [(i, "same Text" if i % 2 else f"other {i}", ("a", "b", None, "")[i % 4]) for i in range(40)] + [(3, "same Text", "a"), (1, "same Text", "b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    labels = [(i, i % 2, i % 3 == 0) for i in range(40)]
    got = found(A.audit(frame, spark.createDataFrame([(d, q, int(t)) for d, q, t in labels], "doc_id long, quality int, toxic int")))
    assert got == brute(docs, labels) and {k[0] for k in got} == {"a", "b", ""}


@pytest.mark.parametrize("text", ["", " ", "a\x0bb\x0cc d e", "Ä" * 5 + "AB", "a|b", "w " * 199, "w " * 200, "A" + "b" * 49, "A" + "b" * 48, " ".join(str(i // 2) for i in range(400)), " ".join(str(i // 2) for i in range(401))])
def test_masks(text):
    assert {f for i, f in enumerate("ABCD") if A.text_mask(text.encode()) >> i & 1} == fails(text, False)


def test_polynomial():
    counts = np.random.default_rng(1).integers(0, 1000, (3, 32))
    found = A.Removal(counts, 5)
    for chosen in range(32):
        assert found.removed(chosen).tolist() == counts[:, [m for m in range(32) if m & chosen]].sum(1).tolist()
    assert sum(found.shapley(i) for i in range(5)).tolist() == (120 * found.removed(31)).tolist()  # all is shared out
    x = np.random.default_rng(2).random(5)  # the polynomial is the extension, not only right at corners
    inside = lambda m: np.prod([1 - x[i] for i in range(5) if m >> i & 1])
    want = sum(counts[0, m] * (1 - inside(m)) for m in range(32))
    assert sum(a * np.prod([x[i] for i in range(5) if t >> i & 1]) for t, a in enumerate(found.coefficients[0])) == pytest.approx(want)
