import re

import pytest

from corvane.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(low)
    starts, labels = [], set()
    for phrase, label in L.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_whole_table_against_brute_force(few_docs, spark):
    more = spark.createDataFrame([(9001, "MIT License, mit-license MIT\nLICENSE. Apache  License x general public license", "en", "s", 1), (9002, "mit license émit license", "en", "s", 1)], few_docs.schema)
    docs = few_docs.unionByName(more)
    rows = {r["doc_id"]: r for r in L.scan_licenses(docs).collect()}
    for d in docs.collect():
        r = rows[d["doc_id"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(d["text"])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


@pytest.mark.parametrize(
    ("expression", "postfix", "allowed"),
    [
        ("MIT", ["MIT"], True),
        ("GPL-3.0 OR MIT", ["GPL-3.0", "MIT", "or"], True),
        ("GPL-3.0 AND MIT", ["GPL-3.0", "MIT", "and"], False),
        ("GPL-2.0-only WITH Classpath-exception-2.0 OR Apache-2.0 AND MIT", ["GPL-2.0-only", "Classpath-exception-2.0", "with", "Apache-2.0", "MIT", "and", "or"], True),
        ("(GPL-2.0 OR MIT) AND (LGPL-3.0)", ["GPL-2.0", "MIT", "or", "LGPL-3.0", "and"], False),
        ("MIT and other prose that follows", ["MIT", "other", "and"], False),
    ],
)
def test_expressions(expression, postfix, allowed):
    assert L.shunting_yard(L.TOKEN.findall(expression)) == postfix
    assert L.evaluate(postfix) is allowed


def test_damaged_expressions():
    for text in ("", ")", "AND MIT", "(", "( MIT"):
        assert L.shunting_yard(L.TOKEN.findall(text)) is None
    assert L.shunting_yard(L.TOKEN.findall("MIT OR")) == ["MIT"]


def test_tag_in_text():
    row = L.scan_text("# SPDX-License-Identifier: (GPL-2.0 WITH Linux-syscall-note) OR BSD-3-Clause\ncode", L.build_automaton())
    assert row["labels"] == "bsd,gpl" and row["permitted"] is True and row["n_base"] == 0
    assert L.scan_text("the SPDX license identifier is a tag", L.build_automaton())["expressions"] == []


def test_edges(edge_docs, no_docs):
    out = L.scan_licenses(edge_docs).collect()
    assert len(out) == 9 and all(r["score"] == 0 for r in out) and L.scan_licenses(no_docs).count() == 0


def test_long_expressions_are_read_whole():
    patterns = L.build_automaton()
    many = " OR ".join(["MIT", "Apache-2.0"] * 400)
    row = L.scan_text(f"SPDX-License-Identifier: ({many}) AND GPL-3.0\nISC", patterns)
    assert row["labels"] == "apache,gpl,mit" and row["permitted"] is False and row["expressions"][0].count(" ") == 800 * 2
    row = L.scan_text(f"SPDX-License-Identifier: ({many} OR MPL-2.0)", patterns)
    assert row["labels"] == "apache,mit,mpl" and row["permitted"] is True and row["score"] == pytest.approx(L.TAG_WEIGHT)


def test_long_lines_take_linear_time():
    for line in (" and ".join(["MIT"] * 100_000), "(MIT or " * 100_000 + "MIT" + ")" * 100_000, "(" * 200_000, "SPDX-License-Identifier: MIT " * 20_000, "MIT" + " !" * 200_000):
        L.scan_text("SPDX-License-Identifier: " + line, L.build_automaton())
    assert L.licences_in(["A", "B", "with", "C", "D", "with", "E", "or", "and"]) == ["a", "c", "e"]


def test_all_labels_of_a_whole_table_equal_a_plain_scan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    notices = [("spdx-license-identifier: (MIT or GPL-3.0-only) and Apache-2.0", 1), ("Licensed under CC BY-SA 4.0, all rights reserved", 2), ("redistribution and use in source and binary forms; ISC license", 3), ("License-Expression = EPL-2.0 with Classpath-exception-2.0", 4)]
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    rows += [(10**6 + k, f"{t[:200]} {notice} {t[200:400]}") for (k, (_, t)), (notice, _) in zip(enumerate(rows[:40]), notices * 10)]
    got = {r["doc_id"]: r for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    phrases = L.BASE_PHRASES | {p: label for p, (label, _) in L.NOTICE_PHRASES.items()}
    for doc, text in rows:
        words = f" {' '.join(re.findall(r'[0-9a-z\x80-\U0010ffff]+', re.sub('[A-Z]', lambda m: m.group().lower(), text)))} "
        want = {label for p, label in phrases.items() if f" {p} " in words}
        for line in re.split("(?i)(?=spdx-license-identifier|license-expression)", text)[1:]:
            found = re.match(r"[A-Za-z-]+[ \t\"']*[:=]([^\n]*)", line)
            tokens = re.findall(r"[A-Za-z0-9][A-Za-z0-9.+-]*|[()]", found[1]) if found else []
            for k, t in enumerate(tokens):  # the made lines above end where a word follows a word
                if k and t not in "()" and tokens[k - 1] not in "()" and t.lower() not in L.PRECEDENCE and tokens[k - 1].lower() not in L.PRECEDENCE:
                    break
                if t not in "()" and t.lower() not in L.PRECEDENCE and (not k or tokens[k - 1].lower() != "with"):
                    want.add(L.family(t))
        assert set(filter(None, got[doc]["labels"].split(","))) == want, text
