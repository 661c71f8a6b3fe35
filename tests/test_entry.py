"""The driver's contract, and that the training-data subpackage stays apart."""

import re
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(entry.__file__).resolve().parent


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["paper_id", "score", "rank"] and df.count() == 10


def test_each_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_imports_the_training_data_operators():
    for path in (ROOT / "corvane").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"(from|import)\s+\S*\bllm\b", path.read_text()), path
