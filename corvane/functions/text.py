"""Text functions as Spark columns, and the fixed prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prompts that vectors were made with; a query must use the one of its documents.
PROMPTS = {
    "query_with_passage": "Instruct: Given a web search query, retrieve relevant passages that answer the query\nQuery:",
    "query_with_title": "Instruct: Given a web search query, retrieve relevant titles that answer the query\nQuery:",
    "query_with_abstract": "Instruct: Given a web search query, retrieve relevant abstracts that answer the query\nQuery:",
    "query_with_arxiv_paper_abstract": "Instruct: Given a web search query, retrieve relevant arxiv paper abstracts that answer the query\nQuery:",
    "query_with_arxiv_paper_title": "Instruct: Given a web search query, retrieve relevant arxiv paper titles that answer the query\nQuery:",
    "title": "Title: ",
    "document": "Passage: ",
    "abstract": "Abstract: ",
    "arxiv_paper_abstract": "Arxiv Paper Abstract: ",
    "arxiv_paper_title": "Arxiv Paper Title: ",
}
SEARCH_PROMPTS = {"title": "query_with_title", "abstract": "query_with_abstract", "combined": "query_with_passage"}


def one_line(text: Column) -> Column:
    """Line feeds become spaces; nothing is trimmed."""
    return F.replace(text, F.lit("\n"), F.lit(" "))


def prompted(prompt: str | None, text: Column, separator: str = "") -> Column:
    """A prompt of the catalog before the text; an unknown or missing name leaves the text alone."""
    start = PROMPTS.get(prompt or "", "")
    return F.concat(F.lit(start + separator), text) if start else text


def instruct(task: str, query: Column) -> Column:
    return F.concat(F.lit(f"Instruct: {task}\nQuery: "), query)


def shortened(text: Column, most: int, mark: str = "...") -> Column:
    """At most ``most`` characters, and the mark after a longer text."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit(mark))).otherwise(text)


def shortened_within(text: Column, most: int, mark: str = "...") -> Column:
    """At most ``most`` characters including the mark."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most - len(mark))), F.lit(mark))).otherwise(text)


def word_count(text: Column) -> Column:
    """Length in words between white space; 0 for null and empty texts."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` of ``whole`` as text with a percent sign; ``0%`` of nothing."""
    return F.when(whole > 0, F.format_string(f"%.{digits}f%%", F.lit(100.0) * part / whole)).otherwise(F.lit("0%"))


def file_stem(query: Column, most: int = 20) -> Column:
    """A file name from a query: spaces as underscores, cut."""
    return F.left(F.replace(query, F.lit(" "), F.lit("_")), F.lit(most))


def run_name(prefix: str, at: Column, suffix: str = ".parquet") -> Column:
    """``prefix`` with a time stamp, as runs name their files."""
    return F.concat(F.lit(prefix + "_"), F.date_format(at, "yyyyMMdd_HHmmss"), F.lit(suffix))
