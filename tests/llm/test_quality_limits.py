"""Limits of the quality signals come from the group's distribution."""

from eventloom.llm import quality
from tests.llm import odd


def test_repeated_lines_are_held_against_the_group(spark):
    """A page of 40 lines of ten words, one of them five times, falls where no other page repeats a line, and stays where all do."""
    line = lambda k, j: " ".join(f"{chr(97 + j % 26)}{k}x{i}j{j}" for i in range(10))
    once = lambda k: "\n".join(line(k, j) for j in range(40))
    twice = lambda k: "\n".join(line(k, j) if j > 4 else line(k, 0) for j in range(40))
    rows = [(k, once(k % 10), "en", "a", 0) for k in range(200)] + [(1000 + k, twice(k % 10), "en", "b", 0) for k in range(200)]
    rows.append((5000, twice(3), "en", "a", 0))
    kept = {r.doc_id: r.kept for r in quality.judge_quality(odd.docs(spark, rows)).collect()}
    assert not kept[5000] and sum(kept.values()) == 400
