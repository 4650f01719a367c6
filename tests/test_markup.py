"""Bracket pairs of markup against a plain stack, and what is read of pages."""

import random
import time

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from eventloom.functions.markup import Texts, covered, outermost, read_pages


def stacked(text: str, opening: str, closing: str) -> list[tuple[int, int]]:
    """The outermost pairs of one text, by a stack over its characters."""
    stack, pairs, i = [], [], 0
    while i < len(text):
        if text.startswith(opening, i):
            stack.append(i)
            i += 2
        elif text.startswith(closing, i):
            if stack:
                pairs.append((stack.pop(), i + 2))
            i += 2
        else:
            i += 1
    return [(a, b) for a, b in sorted(pairs) if not any(c < a and b < d for c, d in pairs)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("{}|é\n[]", max_size=14), max_size=6))
def test_pairs_are_those_of_a_stack(texts):
    joined = Texts.join([t.encode() for t in texts])
    for opening, closing in (("{{", "}}"), ("[[", "]]")):
        starts, ends = outermost(joined, opening.encode(), closing.encode())
        kept = joined.without(covered(joined, starts, ends)).column().to_pylist()
        expected = []
        for t in texts:
            for a, b in reversed(stacked(t, opening, closing)):
                t = t[:a] + t[b:]
            expected.append(t)
        assert kept == expected


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("=\nxé", max_size=10), max_size=5))
def test_before_a_heading(texts):
    assert Texts.join([t.encode() for t in texts]).before(b"\n==").column().to_pylist() == [t.split("\n==")[0] for t in texts]


def test_introduction_without_pictures_tables_and_templates():
    page = "[[File:x.jpg|thumb|The [[cat]] here]]\n{| class=x\n|-\n| a\n{|\n| b\n|}\n|}\nA {{x|{{y}}}}'''B''' [[c|d]].\n== H ==\n{{Infobox late|k=v}}"
    kinds, fields, intros = read_pages(pa.array([page, None, "", "{{open [[x]] {{Infobox  a|k = {{u|w}} [[p|q]] | empty= |no}} text }}"]))
    assert intros.to_pylist() == ["\n\nA '''B''' [[c|d]].", "", "", ""]
    assert kinds[:3] == ["late", None, None] and fields[:3] == [[("k", "v")], [], []]
    assert kinds[3] is None  # an infobox inside another template is none


def test_a_bracket_without_partner_is_text():
    kinds, fields, intros = read_pages(pa.array(["a {{ b {{Infobox x|k={{u|w}} [[p|q]]|empty=|no|m=[[z}} c", "]] }} d {{e}}", "{{ Infobox y|a=1}}{{" + " " * 60 + "infobox z|b=2}}"]))
    assert intros.to_pylist() == ["a {{ b  c", "]] }} d ", ""]
    assert (kinds, fields) == (["x", None, "y"], [[("k", "{{u|w}} [[p|q]]"), ("m", "[[z")], [], [("a", "1")]])


def test_a_sliced_column_and_an_empty_one():
    column = pa.array(["{{Infobox a|k=1}}x", None, "{{Infobox b|k=2}}y", "z"]).slice(1, 3)
    kinds, _, intros = read_pages(column)
    assert (kinds, intros.to_pylist()) == ([None, "b", None], ["", "y", "z"])
    assert read_pages(pa.array([], pa.string()))[2].to_pylist() == []


def test_a_very_long_page_takes_under_a_second():
    rng = random.Random(1)
    page = "{{Infobox x|name=n}}" + "".join(rng.choice(["{{cite|a={{b}}}} ", "[[c|d]] ", "word ", "é "]) for _ in range(700_000))
    assert len(page.encode()) > 4 << 20
    began = time.time()
    kinds, _, _ = read_pages(pa.array([page]))
    assert time.time() - began < 1
    assert kinds == ["x"]


def test_pages_of_a_small_file_are_dealt_to_all_tasks(spark):
    from eventloom.operators.knowledge import build_knowledge_base

    pages = spark.createDataFrame([(f"t{i}", "text") for i in range(20)], "title string, text string").coalesce(1)
    plan = build_knowledge_base(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [title" in plan.split("MapInArrow")[1]
