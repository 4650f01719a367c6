"""Personal data in very long texts, and what contexts discover of planted identifiers."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.llm import pii

#: Texts and the number of their base spans. The plain scan of test_brute_force is quadratic in some of them.
LONG = {
    "labels": ("x@" + "a." * 1_000_000 + "b", 1),
    "numbers": ("12345 " * 1_000_000, 0),
    "phones": ("+1 (017) 555-7713 x " * 50_000, 50_000),
    "digits": ("1" * 1_000_000, 0),
    "ats": ("a@" * 300_000, 0),
    "word": ("tel " + "a" * 2_000_000 + " +1 (017) 555-7713", 1),
}


@pytest.mark.parametrize("name", LONG)
def test_long_texts_keep_their_base_spans(spark, name):
    """No text overflows the stack, takes quadratic time or is cut."""
    text, n = LONG[name]
    base = pii.find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().base
    assert len(base) == n
    assert all(text[x.start : x.end].strip() == text[x.start : x.end] for x in base)
    assert not base or base[-1].end >= len(text) - 3


def test_discovery_of_planted_identifiers(spark):
    """Contexts that stand beside seeds find unseen formats, whatever spaces they hold; numbers elsewhere stay alone."""
    rng, rows, planted = random.Random(2), [], {}
    filler = lambda n: " ".join(rng.choice(["river", "stone", "walks", "under", "light"]) + str() for _ in range(n))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    for i in range(60):
        rows.append((i, f"{filler(5)} phone: +1 ({digits(3)}) 555-{digits(4)} today, mail to ann{i}@host{i}.org soon, {filler(4)}"))
    unseen = [
        ("phone", lambda: f"phone {rng.choice('0')}{digits(2)} {digits(3)} {digits(2)} {digits(2)}", "phone "),
        ("phone", lambda: f"phone: ({digits(3)}) {digits(3)}-{digits(4)}", "phone: "),
        ("email", lambda: f"mail to bob{digits(4)}@localhost", "mail to "),
        ("email", lambda: f"mail to bob{digits(4)} [at] example [dot] com", "mail to "),
    ]
    for i in range(40):
        kind, make, lead = unseen[i % len(unseen)]
        hit = make()
        text = f"{filler(3)} {hit}; {filler(3)}"
        start = text.index(hit) + len(lead)
        planted[1000 + i] = f"{kind}:{start}:{text.index(hit) + len(hit)}"
        rows.append((1000 + i, text))
    for i in range(100):
        rows.append((2000 + i, f"{filler(3)} measured {digits(11)} times, order {digits(4)} {digits(4)} {digits(4)}, {filler(2)}"))
    found = {r.doc_id: r.s for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", pii.span_text(F.col("added")).alias("s")).collect()}
    hits = sum(found[i] == s for i, s in planted.items())
    wrong = sum(bool(s) for i, s in found.items() if i not in planted)
    assert hits >= 0.9 * len(planted)
    assert wrong == 0


def test_patterns_with_gaps_tell_apart_what_the_nearest_word_does_not(spark):
    """One word stands before identifiers and before counts; only the words further off differ."""
    rows = [(i, f"as she said her number is +1 (017) 555-77{i:02d}") for i in range(30)]
    rows += [(100 + i, f"then the number she gave is 044 668 18 {i:02d}") for i in range(10)]
    rows += [(200 + i, f"by now the population is 2000{i:02d}11447") for i in range(10)]
    found = {r.doc_id: r.added for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(bool(found[100 + i]) for i in range(10)) >= 9
    assert not any(found[200 + i] for i in range(10))
    assert {pii.KINDS[x.kind] for i in range(10) for x in found[100 + i]} == {"phone"}


def test_patterns_of_a_context(spark):
    """Nearest word, every other word with a gap, three in a row; repeated words once; nothing of an empty context."""
    rows = [(1, "as her number is", "please a a"), (2, "", "x"), (3, None, "")]
    of = lambda c: F.transform(pii.lexical_patterns(F.col(c), c), lambda p: p["pattern"]).alias(c)
    found = spark.createDataFrame(rows, "id int, left string, right string").select("id", of("left"), of("right")).orderBy("id").collect()
    assert found[0].left == ["left is", "left number ... is", "left her ... is", "left as ... is", "left her number is"]
    assert found[0].right == ["right please", "right please ... a", "right please a a"]
    assert (found[1].left, found[1].right) == ([], ["right x"])
    assert (found[2].left, found[2].right) == ([], [])


def test_long_runs_of_marks_beside_a_span(spark):
    """Neither marks nor words have a longest run, and a long run takes no quadratic time."""
    text = "call " + "- " * 500_000 + "a@b.cd" + " ." * 500_000 + " now"
    found = spark.createDataFrame([(text,)], "text string").select(pii.seed_spans(F.col("text")).alias("s")).first().s
    assert [(x.left, x.right) for x in found] == [("call", "now")]


def test_candidates_never_touch_base_spans(spark):
    text = "call +1 (017) 555-7713 12 34 or 4111 1111 1111 1111 9, a@b.cd@localhost 10.0.0.1.22"
    r = spark.createDataFrame([(text,)], "text string").select(pii.seed_spans(F.col("text")).alias("b")).select("b").first().b
    c = spark.createDataFrame([(text,)], "text string").select(pii.candidates(F.col("text"), pii.seed_spans(F.col("text"))).alias("c")).first().c
    assert all(x.end <= y.start or y.end <= x.start for x in c for y in r)
