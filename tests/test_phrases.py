"""Country patterns and transliteration against plain versions."""

import random
import re
import time
import unicodedata
from functools import lru_cache

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom.functions import text
from eventloom.functions.phrases import BOUNDARY, Phrases, chosen_phrase
from eventloom.operators import actors
from tests.compare import SF


compiled = lru_cache(None)(re.compile)


def plain_choice(value, patterns, method):
    """Every pattern tried by itself."""
    if not value:
        return None, value
    found = []
    for pattern, code in patterns:
        if m := compiled(pattern).search(value):
            found.append((code, re.sub(r" +", " ", compiled(pattern).sub("", value).strip()).strip(), m.start()))
    if not found:
        return None, value
    return min(found, key=(lambda f: len(f[1])) if method == "longest" else (lambda f: f[2]))[:2]


WORDS = ["an", "ana", "nan", "US", "USA", "U.S.", "[Ba]r", "Niger", "Nigeria", "a", "  ", "Isle (Big)"]
PARTS = st.sampled_from([*WORDS, "Isle Big", " ", "x", "n", "B", "\n", "é", "'", "U-S-"])


@settings(max_examples=600, deadline=None)
@given(st.lists(PARTS, max_size=12), st.lists(st.tuples(st.sampled_from(WORDS), st.booleans()), max_size=8), st.sampled_from(["longest", "first"]))
def test_choice_is_that_of_single_patterns(parts, chosen, method):
    patterns = tuple((w + BOUNDARY * bounded, f"{k}") for k, (w, bounded) in enumerate(chosen))
    value = "".join(parts)
    assert chosen_phrase(value, patterns, method) == plain_choice(value, patterns, method)


def _dictionary(n):
    rng = random.Random(n)
    syllables = ["ka", "lo", "mi", "ren", "tu", "sha", "vor", "el", "ni", "gar"]
    return [("".join(rng.choices(syllables, k=3)).title() + BOUNDARY * (k % 2), f"C{k}") for k in range(n)]


@pytest.mark.parametrize("method", ["longest", "first"])
def test_whole_table(spark, method):
    """All documents, hundreds of patterns (words of the benchmark): as if each pattern were tried by itself."""
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = sorted({w for t in items for w in re.findall(r"[A-Za-z]{4,}", t)})[:764]
    patterns = tuple((w + BOUNDARY * (k % 3 > 0), f"C{k}") for k, w in enumerate(words))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = actors.find_country(docs, list(patterns), method).withColumn("plain", text.fold_accents(F.col("text"))).collect()
    for r in found:
        assert (r.country, r.rest) == plain_choice(r.plain, patterns, method)
    assert sum(r.country is not None for r in found) > 50


def test_time_does_not_follow_the_number_of_patterns():
    rng = random.Random(1)
    words = [p.removesuffix(BOUNDARY) for p, _ in _dictionary(764)]
    texts = [" ".join(rng.choice(words) if rng.random() < 0.1 else "word" for _ in range(20)) for _ in range(4000)]

    def seconds(n):
        phrases = Phrases(tuple(_dictionary(764)[:n]))
        best = []
        for _ in range(3):
            began = time.process_time()
            for t in texts:
                phrases.spans(t)
            best.append(time.process_time() - began)
        return min(best)

    assert seconds(764) < 3 * seconds(13) + 0.02


def test_every_covered_character(spark):
    table = text.transliterations()
    assert len(table) > 900
    rows = spark.createDataFrame([(c, f"a{c}b {c}{c}") for c in table], "c string, x string")
    for r in rows.select("c", text.fold_accents(F.col("x")).alias("y")).collect():
        assert r.y == f"a{table[r.c]}b {table[r.c]}{table[r.c]}", r.c
    for c, to in table.items():
        assert to.isascii()
        plain = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))
        if len(plain) == 1 and plain.isascii():
            assert to == plain


@pytest.mark.parametrize(
    ("given_text", "expected"),
    [("Łódź Ørsted Straße Đà Nẵng Æthel Þór", "Lodz Orsted Strasse Da Nang AEthel Thor"), ("Київ Чайковский Щукин Королёв", "Kiyiv Chaikovskii Shchukin Koroliov"), ("Ελλάδα Αθήνα Θεσσαλονίκη", "Ellada Athena Thessalonike"), ("People’s “Front” – x…", "People's \"Front\" - x..."), ("漢字", "漢字"), ("", ""), (None, None)],
)
def test_transliteration(spark, given_text, expected):
    assert spark.createDataFrame([(given_text,)], "x string").select(text.fold_accents(F.col("x")).alias("y")).first().y == expected


def test_pattern_in_other_letters(spark):
    rows = spark.createDataFrame([(1, "the People’s Republic of China’s navy"), (2, "Côte d’Ivoire"), (3, None)], "id int, text string")
    found = {r.id: (r.country, r.rest) for r in actors.find_country(rows, [("People's Republic of China", "CHN"), ("Cote d'Ivoire", "CIV")]).collect()}
    assert found == {1: ("CHN", "the 's navy"), 2: ("CIV", ""), 3: (None, None)}


def test_each_text_of_a_batch_is_read_once(monkeypatch, spark):
    """One batch of 1,000 rows with three texts makes three lookups; the kernel folds as the column expression does."""
    seen = []
    monkeypatch.setattr(F, "arrow_udf", lambda _: lambda kernel: seen.append(kernel) or (lambda _: F.struct(F.lit("a").alias("country"), F.lit("b").alias("rest"))))
    actors.find_country(spark.createDataFrame([("x",)], "text string"), [("Ghana", "GHA")])
    calls = []
    monkeypatch.setattr(actors, "chosen_phrase", lambda t, patterns, method: calls.append(t) or (None, t))
    out = seen[0](pa.array(["Accra, Ghana", "é", None, "x"] * 250)).to_pylist()
    assert sorted(calls, key=str) == ["Accra, Ghana", "e", "x"]
    assert [(r or {}).get("rest") for r in out[:4]] == ["Accra, Ghana", "e", None, "x"]


def test_kernel_folds_as_the_expression(spark):
    texts = ["plain", "Łódź é 漢字 Чайковский – x…", "".join(chr(c) for c in [*range(32, 0x2100), *range(0xFE20, 0xFE30)] if unicodedata.category(chr(c)) != "Cn"), "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    for r in rows.select("x", text.fold_accents(F.col("x")).alias("a"), text.fold_texts(F.col("x")).alias("b")).collect():
        assert r.a == r.b
