"""Pages of very many lines, conversations of very many turns, labelled rows with few different ids."""

import time

from pyspark.sql import functions as F

from eventloom.llm import chat, langid, linededup
from tests.llm import odd


def test_pages_of_many_lines(spark):
    """Ten pages of 100,000 lines, a third of them the host's: each line is looked up in logarithmic time."""
    page = lambda i: "\n".join(f"menu {k}" if k % 3 == 0 else f"own {i} {k}" for k in range(100_000))
    rows = [(i, page(i), "en", "a", 0) for i in range(4)]
    began = time.time()
    found = linededup.drop_boilerplate(odd.docs(spark, rows, clashing=False)).select("n_lines", "n_dropped", F.length("kept_text").alias("n")).collect()
    assert {(r.n_lines, r.n_dropped) for r in found} == {(100_000, 33_334)}
    assert time.time() - began < 90


def test_conversations_of_many_turns(spark):
    rows = spark.range(200_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("turn "), "id").alias("text"))
    began = time.time()
    read = chat.read_back(*chat.format_forest(rows)).collect()
    assert [(r.conv_id, r.n_turns) for r in read] == [(1, 200_000)]
    assert time.time() - began < 120


def test_rows_without_conversation_stand_alone(spark):
    rows = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    read = sorted((str(r.conv_id), r.n_turns, r.loss_chars) for r in chat.read_back(*chat.format_forest(rows)).collect())
    assert read == [("3", 2, 1), ("None", 1, 0), ("None", 1, 1)]


def test_sample_survives_repeated_rows(spark):
    """Many labelled rows of few different ids and texts: whatever their hashes, they are learned from."""
    rows = [(i % 2, ("the cat sat on the mat and looked " if i % 2 else "el gato negro duerme en la casa ") * 4, "en" if i % 2 else "es", "a", 0) for i in range(3000)]
    shape = langid.Shape(train_rows=20, epochs=2)
    for shift in range(4):
        docs = odd.docs(spark, [(10 * shift + r[0], *r[1:]) for r in rows], clashing=False)
        net = langid.train(docs, shape)
        assert net is not None
