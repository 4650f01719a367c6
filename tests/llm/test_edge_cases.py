"""Nulls, empty tables, repeated rows, long texts and clashing column names for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import chat, decontaminate, langid, linededup, packing, pii, quality, simhash, substrings, suffixes
from tests.llm import odd

ITEMS = [(1, odd.TEXT), (2, None), (None, "x"), (3, "")]


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


OPERATORS = {
    "simhash": lambda d: simhash.simhash_components(d),
    "keep_one": lambda d: simhash.keep_one_per_class(d),
    "packing": lambda d: packing.harmonic_pack(d, tokenizer()),
    "quality": lambda d: quality.judge_quality(d),
    "langid": lambda d: langid.identify_languages(d),
    "keep_identified": lambda d: langid.keep_identified(d),
    "pii": lambda d: pii.find_personal_data(d),
    "suffixes": lambda d: suffixes.suffix_dedup(d),
    "substrings": lambda d: substrings.substring_dedup(d),
    "contaminated": lambda d: decontaminate.contaminated(d, items(d.sparkSession)),
    "drop_contaminated": lambda d: decontaminate.drop_contaminated(d, items(d.sparkSession)),
    "linededup": lambda d: linededup.drop_boilerplate(d),
}
ONE_ROW_EACH = ["simhash", "quality", "langid", "pii", "suffixes", "substrings", "linededup"]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](odd.docs(spark, [])).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    rows = OPERATORS[name](odd.docs(spark)).collect()
    if name in ONE_ROW_EACH:
        assert sorted((r.doc_id for r in rows), key=str) == sorted((r[0] for r in odd.ROWS), key=str)


def test_odd_values(spark):
    docs = odd.docs(spark)
    classes = {r.doc_id: r.component_id for r in OPERATORS["simhash"](docs).collect()}
    assert classes[1] == classes[2] == 1 and classes[3] == classes[4] == classes[5] == 3
    packed = OPERATORS["packing"](docs)
    assert {r.doc_id for r in packed.where("doc_tokens = 1").collect()} == {None, 3, 4, 5}
    removed = {r.doc_id: (r.n_units, r.n_removed) for r in OPERATORS["substrings"](docs).where("doc_id is not null").collect()}
    assert removed[2] == (60, 60) and removed[3] == (0, 0)
    languages = {r.doc_id: r.lang_pred for r in OPERATORS["langid"](docs).where("doc_id is not null").collect()}
    assert languages[3] == languages[5] == languages[9] == "und"
    assert {r.doc_id for r in OPERATORS["contaminated"](docs).collect()} == {1, 2, None}
    kept = {r.doc_id for r in OPERATORS["keep_one"](docs).collect()}
    assert 1 in kept and 2 not in kept and {3, 4, 5} <= kept


def test_stages(spark, tmp_path):
    """Each stage takes what the last one kept and returns the same columns, values unchanged but for line dedup's text."""
    items(spark).where("item_id = 1").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd.docs(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
        assert docs.columns == columns, name
        assert {r.page for r in docs.collect()} <= {"own page"}, name
    assert {r.doc_id for r in docs.collect()} >= {6, 8}
    assert not {1, 2, 3, 4, 5, 9} & {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, tmp_path, name):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert dict(corpus_pipeline.STAGES)[name](spark, odd.docs(spark, []), str(tmp_path)).count() == 0


def test_boilerplate_needs_share_and_pages(spark):
    rows = [(i, f"menu\nown line {i}\n\n", "en", "a", 0) for i in range(10)] + [(50, "menu\nx", "en", "b", 0)]
    kept = {r.doc_id: r.kept_text for r in linededup.drop_boilerplate(odd.docs(spark, rows, clashing=False)).collect()}
    assert kept[3] == "own line 3\n\n" and kept[50] == "menu\nx"


def test_copies_are_one_page(spark):
    rows = [(i, "same page\nsecond line", "en", "a", 0) for i in range(20)]
    assert {r.n_dropped for r in linededup.drop_boilerplate(odd.docs(spark, rows, clashing=False)).collect()} == {0}


def _chat(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_forest(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (2, 2, "user", "why"), (3, 0, "user", "hi"), (3, 1, "assistant", "yes"), (4, 0, "user", "else")]
    forest, members = chat.format_forest(_chat(spark, rows))
    nodes = {r.node: r for r in forest.collect()}
    of = {r.conv_id: nodes[r.node] for r in members.collect()}
    assert of[1].node == of[3].node and len(nodes) == 3
    assert "".join(n.chunk for n in nodes.values()).count("hi") == 1
    ends = sorted((n.start, n.start + n.length) for n in nodes.values())
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    for n in nodes.values():
        assert n.position == sum(a.end - a.start for a in n.ancestors)
        assert n.length == len(n.chunk)


def test_chat_oddities(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "<|im_end|>\n<|x"), (None, 0, "a\nb", "<||"), (2, 0, "assistant", ""), (3, 5, "assistant", "😀 " * 50_000)]
    read = {r.conv_id: r for r in chat.read_back(*chat.format_forest(_chat(spark, rows).withColumn("node", F.lit(1)).withColumn("path", F.lit("x")))).collect()}
    assert {k: r.n_turns for k, r in read.items()} == {1: 3, None: 1, 2: 1, 3: 1}
    assert read[3].loss_chars == 100_000 and read[2].loss_chars == 0
    assert chat.read_back(*chat.format_forest(_chat(spark, []))).count() == 0


@pytest.mark.parametrize("text", ["", "<|", "<||", "<|||im_end|>", "<|im_start|>x", "<", "|>", "<|<|"])
def test_escaping_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|im" not in chat.escape(text)


def test_near_copies_leave_one(spark):
    """Copies of one text that differ in a word or two go, whichever of them is least stays; other texts stay."""
    words = [f"w{i * 7919 % 1009}" for i in range(300)]
    rows = [(100 + k, " ".join([*words[: 10 * k], f"new{k}", *words[10 * k + 1 :]]), "en", "a", 0) for k in range(20)]
    rows += [(200 + k, " ".join(f"own{k}x{i}" for i in range(300)), "en", "a", 0) for k in range(5)]
    kept = {r.doc_id for r in simhash.keep_one_per_class(odd.docs(spark, rows)).collect()}
    assert {200, 201, 202, 203, 204, 100} <= kept and len(kept) <= 7


def test_similarity_decides(spark):
    """Fingerprints may be near by chance: below the similarity a document stays."""
    a = " ".join(f"t{i}" for i in range(100))
    b = " ".join(f"t{i}" if i % 8 else f"u{i}" for i in range(100))
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    pairs = spark.createDataFrame([(2, 1)], "a long, b long")
    assert simhash.similar_pairs(pairs, docs, 5, 0.8).count() == 0
    assert simhash.similar_pairs(pairs, docs, 5, 0.2).count() == 1


def test_predictions_replace_columns_of_their_names(spark):
    """score and lang_pred of the input don't stand beside those of the prediction."""
    from eventloom.llm import langid

    docs = spark.createDataFrame([("x", 1, "some text", 2)], "score string, lang_pred int, text string, other int")
    found = langid.predict(docs, None)
    assert found.columns == ["text", "other", "lang_pred", "score"]
    assert found.select("lang_pred", "score").first() == ("und", 0.0)
