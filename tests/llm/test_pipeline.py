"""The pipeline over a whole table, each stage against a plain version on what the one before kept."""

import re
from collections import Counter, defaultdict

import pandas as pd
import pytest

import corpus_pipeline
from eventloom.llm import langid
from tests.compare import SF
from tests.llm.test_brute_force import WORD, brute_contaminated, lower
from tests.llm.test_near_dedup import brute_kept


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Rows after each stage."""
    out, docs = {"documents": spark.read.parquet(f"{SF}/documents.parquet")}, spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp('stages')}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return {name: df.toPandas() for name, df in out.items()}


def texts(df):
    return dict(zip(df.doc_id, df.text))


def test_language_id(spark, kept):
    judged = {r.doc_id: r.lang_pred != "und" and r.score >= 0.5 for r in langid.identify_languages(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert set(kept["language_id"].doc_id) == {i for i, good in judged.items() if good}


def test_line_dedup(kept):
    before, after = kept["language_id"], texts(kept["line_dedup"])
    pages = {(s, t) for s, t in zip(before.source, before.text)}
    of_host, holders = Counter(s for s, _ in pages), Counter((s, x) for s, t in pages for x in set(t.split("\n")) if WORD.search(x))
    lost = {key for key, n in holders.items() if n >= 3 and n > 0.1 * of_host[key[0]]}
    assert after == {i: "\n".join(x for x in t.split("\n") if (s, x) not in lost) for i, s, t in zip(before.doc_id, before.source, before.text)}
    assert lost


def test_near_dedup(kept):
    before = texts(kept["line_dedup"])
    assert set(kept["near_dedup"].doc_id) == brute_kept(before)
    assert len(kept["near_dedup"]) < len(before)


def test_decontamination(kept):
    items = [t for t in pd.read_parquet(f"{SF}/benchmark.parquet").text if t and t.split()]
    shingles = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (lower(t).split() for t in items)]
    hit = set()
    for i, t in texts(kept["near_dedup"]).items():
        w = re.split("[ \t\n\x0b\f\r]+", lower(t))
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        if any(own & s and brute_contaminated(t, item) >= 0.8 for s, item in zip(shingles, items)):
            hit.add(i)
    assert set(kept["decontamination"].doc_id) == set(kept["near_dedup"].doc_id) - hit
    assert hit


def test_packing(kept):
    rows, docs = kept["packing"], texts(kept["decontamination"])
    ends, sizes = defaultdict(int), {}
    for r in rows.sort_values(["doc_id", "start"]).itertuples():
        assert r.start == ends[r.doc_id]
        ends[r.doc_id] += r.length
        sizes[r.doc_id] = r.doc_tokens
    assert ends == sizes and set(sizes) == set(docs)
    for _, pieces in rows.sort_values("offset").groupby("sequence_id"):
        assert pieces.offset.tolist() == [0, *pieces.length.cumsum().tolist()[:-1]] and pieces.length.sum() <= 2048
