"""Decontamination against all windows and all items, and with many items of one length."""

import random
import resource
import time

import numpy as np
import pytest

from eventloom.llm import decontaminate
from eventloom.llm.decontaminate import Benchmark, HammingIndex
from tests.llm.test_brute_force import brute_contaminated


def test_all_windows_without_any_filter(spark):
    """Texts of few different words, so that windows repeat items in part all over; items of 1 to 30 words."""
    rng = random.Random(4)
    word = lambda: rng.choice("aa bb cc dd ee ff gg".split())
    items = {k: " ".join(word() for _ in range(rng.randint(1, 30))) for k in range(30)}
    texts = {}
    for i in range(40):
        words = [word() for _ in range(rng.randint(0, 80))]
        for k in rng.sample(sorted(items), 3):
            copy = items[k].split()
            if len(copy) > 10:
                copy[rng.randrange(len(copy))] = word()
            at = rng.randint(0, len(words))
            words[at:at] = copy
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    expected = {(i, k): s for i, t in texts.items() for k, item in items.items() if (s := brute_contaminated(t, item)) >= 0.8}
    assert found == pytest.approx(expected)
    assert any(len(items[k].split()) < 5 for _, k in expected) and any(s < 1 for s in expected.values())


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    probes = np.concatenate([prints[:50] ^ sum(np.uint64(1) << rng.integers(0, 63, 50, dtype=np.uint64) for _ in range(d)) for d in (1, 10, 18)])
    found = {(i, j) for a, b, _ in HammingIndex(prints, 20).near(probes) for i, j in zip(a.tolist(), b.tolist())}
    assert found == {(i, j) for i, p in enumerate(probes) for j in np.flatnonzero(np.bitwise_count(prints ^ p) <= 20).tolist()}


def test_many_items_of_one_length():
    """20,000 items of 60 words that share a phrase, and a long text full of that phrase: time and memory stay with the matches."""
    phrase = "of the course of a"
    items = [(k, f"{phrase} {' '.join(f'w{k}x{i}' for i in range(55))}".encode()) for k in range(20_000)]
    benchmark = Benchmark(items, 5, 20, 0.8)
    text = " ".join([f"{phrase} t{i}" for i in range(20_000)] + [items[77][1].decode()] + [f"u{i}" for i in range(10_000)])
    began = time.time()
    assert [(k, round(s, 6)) for k, _, s, _ in benchmark.matches(text.encode())] == [(77, 1.0)]
    assert time.time() - began < 20
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss < 3_000_000
