"""Stretches that share an anchor: how they are dealt to tasks, and how what is found of them is carried."""

import hashlib

from eventloom.llm import suffixes
from eventloom.llm.repeats import named_texts, repeated_segments
from tests.llm import odd


def test_counted_windows_are_carried_as_runs(spark, monkeypatch):
    """Near copies whose shared anchors are too large to be sorted in a task: neighbouring windows come as one run, not one each."""
    body = "".join(f"{(i * 7919) % 9973:04d}," for i in range(300))
    docs = odd.docs(spark, [(i, f"{body[: 400 + 40 * i]} own {i} {i * i}" + body[400 + 40 * i :], "en", "a", 0) for i in range(12)], clashing=False)
    resolved = {}
    monkeypatch.setattr(suffixes, "GROUP", 1)
    monkeypatch.setattr(suffixes, "remove_repeats", lambda docs, unit, resolve: resolved.update(runs=resolve(named_texts(docs), repeated_segments(named_texts(docs), unit))))
    suffixes.suffix_dedup(docs)
    rows = [sorted((r["low"], r["high"]) for r in x.runs) for x in resolved["runs"].collect()]
    assert rows and any(high > low for runs in rows for low, high in runs)
    assert all(a[1] + 1 < b[0] for runs in rows for a, b in zip(runs, runs[1:]))
    found = {}
    monkeypatch.undo()
    for size in (1, suffixes.GROUP):
        monkeypatch.setattr(suffixes, "GROUP", size)
        found[size] = sorted(tuple(r) for r in suffixes.suffix_dedup(docs).collect())
    assert len(set(map(tuple, found.values()))) == 1


def test_stretches_of_an_anchor_meet_in_one_task(spark, monkeypatch):
    """Pairs of different documents with a passage in common, and one passage of many that is counted: every passage is found."""
    monkeypatch.setattr(suffixes, "GROUP", 2000)
    noise = lambda *key: "".join(hashlib.sha256(f"{key} {k}".encode()).hexdigest() for k in range(5))
    rows = [(2 * g + side, f"{noise(g, side)}{'xy'[side]}{noise(g)[:300]}{'vw'[side]}{noise(side, g, 1)}", "en", "a", 0) for g in range(150) for side in (0, 1)]
    rows += [(1000 + i, f"{noise(999, i)}{chr(97 + i)}{noise(999)[:300]}{chr(97 + i)}{noise(i, 999, 1)}", "en", "a", 0) for i in range(20)]
    docs = odd.docs(spark, rows, clashing=False).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with much data: more than one partition
    try:
        found = {(r.doc_id, r.n_removed) for r in suffixes.suffix_dedup(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {(r[0], 300) for r in rows}
