"""The pipeline's near-duplicate stage against all pairs."""

import random
from collections import defaultdict

from eventloom.llm import simhash
from tests.llm import odd
from tests.llm.test_brute_force import brute_fingerprint


def brute_kept(texts, threshold=0.8):
    """Ids that stay: the least of each class under all pairs within 3 bits or of that similarity."""
    words = {i: t.lower().split() for i, t in texts.items() if t and t.split()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} for i, w in words.items()}
    prints = {i: brute_fingerprint(texts[i]) for i in sets}
    shared, holders = defaultdict(int), defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            for j in holders[s]:
                shared[j, i] += 1
            holders[s].append(i)
    group = {i: i for i in texts}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    pairs = [(a, b) for (a, b), n in shared.items() if n >= threshold * (len(sets[a]) + len(sets[b]) - n)]
    pairs += [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        group[b] = a
    return {i for i in texts if root(i) == i}


def kept(spark, texts):
    rows = [(i, t, "en", "a", 0) for i, t in texts.items()]
    return {r.doc_id for r in simhash.keep_one_per_class(odd.docs(spark, rows)).collect()}


def test_all_pairs_of_variants(spark):
    """A crowded group whose members are near others, but seldom the same one, beside texts that share a long passage without being near."""
    rng = random.Random(5)
    texts, line = {}, [f"w{i}" for i in range(120)]
    for k in range(80):  # a line of variants, each near the last few alone
        line = list(line)
        line[rng.randrange(120)] = f"v{k}"
        line[rng.randrange(120)] = f"u{k}"
        texts[rng.randrange(10**6)] = " ".join(line)
    star = [f"s{i}" for i in range(60)]
    for k in range(60):
        changed = [f"c{k}x{i}" if i in set(rng.sample(range(60), rng.randint(1, 3))) else w for i, w in enumerate(star)]
        texts[10**6 + k] = " ".join(changed)
    passage = [f"p{i}" for i in range(70)]
    for k in range(40):
        texts[2 * 10**6 + k] = " ".join(passage + [f"o{k}x{i}" for i in range(k)])
    texts |= {3 * 10**6: "a b", 3 * 10**6 + 1: "A  B", 3 * 10**6 + 2: "a b c"}
    assert kept(spark, texts) == brute_kept(texts)


def compared(monkeypatch):
    """Fills up with the number of pairs of each round whose texts are compared."""
    counts, exact = [], simhash.similar_pairs

    def counted(pairs, *args):
        counts.append(pairs.count())
        return exact(pairs, *args)

    monkeypatch.setattr(simhash, "similar_pairs", counted)
    return counts


def test_group_of_near_copies_is_compared_with_one_hub(spark, monkeypatch):
    """Near copies with many different hubs are compared about once each, not once for each hub."""
    rng = random.Random(7)
    texts, base = {}, [f"b{i}" for i in range(400)]
    where = rng.sample(range(400), 40)
    for k in range(150):
        changed = set(rng.sample(where, 4))
        texts[k] = " ".join(f"c{i}" if i in changed else w for i, w in enumerate(base))
    counts = compared(monkeypatch)
    assert kept(spark, texts) == brute_kept(texts)
    assert sum(counts) <= 2 * len(texts)


def test_known_classes_are_not_compared(spark, monkeypatch):
    """Texts of pages that are linked already aren't moved to be compared with each other."""
    base = [f"b{i}" for i in range(100)]
    rows = [(k, " ".join([*base, f"c{k}"])) for k in range(30)]
    counts = compared(monkeypatch)
    links = spark.createDataFrame([(0, k) for k in range(1, 30)], "a long, b long")
    classes = simhash.similar_classes(spark.createDataFrame(rows, "page long, text string"), links)
    assert {(r.node, r.component) for r in classes.collect()} == {(k, 0) for k in range(30)}
    assert sum(counts) == 0


def test_recall_on_a_whole_table(spark):
    """All of documents at sf0.01: what stays is what all pairs leave."""
    import pandas as pd

    df = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    texts = dict(zip(df.doc_id.tolist(), df.text.tolist()))
    assert kept(spark, texts) == brute_kept(texts)


def test_rows_of_one_doc_id_go_by_their_own_text(spark):
    """A text that nobody copies stays, though its doc_id also has a copy."""
    a, b = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    rows = [(1, a), (5, a), (5, b), (5, a + " end"), (7, a)]
    left = simhash.keep_one_per_class(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, left)) == [(1, a), (5, b)]


def test_two_texts_of_one_name_stay(spark, monkeypatch):
    """Were the 64-bit names of two texts equal, neither would go as the other's copy."""
    from pyspark.sql import functions as F

    whole = F.xxhash64
    monkeypatch.setattr(simhash.F, "xxhash64", lambda *c: whole(*c) if len(c) > 1 else F.lit(7).cast("long"))
    texts = [(k, " ".join(f"{c}{i}" for i in range(50))) for k, c in enumerate("abc")]
    left = simhash.keep_one_per_class(spark.createDataFrame([*texts, (9, texts[0][1])], "doc_id long, text string"))
    assert {(0, texts[0][1]), (1, texts[1][1]), (2, texts[2][1])} <= set(map(tuple, left.collect()))
