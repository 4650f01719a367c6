"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import ROWS_AT_ONCE, by_batch, cut, raw_texts, release, rolling, word_hashes
from eventloom.llm.components import connected_components
from eventloom.llm.repeats import PageFilter

#: Shingles whose bits are counted at once: bounds the memory of a very long text.
BLOCK = 1 << 15
#: Places in which shingles are counted by hash, to put rare ones first.
COUNTERS = 1 << 18


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles (A-Z in lower case, repeats counted); 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(run), seed) for run in runs], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        ones += np.unpackbits(hashes[at : at + BLOCK].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) for each row of docs(doc_id, text); fp holds the 64 bits as a signed long. A null text has no words."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(x, shingle, seed) for x in raw_texts(batch.column(1))], np.uint64)
        return pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return by_batch(docs.select("doc_id", "text"), kernel, "doc_id long, fp long")


def hamming_ball(bits: int, radius: int) -> list[int]:
    """All masks of at most radius ones among bits."""
    ball = {0}
    for _ in range(radius):
        ball |= {mask | 1 << i for mask in ball for i in range(bits)}
    return sorted(ball)


def hamming_links(fps: DataFrame, radius: int = 3, segments: int = 2) -> DataFrame:
    """(a, b), a < b: all pairs of different values of fps(fp) that differ in at most radius of 64 bits.

    Multi-index hashing: values within radius agree up to radius // segments bits in at least one of the segments. Each
    value is stored once per segment and looks up the Hamming ball around each of its own segments; the join keeps a
    pair only if its complete distance is small enough, so only real links leave it. With two segments of 32 bits a ball
    has 33 members: work grows in proportion to the number of distinct values until those come near 2**32.
    """
    width = 64 // segments
    ball = F.array(*[F.lit(m) for m in hamming_ball(width, radius // segments)])
    part = lambda i: F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << width) - 1))
    around = lambda i: F.transform(ball, lambda m: F.struct(F.lit(i).alias("segment"), part(i).bitwiseXOR(m).alias("key")))
    stored = fps.select(F.explode(F.array(*[F.struct(F.lit(i).alias("segment"), part(i).alias("key")) for i in range(segments)])).alias("s"), F.col("fp").alias("b"))
    probes = fps.select(F.explode(F.flatten(F.array(*map(around, range(segments))))).alias("s"), F.col("fp").alias("a"))
    left, right = probes.select("s.segment", "s.key", "a"), stored.select("s.segment", "s.key", "b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    return left.join(right, ["segment", "key"]).where(near).select("a", "b").distinct()


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs: near-duplicate classes under links of at most radius bits.

    Documents with one fingerprint collapse to one value before any link is looked for, so a group of copies costs as
    much as one document; classes are found on the distinct values. component_id is the least doc_id of the class.
    Null or empty texts have fingerprint 0 and so form one class; a null doc_id stays and takes its class's id; repeated
    rows stay; an empty table gives an empty result; other columns are ignored.
    """
    fps = cut(fingerprints(docs, shingle, seed))
    values = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = connected_components(hamming_links(values.select("fp"), radius)).withColumnRenamed("node", "fp")
    classes = values.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "component").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Hashes of a text's different shingles of width words (A-Z in lower case); a shorter text is one shingle, one without words has none."""
    words = word_hashes(text.lower().split())
    return np.unique(rolling(words, min(width, len(words)) or 1))


def shingle_counts(docs: DataFrame, width: int) -> np.ndarray:
    """How many rows of docs(text) hold a shingle, about: entry h % COUNTERS counts all shingles with such a hash h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                for text in raw_texts(batch.slice(at, ROWS_AT_ONCE).column(0)):
                    np.add.at(held, shingle_set(text, width) % np.uint64(COUNTERS), 1)
        at = np.flatnonzero(held)
        yield pa.record_batch([pa.array(at), pa.array(held[at])], ["at", "n"])

    total = np.zeros(COUNTERS, np.int64)
    for r in docs.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        total[r.at] = r.n
    return total


def shared_prefixes(docs: DataFrame, width: int, threshold: float) -> DataFrame:
    """(token, page, n, pos): the prefix shingles of each page of docs(page, text) that another page's prefix holds too.

    The shingles of all pages stand in one order, rare ones (shingle_counts) first. A set of n shingles whose similarity
    with another is at least threshold shares threshold * n of them, so the first n - ceil(threshold * n) + 1 of both in
    that order have one in common: the prefixes lose no pair, whatever the order. pos counts from 0.
    """
    held = shingle_counts(docs, width)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, prefixes = [], []
        for text in raw_texts(batch.column(1)):
            found = shingle_set(text, width)
            order = np.lexsort((found, held[found % np.uint64(COUNTERS)]))
            sizes.append(len(found))
            prefixes.append(found[order[: len(found) - int(np.ceil(threshold * len(found) - 1e-9)) + 1]].view(np.int64))
        return pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))], ["page", "n", "tokens"])

    sets = cut(by_batch(docs.select("page", "text"), kernel, "page long, n long, tokens array<long>").groupBy("page").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")))
    release(docs.sparkSession)
    shared = cut(sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("size")).where("size >= 2"))
    release(docs.sparkSession)
    maybe = PageFilter(shared.select(F.col("token").alias("page")))

    def met(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, counts = batch.column(2).flatten().to_numpy(zero_copy_only=False), batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        ends = np.cumsum(counts)
        row, pos = np.repeat(np.arange(len(counts)), counts), np.arange(len(tokens)) - np.repeat(ends - counts, counts)
        held = maybe(tokens)
        at = pa.array(row[held])
        return pa.record_batch([batch.column(0).take(at), batch.column(1).take(at), pa.array(pos[held]), pa.array(tokens[held])], ["page", "n", "pos", "token"])

    places = by_batch(sets, met, "page long, n long, pos long, token long")  # few tokens that no other page holds are left
    members = cut(places.join(shared, "token"))
    release(docs.sparkSession)
    return members


def _in_reach(threshold: float) -> Column:
    """Whether two members of a token can be similar, if it is their first common one: what is left of both sets from it on is enough."""
    left = F.least(F.col("n") - F.col("pos"), F.col("other_n") - F.col("other_pos"))
    return (1 + threshold) * left >= threshold * (F.col("n") + F.col("other_n")) - 1e-6


def similar_classes(docs: DataFrame, links: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """(node, component): classes of the pages of docs(page, text) under links(a, b) and all pairs whose sets of shingles
    of width words have a Jaccard similarity of at least threshold.

    Similar pages share a token of their prefixes. Pairs are compared in three rounds, each time without those that are in
    one class by then, so the classes are those of all pairs:

    1. each token has a hub (the member that meets the most others); each page is held against that one of its tokens' hubs
       that meets the most. A group of near copies mostly becomes one class here, by one pair a page;
    2. each page is held against its other hubs;
    3. for each token whose members are in more than one class still, all members outside the largest class are held
       against all members of other classes.
    """
    spark = docs.sparkSession
    members = shared_prefixes(docs, width, threshold)
    texts = docs.select(F.col("page").alias("doc_id"), "text")
    classes = cut(connected_components(links))
    release(spark)
    central = cut(members.groupBy("page").agg(F.sum("size").alias("met")))
    hubs = cut(members.join(central, "page").groupBy("token").agg(F.max(F.struct("met", "page", "n", "pos")).alias("hub")))
    other = [F.col(f"hub.{c}").alias(f"other_{c}") for c in ("met", "page", "n", "pos")]
    held = members.join(hubs, "token").select("page", "n", "pos", *other).where(_in_reach(threshold)).where("page <> other_page")
    of_hubs = cut(held.select(F.col("page").alias("a"), F.col("other_page").alias("b"), F.col("other_met").alias("met")).distinct())
    release(spark)
    best = of_hubs.groupBy("a").agg(F.max(F.struct("met", "b")).alias("hub")).select("a", "hub.b")
    for pairs in (best, of_hubs.select("a", "b").join(best, ["a", "b"], "left_anti")):
        classes = _joined(classes, similar_pairs(cut(_between(pairs, classes)), texts, width, threshold))
        release(spark)
    placed = cut(members.join(classes.withColumnRenamed("node", "page"), "page", "left").select("token", "page", "n", "pos", F.coalesce("component", "page").alias("class")))
    sizes = placed.groupBy("token", "class").agg(F.count("*").alias("size"))
    open_ = cut(sizes.groupBy("token").agg(F.count("*").alias("classes"), F.max(F.struct("size", "class")).alias("largest")).where("classes >= 2"))
    rest = cut(placed.join(open_, "token").select("token", "page", "n", "pos", "class", F.col("largest.class").alias("main")))
    release(spark)
    outside = rest.where("class <> main")
    others = rest.select("token", *[F.col(c).alias(f"other_{c}") for c in ("page", "n", "pos", "class")])
    met = outside.join(others, "token").where((F.col("class") != F.col("other_class")) & _in_reach(threshold))
    ends = [f("page", "other_page").alias(c) for f, c in ((F.least, "a"), (F.greatest, "b"))]
    known = of_hubs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))  # compared, or in one class
    left = cut(met.select(*ends).distinct().join(known, ["a", "b"], "left_anti"))
    return _joined(classes, similar_pairs(left, texts, width, threshold))


def _between(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs(a, b) whose ends are in different ones of classes(node, component); a node that isn't there is its own class."""
    a, b = (classes.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in ("a", "b"))
    placed = pairs.join(a, "a", "left").join(b, "b", "left")
    return placed.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """classes(node, component) after links(a, b) between their nodes or new ones."""
    known = classes.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return cut(connected_components(known.unionByName(links)))


def similar_pairs(pairs: DataFrame, docs: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """The pairs(a, b) of doc_ids whose texts' sets of word shingles have a Jaccard similarity of at least threshold.

    Only texts that stand in a pair are shuffled (a filter of fixed size, which may let others through, goes before), and
    to each side only those that stand there.
    """
    sides = {c: pairs.select(F.col(c).alias("page")).distinct() for c in ("a", "b")}
    ends = cut(sides["a"].unionByName(sides["b"]).distinct())
    texts = PageFilter(ends).keep(docs.select(F.col("doc_id").alias("page"), "text").where("page is not null")).groupBy("page").agg(F.first("text").alias("text"))
    texts = cut(texts.join(ends, "page", "left_semi"))
    release(docs.sparkSession)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[int, np.ndarray] = {}  # a hub comes with many
        keep = []
        for b, left, right in zip(batch.column(1).to_pylist(), *(raw_texts(batch.column(k)) for k in (2, 3))):
            if b not in known:
                known[b] = shingle_set(right, shingle)
            one, two = shingle_set(left, shingle), known[b]
            shared = len(np.intersect1d(one, two, assume_unique=True))
            keep.append(shared >= threshold * max(len(one) + len(two) - shared, 1))
        return batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    left, right = (texts.join(sides[c], "page", "left_semi").select(F.col("page").alias(c), F.col("text").alias(name)) for c, name in (("a", "left"), ("b", "right")))
    both = pairs.join(left, "a").join(right, "b")
    return by_batch(both.select("a", "b", "left", "right"), kernel, "a long, b long")


def keep_one_per_class(docs: DataFrame, shingle: int = 3, radius: int = 3, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """docs without near copies: of each class the document with the least doc_id stays, with all its columns.

    Documents are linked as in simhash_components(), and, however far apart their fingerprints are, if their sets of
    shingles of so many words have a Jaccard similarity of threshold or more (similar_classes, which loses none).

    A row goes if its text's class keeps another doc_id; so of rows that share a doc_id each goes by its own text. Rows
    without doc_id can't be told apart from their copies and stay. A document without any word stays too: an empty text
    is nobody's copy. A text of any length is compared whole. Texts are named by 64 bits and told apart by 64 more: should
    two different texts have one name, one of them stays unexamined. Repeated rows stay or go together; an empty table
    gives an empty result; other columns are carried along.
    """
    check = F.xxhash64(F.lit(1), "text")
    named = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("page"), check.alias("check"), "text").where("doc_id is not null")

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(x, shingle, 42) for x in raw_texts(batch.column(3))], np.uint64)
        return pa.record_batch([*(batch.column(k) for k in range(3)), pa.array(found.view(np.int64))], ["doc_id", "page", "check", "fp"])

    fps = cut(by_batch(named, kernel, "doc_id long, page long, check long, fp long").where("fp <> 0"))
    pages = cut(fps.groupBy("page").agg(F.min(F.struct("check", "doc_id", "fp")).alias("one")).select("page", "one.check", F.col("one.doc_id").alias("least"), "one.fp"))
    values = cut(pages.groupBy("fp").agg(F.min("page").alias("first")))
    ends = [values.select(F.col("fp").alias(c), F.col("first").alias(f"page_{c}")) for c in ("a", "b")]
    close = hamming_links(values.select("fp"), radius).join(ends[0], "a").join(ends[1], "b").select(F.col("page_a").alias("a"), F.col("page_b").alias("b"))
    equal = pages.join(values, "fp").where("page <> first").select(F.col("page").alias("a"), F.col("first").alias("b"))
    classes = similar_classes(named.select("page", "text"), close.unionByName(equal), words, threshold)
    of_page = pages.join(classes.withColumnRenamed("node", "page"), "page", "left").withColumn("class", F.coalesce("component", "page"))
    of_page = cut(of_page.select("page", "check", "least", "class"))
    kept = of_page.groupBy("class").agg(F.min("least").alias("kept"))
    keepers = cut(of_page.join(kept, "class").select("page", "check", "kept"))
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("page"), check.alias("check"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # a join of plain exchanges: where a page has many copies, its rows are split
    return rows.join(keepers, ["page", "check"], "left").where("doc_id is null or kept is null or doc_id = kept").select("row.*")
