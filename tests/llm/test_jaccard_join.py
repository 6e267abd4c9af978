import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexibid.llm import jaccard_join as J
from lexibid.llm.components import smallest_labels
from tests.llm.brute import components, links, shingles


def check(found, rows):
    texts = dict(rows)
    smallest, degree = components(texts), Counter(i for pair in links(texts) for i in pair)
    first = {}
    for doc_id in sorted(texts):
        first.setdefault(shingles(texts[doc_id]) or doc_id, doc_id)
    for doc_id, text in rows:
        own = first[shingles(text) or doc_id]
        assert tuple(found[doc_id]) == (doc_id, len(shingles(text)), smallest[doc_id], own, degree[doc_id]), doc_id


def check_pairs(docs, rows):
    """All pairs of classes, expanded to documents, are the links."""
    pairs, members = J.similar_documents(docs)
    of_class = {}
    for r in members.collect():
        if r.cls is not None:
            of_class.setdefault(bytes(r.cls), []).append(r.doc_id)
    found = [(a, b) for own in of_class.values() for a in own for b in own if a < b]
    texts = dict(rows)
    for r in pairs.collect():
        own = [(a, b) for a in of_class[bytes(r.a)] for b in of_class[bytes(r.b)]]
        assert len(shingles(texts[own[0][0]]) & shingles(texts[own[0][1]])) == r.shared
        found += [tuple(sorted(pair)) for pair in own]
    assert len(found) == len(set(found)) and set(found) == links(texts)


def near_copies(seed, documents=150):
    """Prose, edited copies of it, chains of edits, copies, shared passages and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    while len(texts) < documents:
        base = rng.choices(vocabulary, k=rng.choice([4, 5, 6, 8, 30, 80, 200]))
        kind = rng.randrange(5)
        if kind == 0:
            base = base[:20] + passage + base[20:40]
        texts.append(base)
        for _ in range(rng.choice([0, 1, 3, 8])):
            copy = list(texts[-1] if kind == 1 else base)
            for _ in range(rng.choice([0, 1, 2, len(copy) // 30, len(copy) // 20])):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randrange(2)] = [rng.choice(vocabulary)]
            texts.append(copy)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_by_brute_force(stored, by_id, seed):
    rows = near_copies(seed)
    docs = stored(rows, files=3)
    check(by_id(J.component_report(docs)), rows)
    check_pairs(docs, rows)


@pytest.mark.parametrize("classes", [2, 5])
def test_links_of_large_components(stored, by_id, monkeypatch, classes):
    """Blocks of few classes: every two of a component meet in one unit."""
    monkeypatch.setattr(J, "UNIT_CLASSES", classes)
    monkeypatch.setattr(J, "UNIT_SHINGLES", 500)
    rows = near_copies(7, documents=120)
    docs = stored(rows, files=3)
    check(by_id(J.component_report(docs)), rows)
    check_pairs(docs, rows)
    texts = J.located_texts(docs)
    _, known, labels = J.signed_components(texts)
    units = J.component_units(known, labels, texts).groupBy("grp", "i", "j").count().collect()
    assert len(units) > 10 and max(r["count"] for r in units if r.i >= 0) <= 6 * classes


@pytest.mark.parametrize("dense", [1, 4, 1 << 40])
def test_shared_counts_by_brute_force(monkeypatch, dense):
    monkeypatch.setattr(J, "DENSE", dense)
    monkeypatch.setattr(J, "MATRIX_COLUMNS", 3)
    monkeypatch.setattr(J, "PAIRS_AT_ONCE", 5)
    rng = random.Random(2)
    a, b = ([np.array(sorted(rng.sample(range(30), rng.randrange(20))), dtype=np.uint64) for _ in range(n)] for n in (12, 9))
    assert J.shared_counts(a, b).tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in b] for x in a]


def test_edges(stored, by_id):
    five = "a b c d e"
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r"),
        (4, "one two"),
        (5, "ONE\ttwo"),
        (6, "one two three"),
        (7, five),
        (8, "A  b\nc d E "),
        (9, f"{five} f"),
        (10, " "),
        (11, "word " * 30_000),
        (12, "word " * 29_000),
        (13, "É b c d e"),
        (14, "é b c d e"),
    ]
    check(by_id(J.component_report(stored(rows))), rows)


def test_the_threshold_is_met_exactly(stored, by_id):
    """Six of eight shingles are 75 percent; one word more on a side is less."""
    words = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(words[:11])), (2, " ".join(words[1:12])), (3, " ".join(words[10:22])), (4, " ".join(words[12:25]))]
    assert len(shingles(rows[0][1]) & shingles(rows[1][1])) == 6
    check(by_id(J.component_report(stored(rows))), rows)


def test_members_of_one_group_need_not_link_with_the_same(spark):
    """Same prefix and size, three sets: two are linked with each other and not with the third."""
    classes = spark.createDataFrame(
        [(bytes([i]), 7, 100, i, "f", i) for i in range(3)],
        "cls binary, grp bigint, n bigint, doc_id bigint, file string, row bigint",
    )
    postings = spark.createDataFrame([], "token bigint, grp bigint, n bigint, pivot bigint, left bigint")
    first = {(bytes(r.a), bytes(r.b)) for r in J._pivot_pairs(postings, classes).collect()}
    assert first == {(b"\x01", b"\x00"), (b"\x02", b"\x00")}
    none = spark.createDataFrame([], "node binary, label binary")
    rest = {(bytes(r.a), bytes(r.b)) for r in J._open_pairs(postings, classes, none).collect()}
    assert (b"\x01", b"\x02") in rest


def test_missing_and_repeated_ids(stored):
    text = "a b c d e f g h"
    rows = [(None, text), (3, text), (3, text), (7, text.upper()), (None, "x y"), (None, None), (3, "another text of five words")]
    found = J.component_report(stored(rows)).collect()
    assert sorted((r.n_shingles, r.component_id or 0, r.n_links) for r in found) == [
        (0, 0, 0),
        (1, 0, 0),
        (1, 3, 0),
        *[(4, 3, 3)] * 4,
    ]


def test_many_near_copies(stored, by_id):
    """Every pair of them is linked, yet candidates stay in proportion to the documents."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        copy = list(base)
        copy[rng.randrange(200)] = f"new{i}"
        rows.append((i, " ".join(copy)))
    docs = stored(rows)
    found = by_id(J.component_report(docs))
    assert {r.component_id for r in found.values()} == {0} and {r.n_links for r in found.values()} == {399}
    texts = J.located_texts(docs)
    signed = J.signatures(texts, docs.sparkSession.sparkContext.broadcast(J.frequency_order(texts.select("text"))))
    classes = J.class_table(signed)
    postings = J.shared_postings(signed, classes)
    assert J._pivot_pairs(postings, classes).count() <= 2 * 400
    labels = smallest_labels(J.verified(J._pivot_pairs(postings, classes), classes, texts))
    assert J._open_pairs(postings, classes, labels).isEmpty()


def test_one_of_each(stored):
    rows = near_copies(4, 60) + [(1000, None), (1001, ""), (None, near_copies(4, 60)[0][1])]
    docs = stored(rows)
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    texts = {i: t for i, t in rows if i is not None}
    smallest = components(texts)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(smallest.values()))


def test_shingles_of_many_texts_at_once():
    """Sets share as many hashes as texts share shingles, in whatever batch they are, and no words are remembered."""
    rng = random.Random(3)
    odd = ["a", "B", "b", "é", "É", "\x1c", "\u2003", "x" * 8, "x" * 9, "y" * 64, "y" * 65, "z" * 300]
    texts = [None, "", " \t\n\x0b\x0c\r", " a  b\t", *(" ".join(rng.choices(odd, k=rng.randrange(12))) for _ in range(150))]
    sets = J.shingle_sets(pa.array(texts, pa.string()))
    assert [len(own) for own in sets] == [len(shingles(t)) for t in texts]
    for i, own in enumerate(sets):
        assert (own[1:] > own[:-1]).all() and own.tolist() == J.shingle_set(texts[i]).tolist()
        for j in range(i):
            assert len(np.intersect1d(own, sets[j])) == len(shingles(texts[i]) & shingles(texts[j])), (texts[i], texts[j])
    part = pa.array(texts, pa.string()).slice(5, 40)
    assert [own.tolist() for own in J.shingle_sets(part)] == [own.tolist() for own in sets[5:45]]
    assert J.shingle_sets(part.slice(0, 0)) == []


def test_empty_table(stored):
    assert J.component_report(stored([])).collect() == []
    assert J.component_report(stored([(1, None)])).collect() == [(1, 0, 1, 1, 0)]


def test_prefix_sizes():
    """Sets that share less than the rest after the prefix cannot be similar enough."""
    for n in range(1, 400):
        most_shared_outside = n - J.prefix_size(n)
        assert 100 * most_shared_outside < J.PERCENT * n


def test_linked_in_whole_numbers():
    a = np.arange(8, dtype=np.uint64)
    assert J.linked(a, a[:6]) and not J.linked(a, a[:5])


@pytest.mark.parametrize("length", [1, 2, 30])
def test_labels_travel_along_chains(spark, length):
    links = [(f"n{i:03}", f"n{i + 1:03}") for i in range(length)] + [("x", "y"), ("y", "x")]
    found = {r.node: r.label for r in smallest_labels(spark.createDataFrame(links, "a string, b string")).collect()}
    assert found == {**{f"n{i:03}": "n000" for i in range(length + 1)}, "x": "x", "y": "x"}


def test_a_third_of_all_rows_is_one_text(spark):
    hot = F.lit("the hot text has a few more words than five")
    own = F.concat_ws(" ", *(F.concat(F.lit(f"{c}"), F.col("id")) for c in "abcdefg"))
    docs = spark.range(0, 6000, numPartitions=4).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, hot).otherwise(own).alias("text")
    )
    found = J.component_report(docs)
    assert found.where("component_id <> doc_id").count() == 1999
    assert found.where("component_id = 0").count() == 2000
    assert found.where("n_links = 1999").count() == 2000
