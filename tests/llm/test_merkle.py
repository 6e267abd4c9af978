import hashlib
import random
import zlib

import duckdb
import pytest

from lexibid.llm import merkle as M

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    fields = (doc_id, source, lang, n_chars, text)
    return sha(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(nodes):
    """All levels of nodes, the last of which has one."""
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha(*found[-1][i : i + 3]) for i in range(0, len(found[-1]), 3)])
    return found


def way(levels, at):
    """The nodes left and right of a leaf's way up."""
    steps = []
    for nodes in levels[:-1]:
        begin = at // 3 * 3
        steps.append((nodes[begin:at], nodes[at + 1 : begin + 3]))
        at //= 3
    return steps


def brute_force(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source, own in by_source.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[source] = tree([leaf(r, r[1]) for r in own])
    top = tree([trees[s][-1][0] for s in order])
    found = []
    for i, source in enumerate(order):
        for j, row in enumerate(by_source[source]):
            steps = way(trees[source], j) + way(top, i)
            chosen = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            text = row[1].replace("\n", "") if chosen and row[1] is not None else row[1]
            own = leaf(row, text)
            for left, right in steps:
                own = sha(*left, own, *right)
            root = top[-1][0]
            proof = sha(*(h for left, right in steps for h in (*left, *right)))
            found.append((row[0], leaf(row, row[1]), trees[source][-1][0], root, proof, own, own == root))
    return sorted(found, key=repr)


def check(docs, rows):
    assert sorted(map(tuple, M.manifest_report(docs).collect()), key=repr) == brute_force(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_by_brute_force(stored, seed):
    rng = random.Random(seed)
    sources = [None, "", "-", "a", "B", "é", "\U0001f600", "￿", *(f"s{i}" for i in range(6))]
    texts = [None, "", "\n", "one\ntwo\n", "é\n\U0001f600", "x" * 50_000 + "\n", "plain"]
    rows = []
    for i in rng.sample(range(10_000), 400):
        source = "hot" if rng.random() < 0.4 else rng.choice(sources)
        rows.append((i, rng.choice(texts), rng.choice([None, "", "en"]), source, rng.choice([None, 0, i])))
    check(stored(rows, SCHEMA, files=5), rows)


@pytest.mark.parametrize("sizes", [(1,), (2,), (3,), (4,), (1, 1), (9, 10, 1, 28), (81, 82)])
def test_sizes_of_sources(stored, sizes):
    """Lone leaves are subroots, and last runs may be short on any level."""
    rows = [(1000 * k + i, f"t\n{i}", "en", f"s{k}", i) for k, n in enumerate(sizes) for i in range(n)]
    check(stored(rows, SCHEMA, files=3), rows)


def test_missing_and_repeated_ids(stored):
    rows = [
        (None, "a\n", None, None, None),
        (None, None, None, None, None),
        (7, "b\n", "en", "s", 2),
        (7, "b\n", "en", "s", 2),
        (7, "c", "en", "s", 1),
        (-3, "", "", "", 0),
    ]
    check(stored(rows, SCHEMA), rows)


def test_empty_table(stored):
    assert M.manifest_report(stored([], SCHEMA)).collect() == []


def test_fields_are_told_apart(stored):
    """Null, empty, and what moves from one field to the next give different leaves."""
    rows = [(1, None, None, "s", None), (1, "", None, "s", None), (1, None, "", "s", None), (1, "-", None, "s", None)]
    found = M.manifest_report(stored(rows, SCHEMA)).collect()
    assert len({r.leaf for r in found}) == 4 and {r.verified for r in found} == {True}


def test_only_edited_documents_fail(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    found = {r.doc_id: r.verified for r in M.manifest_report(spark.read.parquet(path)).collect()}
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{path}'").fetchall()
    edited = {i for i, t in texts if zlib.crc32(str(i).encode()) % 2 == 0 and "\n" in (t or "")}
    assert edited and {i for i, ok in found.items() if not ok} == edited


def test_places_of_a_hot_source(spark):
    """Places add up over the ranges that a source is dealt to."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        nodes = spark.range(0, 4000, numPartitions=4).selectExpr("'s' AS grp", "(id * 7919) % 4000 AS k", "'h' AS hash")
        numbered = M.numbered(nodes, ["k"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(r.pos == r.k and r.n == 4000 for r in numbered) and len(numbered) == 4000
