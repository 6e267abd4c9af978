import random
from collections import Counter

import pytest

from lexibid.llm import mixing as M
from tests.llm.brute import targets, words

SCHEMA = "doc_id bigint, text string, source string"


def corpus(seed=1, n=600, sources=("a", "b", "B", "é", "漢", None, "hot")):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(sources)
        rows.append((i, "w " * rng.choice([0, 1, 10, 50, 90]), source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_by_sharing_out_again_and_again(stored, by_id, seed):
    rows = corpus(seed)
    found = by_id(M.mix_report(stored(rows, SCHEMA)))
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    expected, taken = targets(dict(sizes)), Counter()
    for doc_id, text, source in rows:
        row = found[doc_id]
        assert (row["size"], row.source_size) == (len(words(text)), sizes[source])
        assert row.target == pytest.approx(float(expected[source]), rel=1e-12)
        assert row.taken <= 2 * row["size"]
        taken[source] += row.taken
    for source, target in expected.items():
        assert taken[source] == pytest.approx(float(target), rel=0.2)
    assert sum(expected.values()) * 2 == 3 * sum(sizes.values())


def test_reruns_and_layouts_agree(stored, by_id):
    rows = corpus(3, 200)
    first, second = (by_id(M.mix_report(stored(rows, SCHEMA, files=f, name=str(f)))) for f in (1, 5))
    assert first == second


def test_copies_are_emitted(stored):
    docs = stored(corpus(4, 150), SCHEMA)
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    copies = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    expected = {r.row.doc_id: r["copies"] for r in M.repetitions(docs).collect() if r["copies"]}
    assert copies == expected


def test_edges(stored):
    rows = [(1, None, "a"), (2, "", None), (None, "one two", "b"), (3, "x", "b"), (3, "x", "b"), (4, "w " * 100_000, None)]
    found = M.mix_report(stored(rows, SCHEMA)).collect()
    assert len(found) == 6
    assert {r.taken for r in found if r["size"] == 0} == {0}
    same = [tuple(r) for r in found if r.doc_id == 3]
    assert same[0] == same[1]
    assert M.mix_report(stored([], SCHEMA, name="none")).collect() == []
    nothing = M.mix_report(stored([(1, None, "a"), (2, " ", "b")], SCHEMA, name="blank")).collect()
    assert {(r.target, r.taken) for r in nothing} == {(0.0, 0)}
    assert M.mix(stored([(1, None, "a")], SCHEMA, name="one")).collect() == []


def test_one_source_takes_its_share(stored):
    found = M.mix_report(stored([(i, "a b c d", "only") for i in range(300)], SCHEMA)).collect()
    assert {r.target for r in found} == {1800.0}
    assert sum(r.taken for r in found) == pytest.approx(1800, rel=0.1)
