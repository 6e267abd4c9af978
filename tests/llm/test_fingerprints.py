import hashlib
import random

import pytest

from lexibid.llm import fingerprints as P


def naive_cuts(data):
    """One byte at a time: a shift register, then the first place that allows a cut."""
    hashes, register = [], 0
    for byte in data:
        register = ((register << 1) + int(P.GEAR[byte])) & 0xFFFF
        hashes.append(register)
    found, start = [], 0
    while len(data) - start > P.LEAST:
        end = min(start + P.MOST, len(data))
        for at in range(start + P.LEAST, min(start + P.MOST, len(data)) + 1):
            bits = P.RARE_BITS if at < start + P.USUAL else P.FREQUENT_BITS
            if hashes[at - 1] < 1 << (16 - bits):
                end = at
                break
        found.append(end)
        start = end
    return found + [len(data)] * (start < len(data))


@pytest.mark.parametrize("seed", range(5))
def test_cuts_by_brute_force(seed):
    rng = random.Random(seed)
    data = "".join(rng.choices("abcdefgh ß漢\n", k=rng.randrange(3000))).encode()
    assert list(P.cuts(data)) == naive_cuts(data)


@pytest.mark.parametrize("data", [b"", b"a", b"a" * 8, b"a" * 9, b"\0" * 5000])
def test_edges(data):
    assert list(P.cuts(data)) == naive_cuts(data)


def test_an_insertion_changes_few_chunks():
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(500))
    a, b = P.chunk_set(text), P.chunk_set(text[:1500] + "inserted" + text[1500:])
    assert P.containment(a, b) > 0.95
    assert P.containment(a, P.chunk_set(text[::-1])) < 0.1
    assert P.unpacked(P.packed(a)) == a


def test_containment():
    assert P.containment({}, {}) == 1 and P.containment({b"a": 1}, {}) == 0
    assert P.containment({b"a": 3, b"b": 1}, {b"a": 3}) == 1
    assert P.containment({b"a": 3, b"b": 1}, {b"b": 1, b"c": 5}) == 0.25


def random_rows(n):
    rng = random.Random(n)
    vocabulary = ["".join(rng.choices("abcdéßł漢", k=rng.randrange(1, 9))) for _ in range(200)]
    ids = rng.sample(range(-500, 500), n)
    return [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 50, 400])))) for i in ids]


@pytest.mark.parametrize("n", [1, 2, 7, 120])
def test_report(stored, by_id, n):
    rows = random_rows(n)
    rows[0] = (rows[0][0], None)
    found = by_id(P.edit_report(stored(rows, files=3)))
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    for at, (doc_id, text) in enumerate(order):
        following = order[(at + 1) % n][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        row, own = found[doc_id], P.chunk_set(text)
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (P.packed(own), P.packed(P.chunk_set(edited)))
        assert row.near_edited == P.containment(own, P.chunk_set(edited))
        assert row.near_next == P.containment(own, P.chunk_set(following))


def test_missing_and_repeated_ids(stored):
    rows = [(None, "no id at all"), (None, None), (2, "b" * 30), (2, "a" * 30), (1, "c" * 30)]
    found = P.edit_report(stored(rows)).collect()
    assert len(found) == 5
    lonely = [r for r in found if r.doc_id is None]
    assert all(r.near_next is None and r.near_edited == 1 and r.fingerprint == r.edited_fingerprint for r in lonely)
    digests = {r.edited_sha256 for r in found if r.doc_id is not None}
    texts = ["a" * 20 + "b" * 10, "b" * 20 + "c" * 10, "c" * 20 + "a" * 10]
    assert digests == {hashlib.sha256(t.encode()).hexdigest() for t in texts}


def test_empty_table(stored):
    assert P.edit_report(stored([])).collect() == []


def test_fingerprints_alone(stored, by_id):
    found = by_id(P.fingerprints(stored([(1, "x" * 100), (2, None), (3, "x" * 100)])))
    assert found[1].fingerprint == found[3].fingerprint != "" and found[2].fingerprint == ""
