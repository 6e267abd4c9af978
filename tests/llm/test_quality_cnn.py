import zlib

import duckdb
import numpy as np
import pytest

from lexibid.llm import quality_cnn as Q

SF_DIR = "/root/testdata/sf0.01"


def network(seed=1):
    rng = np.random.default_rng(seed)
    shapes = (Q.WIDTH, 256, Q.FILTERS), (Q.FILTERS,), (3 * Q.FILTERS,), (1,)
    return Q.Network(*(rng.normal(0, 0.3, s).astype(np.float32) for s in shapes))


def plain_score(net, text):
    """One window after another."""
    padded = (text or b"\0") + b"\0" * (Q.WIDTH - 1)
    answers = [sum(net.filters[w][padded[at + w]] for w in range(Q.WIDTH)) for at in range(max(1, len(text)))]
    chunks = [np.max(answers[i : i + Q.CHUNK], axis=0) for i in range(0, len(answers), Q.CHUNK)]
    chunks = np.tanh(np.array(chunks) + net.bias)
    features = np.concatenate([chunks.max(axis=0), chunks.mean(axis=0), chunks.min(axis=0)])
    return 1 / (1 + np.exp(-(features @ net.weights + net.prior[0])))


def some_texts():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 3, 5, 6, 255, 256, 257, 511, 512, 513, 1000, 70_000, 0, 2]
    return [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in sizes]


def test_scores_by_brute_force():
    net, texts = network(), some_texts()
    assert Q.scores(net, texts) == pytest.approx([plain_score(net, t) for t in texts], rel=1e-4)


def test_the_whole_text_counts(monkeypatch):
    """A junk passage far behind the start, and across the end of a chunk, changes the score."""
    net = network()
    net.filters[:] = 0
    for w, byte in enumerate(b"#junk#"):
        net.filters[w, byte] = 1
    net.weights[: Q.FILTERS] = -1
    clean = b"a" * 500_000
    for at in (0, Q.CHUNK - 3, 499_990):
        assert Q.scores(net, [clean[:at] + b"#junk#" + clean[at:]])[0] < Q.scores(net, [clean])[0] - 1e-6


def test_portions_and_blocks_do_not_change_scores(monkeypatch):
    net, texts = network(), some_texts()
    whole = Q.scores(net, texts)
    monkeypatch.setattr(Q, "BLOCK", 2)
    assert Q.scores(net, texts) == pytest.approx(whole)
    assert [Q.scores(net, [t])[0] for t in texts] == pytest.approx(whole)


def test_gradient_by_differences():
    net, texts = network(3), some_texts()[5:12]
    raw = [np.frombuffer(Q.sample_chunks(t), dtype=np.uint8).reshape(-1, Q.CHUNK + Q.WIDTH - 1) for t in texts]
    counts, chunks = np.array([len(r) for r in raw]), np.concatenate(raw).astype(np.intp)
    labels = np.array([0, 1, 1, 0, 1, 0, 1], dtype=np.float32)
    wide = Q.Network(*(a.astype(np.float64) for a in (net.filters, net.bias, net.weights, net.prior)))

    def loss(own):
        answers = own.answers([chunks[:, w : w + Q.CHUNK] for w in range(Q.WIDTH)])
        features = np.concatenate(Q._of_texts(np.tanh(answers.max(axis=1) + own.bias), np.cumsum(counts) - counts, counts), axis=1)
        chance = Q._chance(own, features)
        return -np.mean(labels * np.log(chance) + (1 - labels) * np.log(1 - chance))

    slopes = Q._gradient(wide, chunks, counts, labels)
    rng = np.random.default_rng(4)
    for k, name in enumerate(("filters", "bias", "weights", "prior")):
        largest = np.argsort(-np.abs(slopes[k]).ravel())[:5]
        for at in [*largest, *rng.integers(0, slopes[k].size, 3)]:
            values = [a.copy() for a in (wide.filters, wide.bias, wide.weights, wide.prior)]
            values[k].ravel()[at] += 1e-6
            up = loss(Q.Network(*values))
            values[k].ravel()[at] -= 2e-6
            assert slopes[k].ravel()[at] == pytest.approx((up - loss(Q.Network(*values))) / 2e-6, abs=1e-5), name


def test_held_out_accuracy(spark):
    found = {r.doc_id: r for r in Q.quality_report(spark, SF_DIR).collect()}
    tables = [f"'{SF_DIR}/{t}.parquet'" for t in ("documents", "labels")]
    rows = duckdb.sql(f"SELECT doc_id, quality FROM {tables[0]} JOIN {tables[1]} USING (doc_id)").fetchall()
    assert len(found) == 1000
    held = [(found[i], q) for i, q in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r.held_out for r, _ in held) and sum(r.held_out for r in found.values()) > 100
    assert np.mean([r.predicted == q for r, q in held]) >= 0.95
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in found.values())


def test_labels_of_the_held_out_fold_change_nothing(stored, by_id):
    texts = [("good words here " * 5, 1), ("#!# ?? " * 9, 0)]
    rows = [(i, texts[i % 2][0] + str(i)) for i in range(60)]
    labels = [(i, texts[i % 2][1]) for i in range(60)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    docs = stored(rows, "doc_id bigint, text string")
    known = [stored(own, "doc_id bigint, quality int", name=n) for own, n in ((labels, "labels"), (turned, "turned"))]
    one, other = (by_id(Q.quality(docs, own)) for own in known)
    assert one == other and all(one[i].predicted == q for i, q in labels)


def test_edges(stored, by_id):
    """Nulls, empty and very long texts, repeated rows, and rows without id or label."""
    rows = [(1, None), (2, ""), (3, "x" * 300_000), (4, "some words"), (4, "some words"), (None, "some words"), (5, "\0")]
    labels = stored([(4, 1), (4, 0), (None, 1), (3, None), (99, 1)], "doc_id bigint, quality int", name="labels")
    found = Q.quality(stored(rows), labels).collect()
    assert len(found) == len(rows)
    score = {r.doc_id: r.score for r in found}
    assert score[1] == score[2] == score[5] and score[4] == score[None]
    assert not [r for r in found if r.doc_id is None][0].held_out
    none = Q.quality(stored(rows), stored([], "doc_id bigint, quality int", name="none"))
    assert {r.score for r in none.collect()} == {0.5}
    assert Q.quality(stored([], name="empty"), labels).collect() == []
