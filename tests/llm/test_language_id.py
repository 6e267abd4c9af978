import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexibid.llm import language_id as L

SCHEMA = "doc_id bigint, text string, lang string"
SYLLABLES = {"aa": ["th", "en", "ing", "er"], "bb": ["qu", "eau", "ois", "é"], "cc": ["жи", "ло", "ст", "ка"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 5))) for _ in range(n))


def rows(n=240, seed=1):
    rng = random.Random(seed)
    found = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        found.append((i, sentence(rng, lang, rng.randrange(3, 60)), lang))
    return found


@pytest.fixture
def model(stored):
    return L.train(stored(rows(), SCHEMA))


def test_held_out_accuracy(stored, by_id):
    table = rows()
    report = by_id(L.language_report(stored(table, SCHEMA)))
    for i, _, lang in table:
        assert report[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert report[i].lang_pred == lang and 0 < report[i].score <= 1


def test_edges(stored, by_id):
    table = rows(80) + [
        (1000, None, "aa"),
        (1001, "", "aa"),
        (1002, "12 34 -- !", "bb"),
        (1003, "then ing " * 20_000, None),
        (None, "eauois", "zz"),
        (1004, "漢字", None),
    ]
    report = by_id(L.language_report(stored(table, SCHEMA)))
    for i in (1000, 1001, 1002):
        assert tuple(report[i])[2:] == ("und", 0.0)
    assert report[1003].lang_pred == "aa" and report[1003].score == 1
    assert not report[None].held_out and report[None].lang_pred in SYLLABLES  # its own label is not learned
    assert report[1004].lang_pred in SYLLABLES


def test_nothing_to_learn_from(stored):
    table = [(i, "some text", None) for i in range(5)]
    report = L.language_report(stored(table, SCHEMA)).collect()
    assert {(r.lang_pred, r.score) for r in report} == {("und", 0.0)}
    assert L.language_report(stored([], SCHEMA)).collect() == []


def test_labels_of_held_out_documents_do_not_matter(stored, by_id):
    table = rows(120)
    changed = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in table]
    first, second = (by_id(L.language_report(stored(t, SCHEMA, name=n))) for t, n in ((table, "a"), (changed, "b")))
    assert {k: tuple(r) for k, r in first.items()} == {k: tuple(r) for k, r in second.items()}


def test_spans_of_mixed_texts(spark, model):
    rng = random.Random(3)
    parts = [sentence(rng, lang, 12) for lang in ("aa", "cc", "bb", "aa")]
    text = "- " + ", ".join(parts) + "."
    df = spark.createDataFrame([(text,), (None,), ("1",)], "text string")
    spans = [r[0] for r in df.select(L.language_spans(F.col("text"), model)).collect()]
    assert [s.lang for s in spans[0]] == ["aa", "cc", "bb", "aa"]
    for span, part in zip(spans[0], parts, strict=True):
        assert abs(span.start - text.index(part)) <= 12 and abs(span.end - text.index(part) - len(part)) <= 12
    assert spans[1] == spans[2] == []


def test_scripts_narrow_the_candidates(model):
    words = L.scored_words("then ЖИЛО eau", model)
    best = [model.langs[i] for i in words.scores.argmax(axis=0)]
    assert best == ["aa", "cc", "bb"]
    latin, cyrillic = words.scores[:, 0], words.scores[:, 1]
    assert latin[model.langs.index("cc")] < -1e5 and (cyrillic[:2] < -1e5).all()


def test_viterbi_by_brute_force(monkeypatch):
    rng = np.random.default_rng(1)
    counts = np.array([3, 0, 6, 1, 6, 2])
    scores = rng.normal(0, 8, (3, counts.sum())).astype(np.float32)
    for most in (1, 8, 1 << 20):
        monkeypatch.setattr(L, "VITERBI_WORDS", most)
        labels = L.viterbi(scores, counts, penalty=6.0)
        begin = 0
        for n in counts:
            own = scores[:, begin : begin + n]

            def value(path, own=own, n=n):
                return sum(own[k, t] for t, k in enumerate(path)) - 6 * sum(path[t] != path[t - 1] for t in range(1, n))

            best = max((value(p) for p in itertools.product(range(3), repeat=int(n))), default=0)
            assert value(labels[begin : begin + n].tolist()) == pytest.approx(best, rel=1e-5)
            begin += n


def test_pieces_cut_no_words(monkeypatch, model):
    text = sentence(random.Random(5), "bb", 300)
    whole = L.scored_words(text, model)
    monkeypatch.setattr(L, "PIECE", 64)
    parts = L.scored_words(text, model)
    assert (parts.start == whole.start).all() and (parts.letters == whole.letters).all()
    assert parts.scores == pytest.approx(whole.scores, abs=1e-3)


def test_a_word_of_many_pieces_is_one(monkeypatch, model):
    text = "ing " + "thening" * 40 + "и" * 200 + " " + "qu" * 100 + "\n" + "ж" * 64 + " a"
    whole = L.scored_words(text, model)
    for size in (1, 7, 64):
        monkeypatch.setattr(L, "PIECE", size)
        parts = L.scored_words(text, model)
        assert parts.start.tolist() == whole.start.tolist() and parts.letters.tolist() == whole.letters.tolist()
        assert parts.scores == pytest.approx(whole.scores, rel=1e-4, abs=1e-2)
    assert whole.letters.tolist() == [3, 480, 200, 64, 1]


def words_of(text):
    """Runs of letters, each letter as a trigram of lower-case letters or blanks."""
    folded = [c.lower()[0] if c.isalpha() and ord(c) <= L.LAST else " " for c in text or ""]
    padded, found = [" ", *folded, " "], []
    for i, c in enumerate(folded):
        if c != " ":
            if padded[i] == " ":
                found.append([])
            script = next((n for n, a, b in L.SCRIPTS if a <= ord(text[i]) <= b), "other")
            found[-1].append(("".join(padded[i : i + 3]), script))
    return found


def bucket(trigram):
    mixed = 0
    for c, factor in zip(trigram, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D), strict=True):
        mixed ^= ord(c) * factor % 2**32
    mixed ^= mixed >> 15
    return mixed * 0x2C1B3C6D % 2**32 >> 32 - L.BUCKET_BITS


def brute_force(table):
    """Trigram counts, scores, best labels and votes, one word at a time."""
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in table}
    learned = [(t, lang) for i, t, lang in table if i is not None and not held[i] and t is not None and lang is not None]
    langs = sorted({lang for _, lang in learned})
    counts = {lang: Counter() for lang in langs}
    scripts = {lang: Counter() for lang in langs}
    for text, lang in learned:
        for word in words_of(text):
            counts[lang].update(bucket(t) for t, _ in word)
            scripts[lang].update(s for _, s in word)

    def candidates(script):
        own = [k for k in langs if scripts[k][script] >= 0.01 * max(scripts[k].total(), 1)]
        return own or langs

    found = {}
    for i, text, _ in table:
        words = words_of(text)
        paths = {k: (0.0, []) for k in langs}
        for word in words:
            score = {}
            for k in langs:
                total = counts[k].total() + 0.5 * L.BUCKETS
                score[k] = sum(math.log((counts[k][bucket(t)] + 0.5) / total) for t, _ in word)
                score[k] -= 0 if k in candidates(word[0][1]) else 1e6
            best = max(langs, key=lambda k: (paths[k][0], -langs.index(k)))
            following = {}
            for k in langs:
                stays = paths[k][0] >= paths[best][0] - L.SWITCH
                value, path = (paths[k][0], paths[k][1]) if stays else (paths[best][0] - L.SWITCH, paths[best][1])
                following[k] = (value + score[k], [*path, k])
            paths = following
        if not words or not langs:
            found[i] = (i, held[i], "und", 0.0)
            continue
        path = max(paths.values(), key=lambda p: p[0])[1]
        votes = Counter()
        for k, word in zip(path, words, strict=True):
            votes[k] += len(word)
        winner = max(langs, key=lambda k: (votes[k], -langs.index(k)))
        found[i] = (i, held[i], winner, votes[winner] / votes.total())
    return found


def test_report_by_brute_force(stored, by_id):
    rng = random.Random(8)
    table = rows(90, seed=6)
    for i in range(1000, 1060):
        parts = [sentence(rng, rng.choice(list(SYLLABLES)), rng.randrange(1, 9)) for _ in range(4)]
        table.append((i, "; ".join(parts).upper() if i % 3 else "\n1 ".join(parts), rng.choice([None, *SYLLABLES])))
    table += [(2000, None, "aa"), (2001, "", None), (2002, "4 $", "bb"), (2003, "漢字 κόσμε", None), (None, "eau then", "cc")]
    found, expected = by_id(L.language_report(stored(table, SCHEMA))), brute_force(table)
    assert {i: tuple(r)[:3] for i, r in found.items()} == {i: e[:3] for i, e in expected.items()}
    assert [found[i].score for i in expected] == pytest.approx([e[3] for e in expected.values()])
    assert len({e[3] for e in expected.values()}) > 20


def test_repeated_rows(stored):
    table = [(1, "then ing", "aa"), (1, "then ing", "aa"), (1, "eauois", None), (2, "eau qu", "bb")]
    found = L.language_report(stored(table, SCHEMA)).collect()
    assert sorted(r.doc_id for r in found) == [1, 1, 1, 2]
    by_rule = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in (1, 2)}
    assert all(r.held_out == by_rule[r.doc_id] for r in found)


def test_rejected_documents_go(stored):
    table = rows(40) + [(1000, None, None), (1001, "12", "aa")]
    docs = stored(table, SCHEMA)
    kept = L.determined(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(40))
