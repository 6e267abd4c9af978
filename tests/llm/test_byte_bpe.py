import hashlib
import random

import pyarrow as pa
import pytest

from lexibid.llm import byte_bpe as B
from tests.llm.brute import tokenizer

TEXTS = [
    None,
    "",
    " ",
    "a",
    "  \n\n x  y ",
    "it's 'S I'll don't",
    "tab\t\tx\r\n\r\n",
    "été ​　 x",
    "日本語テキスト漢字" * 100,
    "🙂🙂 <|endoftext|>\x00\x01",
    "aaaa" * 2000,
    "x" * 5000 + " tail",
    "===" * 700 + "   " * 300 + "z",
    "".join(random.Random(3).choices("abcdefghijklmnop", k=3000)),
    "".join(random.Random(4).choices("ab", k=2000)),
    "word " * 20_000,
]


@pytest.fixture(scope="module")
def reference():
    return tokenizer()


@pytest.fixture(scope="module")
def codec():
    return B.Codec(B.read_ranks(B.VOCABULARY), B.PATTERN)


def test_round_trip_report(stored, by_id, reference):
    rows = by_id(B.round_trip_report(stored(list(enumerate(TEXTS)))))
    for i, text in enumerate(TEXTS):
        ids = reference.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = hashlib.sha256((text or "").encode()).hexdigest()
        assert tuple(rows[i]) == (i, len(ids), digest, decoded)


def test_encode_and_decode_columns(stored, by_id, reference):
    docs = stored(list(enumerate(TEXTS)))
    encoded = B.encode(docs)
    for i, row in by_id(encoded).items():
        assert row.ids == reference.encode_ordinary(TEXTS[i] or "")
    for i, row in by_id(B.decode(encoded)).items():
        assert bytes(row.bytes).decode() == (TEXTS[i] or "")


def test_random_texts(codec, reference):
    rng = random.Random(5)
    pieces = ["the", "The ", " ", "\n", "'s", "é", "ß", "漢", "12", "3.7", "--", " ", "onth", "ing", "🙂", "\x85"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(60))) for _ in range(2000)]
    ids = codec.encode(texts)
    assert [B.as_array(i).tolist() for i in ids] == [reference.encode_ordinary(t) for t in texts]
    assert [raw.decode() for raw in codec.decode([B.as_array(i) for i in ids])] == texts


@pytest.mark.parametrize("alphabet", ["ab", "abc", "etaoin", "=-", "0123456789", "éèà"])
@pytest.mark.parametrize("length", [600, 3000])
def test_long_words(codec, reference, alphabet, length):
    word = "".join(random.Random(length).choices(alphabet, k=length))
    assert B.as_array(codec.encode([word])[0]).tolist() == reference.encode_ordinary(word)


def test_the_way_of_long_words_on_short_ones(codec, reference):
    rng = random.Random(6)
    for alphabet in ("ab", "abc", "=-"):
        for length in range(3, 40, 3):
            word = "".join(rng.choices(alphabet, k=length))
            if word.encode() not in codec.ranks:
                assert B.as_array(codec._encode_long(word.encode())).tolist() == reference.encode_ordinary(word)


def test_a_worker_forgets_words_but_not_results(codec, monkeypatch):
    texts = [f"wort{i} und so" for i in range(300)]
    before = codec.encode(texts)
    monkeypatch.setattr(B, "KNOWN_WORDS", 50)
    assert codec.encode(texts) == before


def test_unknown_ids_are_an_error(codec):
    with pytest.raises(ValueError, match="50256"):
        codec.decode([B.as_array("1,50256")])


def test_empty_table(stored):
    assert B.round_trip_report(stored([])).collect() == [] and B.encode(stored([])).collect() == []


def test_store_keeps_what_was_used_last():
    store = B.Store(most=100)
    words = [f"w{i}" for i in range(250)]
    keys = B.word_keys(words)
    ids = [",".join(str(i) for _ in range(i % 4 + 1)) for i in range(250)]
    for first in range(0, 250, 10):
        found = store.find(keys[first : first + 10])
        assert (found == -1).all()
        store.add(keys[first : first + 10], ids[first : first + 10])
        assert (store.find(keys[:10]) >= 0).all() and len(store.keys) <= 100
        assert store.ids(store.find(keys[first : first + 10])) == ids[first : first + 10]
    known = store.find(keys)
    assert [own for own in store.ids(known) if own] == [ids[i] for i in range(250) if known[i] >= 0]
    assert B.Store().find(keys[:0]).tolist() == [] and B.Store().ids(B.Store().find(keys[:2])) == ["", ""]


def test_words_are_those_of_the_pattern():
    codec = B.Codec(B.read_ranks(B.VOCABULARY), B.PATTERN)
    signs = ["", ",", ".", "?!", "'s", "'", "1", "²", "_", "é", "\u0301", "\u0531", "漢", "\n", " "]
    for start in ("", " ", "  ", "\n", "\u00a0"):
        for body in ("word", "Été", "жук", "ª", "x'll", "\u0250"):
            for end in signs:
                for stretch in B.STRETCH.findall(start + body + end):
                    assert codec._words(stretch) == codec.pattern.findall(stretch), repr(stretch)


def test_about_a_megabyte_of_text_at_once():
    """Whatever the batch: what a worker holds in objects decides its memory."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(["x" * 600_000] * 5)], ["doc_id", "text"])
    assert [p.num_rows for p in B._text_portions(batch)] == [2, 2, 1]


def test_the_round_trip_holds_a_quarter_of_it():
    """Texts, ids and decoded bytes of a whole megabyte took a worker up to 217 MB."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(["x" * 100_000] * 8)], ["doc_id", "text"])
    assert [p.num_rows for p in B._text_portions(batch, B.ROUND_TRIP_PORTION)] == [3, 3, 2]


def test_a_store_of_words_stays_small():
    """Full, with ids of usual length: as an executor's two workers have it beside a full heap."""
    store = B.Store()
    ids = [f"{i % 50_000},{i * 7 % 50_000},{i * 11 % 50_000}" for i in range(100_000)]
    most = 0
    for first in range(0, 16):
        store.add(B.word_keys([f"{first}-{i}" for i in range(100_000)]), ids)
        most = max(most, sum(own.nbytes for own in (store.keys, store.used, store.start, store.size)) + len(store.buffer))
    assert most < 32 << 20


def test_words_of_several_portions_are_encoded_once(codec, reference, monkeypatch):
    """A query has a price of its own: quarters of a megabyte, each with queries for itself, were a third slower."""
    queries = []
    ask = codec._ask
    monkeypatch.setattr(codec, "_ask", lambda query, *rest: queries.append(query) or ask(query, *rest))
    texts = [f"nurhier{i % 7}mal neuxwort{chr(97 + i % 5)}, neuxwort{chr(97 + i % 3)}." + " und so" * 20_000 for i in range(8)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], ["doc_id", "text"])
    (parts,) = B._lookups(iter([batch.slice(0, 5), batch.slice(5)]), B.ROUND_TRIP_PORTION)
    assert len(parts) == 5
    ids = [own for some in codec.encode_parts(map(B._texts, parts)) for own in some]
    assert [B.as_array(own).tolist() for own in ids] == [reference.encode_ordinary(t) for t in texts]
    assert queries.count(B.ENCODE) == 1


def test_lookups_hold_every_row_once():
    batches = [
        pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(texts, pa.string())], ["doc_id", "text"])
        for n, texts in ((4, ["x" * 600_000, None, "y" * 3_000_000, ""]), (0, []), (2, [None, "z"]))
    ]
    lists = list(B._lookups(iter(batches), B.PORTION))
    assert [[row for part in parts for row in B._texts(part)] for parts in lists] == [
        ["x" * 600_000, "", "y" * 3_000_000],
        ["", "", "z"],
    ]
    assert list(B._lookups(iter([]), B.PORTION)) == [] and list(B._lookups(iter(batches[1:2]), B.PORTION)) == []


def test_longest_words_of_the_short_way(codec, reference):
    """Their places just fit beside the rank in a pair's key."""
    for alphabet in ("ab", "etaoin", "éè"):
        word = "".join(random.Random(7).choices(alphabet, k=B.LONG_BYTES // len(alphabet[0].encode())))
        assert len(word.encode()) == B.LONG_BYTES
        assert codec.encode_words([word]) == [",".join(map(str, reference.encode_ordinary(word)))]


def test_a_sign_does_not_make_another_word():
    stretches = B.STRETCH.findall("Wort, Wort. Wort Wort's Wort,Wort Wort.")
    assert stretches == ["Wort", ",", " Wort", ".", " Wort", " Wort's", " Wort,Wort", " Wort", "."]


def test_separators_that_only_python_takes_for_blanks(codec, reference):
    rng = random.Random(8)
    pieces = ["\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\u2028", " ", "\n", ",", ".", "'s", "Wort", "é", "1", "漢"]
    texts = ["Wort,\x1cx", "\x1f's", *("".join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(3000))]
    for text in texts:
        assert [w for s in B.STRETCH.findall(text) for w in codec._words(s)] == codec.pattern.findall(text), repr(text)
    assert [B.as_array(ids).tolist() for ids in codec.encode(texts)] == [reference.encode_ordinary(t) for t in texts]
