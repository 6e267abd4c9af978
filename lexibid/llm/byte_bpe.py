"""Byte-level BPE: encoding by recursive queries, decoding by an ordered aggregation.

Each partition holds the merge table in an embedded DuckDB. The distinct words of a portion of
texts become rows (word, position, token). A recursive query joins neighbouring tokens with the
merge table and contracts the leftmost pair of minimum rank of each word until no pair is
left. Decoding joins tokens with the vocabulary and aggregates their bytes in order.
"""

import base64
import hashlib
import re
from collections import defaultdict
from collections.abc import Collection, Iterable, Iterator
from itertools import filterfalse

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexibid.llm.common import release_memory

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

#: Characters of text handled at once, and where encoder and decoder hold them at the same time.
PORTION = 1 << 20
ROUND_TRIP_PORTION = PORTION // 4
#: Characters of text whose words are looked up together: more take fewer queries and more memory.
LOOKUP = PORTION
#: A recursive query returns all its rounds: a word has a round per token at most, and words of one
#: query stay below this sum of squared lengths.
QUERY_SQUARES = 1_000_000
#: Words a worker remembers, in about 50 bytes each, besides those of the portion at hand.
KNOWN_WORDS = 500_000
#: Words longer than this are contracted in many places at once, so many rows per query.
LONG_BYTES = 512
LONG_ROWS = 4_000_000

#: Letters of scripts that are long settled: a word of the pattern, with at most a blank before them.
LETTERS = f"[{''.join(filter(str.isalpha, map(chr, range(0x530))))}]"
WORD = re.compile(f" ?{LETTERS}++")
#: A token never holds a blank after something else, so every such place parts words. What lies
#: between two of them is split by PATTERN alone, whatever surrounds it. Letters with one sign
#: behind them, as most words before a sign are, are parted from it at once. Four control characters
#: are blanks to Python's patterns, but none to PATTERN.
BLANK, OTHER = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
STRETCH = re.compile(rf"{WORD.pattern}(?=[.,;:!?]?(?:{BLANK}|\Z))|{BLANK}*{OTHER}+|{BLANK}+")

# Rows know the place and the token after them. The key of a pair is its rank and position in one
# number, so a word's least key is its leftmost pair of minimum rank. Contracting it changes that
# row and the one before and drops the one after; only changed rows look for a rank again. Words
# without a pair left come out in round -1. Rows of all rounds are kept to the end, so they are
# narrow: a place is below 1024, as words up to LONG_BYTES have it.
ENCODE = """
    WITH RECURSIVE bpe(round, word, pos, tok, next_pos, after, key) AS (
        SELECT 0::smallint, word, pos, tok, next_pos, after, m.rank * 1024 + pos
        FROM words LEFT JOIN merges m ON m.pair = tok::bigint * 65536 + after
        UNION ALL (
        WITH first AS (
            SELECT word, min(key) AS key, arg_min(next_pos, key) AS gone
            FROM bpe WHERE round >= 0 GROUP BY word HAVING min(key) IS NOT NULL
        ), contracted AS (
            SELECT first.word, (first.key % 1024)::smallint AS pos, gone, first.key // 1024 AS tok, bpe.next_pos, bpe.after
            FROM first JOIN bpe ON bpe.word = first.word AND bpe.pos = gone
        ), changed AS (
            SELECT (CASE WHEN gone IS NULL THEN -1 ELSE round + 1 END)::smallint AS round, word, bpe.pos,
                CASE WHEN bpe.pos = c.pos THEN c.tok ELSE bpe.tok END AS tok,
                CASE WHEN bpe.pos = c.pos THEN c.next_pos ELSE bpe.next_pos END AS next_pos,
                CASE WHEN bpe.pos = c.pos THEN c.after WHEN bpe.next_pos = c.pos THEN c.tok ELSE bpe.after END AS after,
                key, bpe.pos = c.pos OR bpe.next_pos = c.pos AS is_new
            FROM bpe LEFT JOIN contracted c USING (word) WHERE round >= 0 AND bpe.pos IS DISTINCT FROM gone
        )
        SELECT round, word, pos, tok, next_pos, after, CASE WHEN is_new THEN m.rank * 1024 + pos ELSE key END
        FROM changed LEFT JOIN merges m ON m.pair = CASE WHEN is_new THEN tok::bigint * 65536 + after END)
    )
    SELECT array_to_string(list(tok ORDER BY pos), ',') AS ids FROM bpe WHERE round = -1 GROUP BY word ORDER BY word
"""

# No token of the word's bytes is longer than {reach}. What could touch a pair before it is contracted
# becomes part of a token with its left or with its right one, so it begins within that reach before
# the pair, or within twice the reach behind: a long word need not wait for its one minimum. Equal
# pairs go together if what they make can never go before them (calm); where they overlap, every
# second one, from the left, once the whole run so far comes first. The query stops after some
# rounds and is asked again with what it has.
CONTRACT_LONG = """
    WITH RECURSIVE bpe(round, pos, tok, after) AS (
        SELECT 0, pos, tok, lead(tok) OVER (ORDER BY pos) FROM words
        UNION ALL (
        WITH paired AS (
            SELECT bpe.*, m.rank, (m.rank::bigint << 32) + CASE WHEN m.calm THEN 0 ELSE pos END AS key,
                row_number() OVER (ORDER BY pos) AS place
            FROM bpe LEFT JOIN merges m ON m.pair = bpe.tok::bigint * 65536 + bpe.after
        ), judged AS (
            SELECT *, key IS NOT NULL AND key = min(key) OVER (
                ORDER BY pos RANGE BETWEEN {reach} PRECEDING AND 2 * {reach} FOLLOWING) AS first
            FROM paired
        ), marked AS (
            SELECT *, rank IS DISTINCT FROM lag(rank) OVER (ORDER BY pos) AS is_start FROM judged
        ), runs AS (
            SELECT *,
                max(CASE WHEN is_start THEN place END) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS start,
                max(CASE WHEN NOT first THEN place ELSE 0 END) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS waits
            FROM marked
        ), hits AS (
            SELECT *, first AND (place - start) % 2 = 0 AND waits < start AS hit FROM runs
        ), contracted AS (
            SELECT round, pos, CASE WHEN hit THEN rank ELSE tok END AS tok,
                lag(hit, 1, false) OVER (ORDER BY pos) AS swallowed
            FROM hits WHERE round < {rounds} AND (SELECT bool_or(hit) FROM hits)
        )
        SELECT round + 1, pos, tok, lead(tok) OVER (ORDER BY pos) FROM contracted WHERE NOT swallowed)
    )
    SELECT pos, tok FROM bpe WHERE round = (SELECT max(round) FROM bpe) ORDER BY pos
"""

# One character per byte, so a token of any bytes is a string.
DECODE = """
    SELECT array_to_string(list(v.characters ORDER BY t.pos), '') AS characters
    FROM tokens t JOIN vocabulary v USING (tok) GROUP BY t.text ORDER BY t.text
"""


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def word_keys(words: list[str]) -> np.ndarray:
    """128 bits of hash per word, as two numbers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), dtype=np.uint64).reshape(-1, 2)


class Store:
    """Ids of words by their keys, in a few arrays and one buffer; beyond ``most`` the half used last stays."""

    def __init__(self, most: int = KNOWN_WORDS):
        self.most = most
        self.clock = 0
        self.keys = np.zeros((0, 2), dtype=np.uint64)  # by the first number
        self.used = np.zeros(0, dtype=np.int32)
        self.start = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int32)
        self.buffer = ""

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is, -1 for unknown ones."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys[:, 0], keys[:, 0]), len(self.keys) - 1)
        found = np.where((self.keys[at] == keys).all(axis=1), at, -1)
        self.clock += 1
        self.used[found[found >= 0]] = self.clock
        return found

    def ids(self, found: np.ndarray) -> list[str]:
        """Ids of each word that was found, empty for the others."""
        known = found >= 0
        start = np.where(known, self.start[found] if len(self.start) else 0, 0)
        end = start + np.where(known, self.size[found] if len(self.size) else 0, 0)
        buffer = self.buffer
        return [buffer[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]

    def add(self, keys: np.ndarray, ids: list[str]) -> None:
        if len(self.keys) + len(ids) > self.most:
            self._keep(np.argsort(-self.used, kind="stable")[: self.most // 2])
        size = np.array([len(own) for own in ids], dtype=np.int32)
        start = len(self.buffer) + np.cumsum(size, dtype=np.int64) - size
        order = np.argsort(keys[:, 0], kind="stable")
        at = np.searchsorted(self.keys[:, 0], keys[order, 0])
        self.keys = np.insert(self.keys, at, keys[order], axis=0)
        self.used = np.insert(self.used, at, self.clock)
        self.start = np.insert(self.start, at, start[order])
        self.size = np.insert(self.size, at, size[order])
        self.buffer += "".join(ids)

    def _keep(self, rows: np.ndarray) -> None:
        rows = np.sort(rows)
        kept = "".join("".join(self.ids(some)) for some in np.array_split(rows, 16))
        self.keys, self.used, self.size = self.keys[rows], self.used[rows], self.size[rows]
        self.start = np.cumsum(self.size, dtype=np.int64) - self.size
        self.buffer = kept


class Codec:
    """The tables of one vocabulary, and the words encoded so far, for one Python worker."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.pattern = regex.compile(pattern)
        self.known = Store()
        self.reach = max(map(len, self.ranks))
        self.byte_tokens = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.duck = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        left, right, rank = self._splits()
        restless = np.concatenate([part[part >= rank] for part in (left, right)])
        self._table(
            "merges",
            {"pair": left * 65536 + right, "rank": rank.astype(np.int32), "calm": ~np.isin(rank, restless)},
        )
        self.tokens = np.array(list(self.ranks.values()), dtype=np.int32)
        self._table("vocabulary", {"tok": self.tokens, "characters": [t.decode("latin-1") for t in self.ranks]})

    def _splits(self) -> np.ndarray:
        """All pairs of tokens that make another one: left, right and what they make."""
        found = (
            (self.ranks[t[:i]] << 40) + (self.ranks[t[i:]] << 20) + rank
            for t, rank in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        )
        packed = np.fromiter(found, dtype=np.int64)
        return np.stack([packed >> 40, packed >> 20 & 0xFFFFF, packed & 0xFFFFF])

    def _table(self, name: str, columns: dict) -> None:
        self.duck.register("given", pa.table(columns))
        self.duck.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.duck.unregister("given")

    def _ask(self, query: str, name: str, columns: dict) -> pa.Table:
        self.duck.register(name, pa.table(columns))
        try:
            return self.duck.sql(query).to_arrow_table()
        finally:
            self.duck.unregister(name)

    def _encode_short(self, words: list[bytes]) -> list[str]:
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        first = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        pos = (np.arange(len(data)) - np.repeat(first, lengths)).astype(np.int16)
        tok = self.byte_tokens[data]
        after = np.append(tok[1:], 0).astype(np.int32)
        rows = {
            "word": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
            "pos": pos,
            "tok": tok,
            "next_pos": pos + 1,
            "after": pa.array(after, mask=pos + 1 == np.repeat(lengths, lengths)),
        }
        return self._ask(ENCODE, "words", rows).column("ids").to_pylist()

    def _encode_long(self, word: bytes) -> str:
        alphabet = set(word)
        reach = max((len(t) for t in self.ranks if alphabet.issuperset(t)), default=1)
        pos, tok = np.arange(len(word)), self.byte_tokens[np.frombuffer(word, dtype=np.uint8)]
        while True:
            query = CONTRACT_LONG.format(reach=reach, rounds=max(1, LONG_ROWS // len(pos)))
            after = self._ask(query, "words", {"pos": pos, "tok": tok})
            if len(after) == len(pos):
                return ",".join(map(str, tok.tolist()))
            pos, tok = after.column("pos").to_numpy(), after.column("tok").to_numpy()

    def encode_words(self, words: list[str]) -> list[str]:
        """Ids of each word, joined by commas."""
        encoded = [""] * len(words)
        held: list[tuple[int, bytes]] = []
        squares = 0

        def settle():
            for (i, _), ids in zip(held, self._encode_short([raw for _, raw in held]), strict=True):
                encoded[i] = ids
            held.clear()

        for i, word in enumerate(words):
            raw = word.encode()
            if raw in self.ranks:
                encoded[i] = str(self.ranks[raw])
            elif len(raw) > LONG_BYTES:
                encoded[i] = self._encode_long(raw)
            else:
                held.append((i, raw))
                squares += len(raw) ** 2
                if squares >= QUERY_SQUARES:
                    settle()
                    squares = 0
        if held:
            settle()
        return encoded

    def _ids_of(self, words: list[str]) -> dict[str, str]:
        """Ids of each word, those of new words by a query and all others from the store."""
        keys = word_keys(words)
        found = self.known.find(keys)
        missing = np.flatnonzero(found < 0)
        ids = self.known.ids(found)
        new = self.encode_words([words[i] for i in missing])
        for i, own in zip(missing.tolist(), new, strict=True):
            ids[i] = own
        self.known.add(keys[missing], new)
        return dict(zip(words, ids, strict=True))

    def _words(self, stretch: str) -> list[str]:
        """The matches of the pattern. A word of letters need not ask it."""
        return [stretch] if WORD.fullmatch(stretch) else self.pattern.findall(stretch)

    def _encode_stretches(self, stretches: Collection[str]) -> list[str]:
        split = {s: self._words(s) for s in filterfalse(WORD.fullmatch, stretches)}
        words = set(stretches).difference(split).union(*split.values())
        ids = self._ids_of(list(words))
        ids |= {s: ",".join([ids[w] for w in words]) for s, words in split.items()}
        return list(map(ids.__getitem__, stretches))

    def encode_parts(self, parts: Iterable[list[str]]) -> Iterator[list[str]]:
        """For each list of texts the ids of each text, joined by commas; empty for an empty text.

        What is equal in any of the lists is looked up once. Texts are kept as numbers of their
        stretches, four bytes each, so that only one list's strings exist at a time.
        """
        number = defaultdict()
        number.default_factory = number.__len__
        numbered = [
            [np.fromiter(map(number.__getitem__, STRETCH.findall(text)), dtype=np.int32) for text in texts]
            for texts in parts
        ]
        ids = self._encode_stretches(number)
        del number
        for texts in numbered:
            yield [",".join(map(ids.__getitem__, own.tolist())) for own in texts]

    def encode(self, texts: list[str]) -> list[str]:
        """Ids of each text, joined by commas; empty for an empty text."""
        return next(self.encode_parts([texts]))

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each sequence of ids."""
        lengths = np.array([len(own) for own in ids], dtype=np.int64)
        filled = np.flatnonzero(lengths)
        total = int(lengths.sum())
        decoded = [b""] * len(ids)
        rows = {
            "text": np.repeat(np.arange(len(ids), dtype=np.int32), lengths),
            "pos": np.arange(total, dtype=np.int32),
            "tok": np.concatenate([np.zeros(0, dtype=np.int32), *ids]).astype(np.int32),
        }
        unknown = rows["tok"][~np.isin(rows["tok"], self.tokens, kind="table")]
        if len(unknown):
            raise ValueError(f"id {unknown[0]} is not in the vocabulary")
        found = self._ask(DECODE, "tokens", rows).column("characters").to_pylist()
        for i, characters in zip(filled.tolist(), found, strict=True):
            decoded[i] = characters.encode("latin-1")
        return decoded


def as_array(ids: str) -> np.ndarray:
    return np.fromstring(ids, dtype=np.int32, sep=",") if ids else np.zeros(0, dtype=np.int32)


_CODECS: dict[tuple[int, str], Codec] = {}


def _codec(ranks: bytes, pattern: str) -> Codec:
    """The worker's codec: tables are built and words are encoded once, not once per task."""
    key = (hash(ranks), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(ranks, pattern)
    return _CODECS[key]


def _portions(batch: pa.RecordBatch, lengths: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose rows are of about ``most`` together, or one row that is longer."""
    sizes = np.asarray(lengths.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // most
    bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        if end > begin:
            yield batch.slice(begin, end - begin)


def _text_portions(batch: pa.RecordBatch, most: int = PORTION) -> Iterator[pa.RecordBatch]:
    return _portions(batch, pc.utf8_length(batch.column("text")), most)


def _lookups(batches: Iterator[pa.RecordBatch], portion: int, most: int = LOOKUP) -> Iterator[list[pa.RecordBatch]]:
    """Portions of all batches, in lists of about ``most`` characters together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in _text_portions(batch, portion):
            held.append(part)
            size += pc.sum(pc.utf8_length(part.column("text"))).as_py() or 0
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def _texts(part: pa.RecordBatch) -> list[str]:
    return [t or "" for t in part.column("text").to_pylist()]


def _slim(docs: DataFrame, column: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), column)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``doc_id, ids (array of int)`` of every row of ``docs`` (``doc_id, text``, others ignored).

    As the tiktoken library does without special tokens: each match of ``pattern`` is encoded
    separately, and one that is a token itself is that token. A null text is empty and has no ids.
    """
    ranks = _shared_ranks(docs.sparkSession, vocabulary)

    def run(batches):
        codec = _codec(ranks.value, pattern)
        for parts in _lookups(batches, PORTION):
            for part, ids in zip(parts, codec.encode_parts(map(_texts, parts)), strict=True):
                arrays = pa.array([as_array(own) for own in ids], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), arrays], ["doc_id", "ids"])

    return _slim(docs, "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, bytes`` of every row of ``encoded`` (``doc_id, ids``). Null ids are empty; an unknown id is an error."""
    ranks = _shared_ranks(encoded.sparkSession, vocabulary)

    def run(batches):
        codec = _codec(ranks.value, PATTERN)
        for batch in batches:
            for part in _portions(batch, pc.list_value_length(batch.column("ids")), PORTION // 4):
                ids = [np.array(own or [], dtype=np.int32) for own in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(codec.decode(ids), pa.binary())], ["doc_id", "bytes"]
                )

    return _slim(encoded, "ids").mapInArrow(run, "doc_id bigint, bytes binary")


def _shared_ranks(spark: SparkSession, vocabulary: str):
    """The rank file for all tasks. A vocabulary is a fixed file, not data that grows."""
    return spark.sparkContext.broadcast(read_ranks(vocabulary))


REPORT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def round_trip_report(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Every text encoded and decoded again: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Both ways in one pass: ids go from the encoder to the decoder within the task. ``docs`` has at
    least ``doc_id`` and ``text``; others are ignored. A null text is empty: no tokens, and digests
    of nothing. Rows stand for themselves, repeated ones and those without id too; no rows give
    none. Texts are encoded whole, however long; of pairs of one rank the leftmost goes first.
    """
    ranks = _shared_ranks(docs.sparkSession, vocabulary)

    def run(batches):
        codec = _codec(ranks.value, pattern)
        for parts in _lookups(batches, ROUND_TRIP_PORTION):
            for part, ids in zip(parts, codec.encode_parts(map(_texts, parts)), strict=True):
                arrays = [as_array(own) for own in ids]
                columns = [
                    part.column("doc_id"),
                    pa.array([len(own) for own in arrays], pa.int64()),
                    pa.array([hashlib.sha256(own.encode()).hexdigest() for own in ids], pa.string()),
                    pa.array([hashlib.sha256(raw).hexdigest() for raw in codec.decode(arrays)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            release_memory()

    return _slim(docs, "text").mapInArrow(run, REPORT)
