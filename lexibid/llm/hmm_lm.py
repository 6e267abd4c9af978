"""Language-model scoring by a hidden Markov model.

Texts are encoded in blocks: a block has a vocabulary of its own, so that what is known of a word
comes to it once per block and not once per token. Baum-Welch begins with codes: frequent words
have their own, all others that of a class by their ending, so a round is one pass over the
training texts and a small table of expected counts. The last round counts for every learned word
by itself, summed over all blocks by Spark: its emissions are a table of words, joined to the
blocks, in which the scaled forward recursion gives the exact likelihood of every text.
"""

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexibid.llm.common import SLICED_BATCHES, discard, release_memory, session_settings, slices, text_or_empty, written
from lexibid.llm.lockstep import groups

# The held-out fold (remainder and modulus) and the weight of what was never seen.
FOLD, FOLDS = 1, 5
UNSEEN = 0.5

#: States of the model, and what its first rounds tell apart: frequent words, and classes of all others.
STATES = 8
FREQUENT = 8191
CLASSES = 64
#: Rounds over codes; one over all words follows.
ROUNDS = 4
#: Where training starts: how likely a state stays, and how much a word's chance varies by state.
STAY = 0.8
SPREAD = 0.9
#: Expected counts of this weight by overall frequency keep every code possible in every state.
PRIOR = 10.0
#: So many tokens of a word are taken to be in states as all tokens are, besides those that it has.
EVEN = 2.0
#: Expected counts are summed as whole multiples of this, so that sums do not depend on their order.
GRAIN = 1e-6

#: Steps of the histogram of word counts per doubling.
HISTOGRAM_STEPS = 16

#: Characters in a block, and tokens worked through side by side.
BLOCK_CHARS = 1 << 25
LOCKSTEP_TOKENS = 1 << 18
#: Chances are scaled at every so many tokens: in between they stay far above the least double.
SCALE_STEPS = 8
#: Tokens that are met with those before them at once.
PAIRS_AT_ONCE = 1 << 14

END = 0
CODES = 1 + FREQUENT + CLASSES
#: Names the end of a text where words are named by a hash: no word is empty.
END_WORD = ""

#: Shares are sent in 255ths; a word's leaning to a state is a power of two in these steps, from 2 to the minus 8.
SHARES = 255
LEAN_STEPS, LEAN_LEAST = 16, -8

BLOCKS = "block bigint, doc_id bigint, held_out boolean, learn boolean, ids binary, idx int, word string, n bigint"


def words_of_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one text after another, A-Z in lower case, and how many each text has."""
    texts = texts.cast(pa.string())
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[bounds[0] : bounds[-1]] if raw else np.zeros(0, dtype=np.uint8)
    bounds = bounds - bounds[0]
    inside = (data != 0x20) & (data - np.uint8(0x09) > 0x0D - 0x09)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    begins[heads] = inside[heads]  # a word ends with its text
    counts = np.diff(np.searchsorted(np.flatnonzero(begins), bounds))
    offsets = np.append(np.flatnonzero(begins[inside]), np.count_nonzero(inside)).astype(np.int32)
    lowered = data[inside].tobytes().lower()
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(lowered)), counts


def _no(count: int, kind: pa.DataType) -> pa.Array:
    return pa.nulls(count, kind)


def blocks(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents as numbers of words in their block's vocabulary, and the vocabularies.

    A row is either a document (``ids`` set) or a word (``word`` set) with its place and the
    number of times that texts to learn from have it. A block is part of a task, of about so
    many characters.
    """

    def encode(batches):
        def rows(held):
            block = uuid.uuid4().int >> 65
            texts, words = [], []
            for batch in held:
                found, sizes = words_of_texts(batch.column("text"))
                words.append(found)
                texts.append((*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "learn")), sizes))
            numbered = pa.chunked_array(words, pa.string()).dictionary_encode().chunks
            vocabulary = numbered[0].dictionary if numbered else pa.array([], pa.string())
            ids = np.concatenate([np.zeros(0, dtype=np.int32), *(part.indices.to_numpy() for part in numbered)])
            del words, numbered
            counts = np.zeros(len(vocabulary), dtype=np.int64)
            done = 0
            for doc_id, held_out, learn, sizes in texts:
                ends = done + np.cumsum(sizes)
                own = ids[done : done + sizes.sum()]
                counts += np.bincount(own[np.repeat(np.array(learn, dtype=bool), sizes)], minlength=len(counts))
                done += len(own)
                encoded = [ids[first:last].tobytes() for first, last in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                n = len(doc_id)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, block)),
                        pa.array(doc_id, pa.int64()),
                        pa.array(held_out, pa.bool_()),
                        pa.array(learn, pa.bool_()),
                        pa.array(encoded, pa.binary()),
                        _no(n, pa.int32()),
                        _no(n, pa.string()),
                        _no(n, pa.int64()),
                    ],
                    NAMES,
                )
            for start in range(0, len(vocabulary), 50_000):
                part = vocabulary[start : start + 50_000]
                m = len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(m, block)),
                        _no(m, pa.int64()),
                        _no(m, pa.bool_()),
                        _no(m, pa.bool_()),
                        _no(m, pa.binary()),
                        pa.array(np.arange(start, start + m, dtype=np.int32)),
                        part,
                        pa.array(counts[start : start + m]),
                    ],
                    NAMES,
                )

        yield from _by_block(batches, rows, block_chars)
        release_memory()

    NAMES = [field.split()[0] for field in BLOCKS.split(", ")]
    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.crc32(F.col("doc_id").cast("string")) % FOLDS).alias("fold"),
        text_or_empty("text").alias("text"),
    ).select(
        "doc_id",
        F.coalesce(F.col("fold") == FOLD, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("fold") != FOLD, F.lit(False)).alias("learn"),
        "text",
    )
    with session_settings(docs.sparkSession, SLICED_BATCHES):
        return written(slim.mapInArrow(encode, BLOCKS), "lm-blocks")


def _by_block(batches, rows, block_chars: int):
    """``rows`` of parts of the batches that have about so many characters, batch by batch."""
    source = (part for batch in batches for part in slices(batch, "text"))
    following = next(source, None)
    while following is not None:

        def part():
            nonlocal following
            size = 0
            while following is not None and size < block_chars:
                batch = following
                size += pc.sum(pc.utf8_length(batch.column("text"))).as_py()
                following = next(source, None)
                yield batch

        yield from rows(part())


@dataclass(frozen=True)
class Corpus:
    """What was counted: training tokens, distinct ones, texts, the frequent words' counts by code,
    and per class the weight of its known words."""

    tokens: int
    distinct: int
    texts: int
    frequent: list[int]
    class_weight: np.ndarray

    @property
    def whole(self) -> float:
        """All training tokens and the weight of what was never seen."""
        return self.tokens + UNSEEN * (self.distinct + 1)

    def code_weights(self) -> np.ndarray:
        """Training tokens of each code, what was never seen included."""
        weights = np.full(CODES, UNSEEN)
        weights[END] += self.texts
        weights[1 : 1 + len(self.frequent)] += self.frequent
        weights[1 + len(self.frequent) : 1 + FREQUENT] = 0
        weights[1 + FREQUENT :] += self.class_weight
        return weights


def _word_class() -> Column:
    """A word's class: a hash of its last two characters."""
    return F.pmod(F.xxhash64(F.expr("right(word, 2)")), F.lit(CLASSES)).cast("int")


def most_frequent(words: DataFrame) -> list:
    """The FREQUENT words of the largest counts, ``word, c``, ties by word.

    A histogram of the counts says first from where on there are enough, so that tasks send
    little more than these words to be sorted and not as many each.
    """
    step = F.floor(F.log2("c") * HISTOGRAM_STEPS)
    histogram = words.groupBy(step.alias("step")).count().collect()  # as many steps as counts have logarithms
    enough, least = 0, 0
    for row in sorted(histogram, reverse=True):
        enough, least = enough + row["count"], row.step
        if enough >= FREQUENT:
            break
    return words.where(step >= least).orderBy(F.desc("c"), "word").limit(FREQUENT).select("word", "c").collect()


def counted(table: DataFrame) -> tuple[DataFrame, Corpus]:
    """The words of all blocks (see ``blocks``) with what is known of them, and the corpus counts.

    ``block, idx, c, code, key``: the count over all training texts, the code, and a hash of the word. Counts
    are added up word by word and joined back, so a common word is one row per block and is
    split like any other hot key.
    """
    spark = table.sparkSession
    words = table.where("word is not null")
    known = written(words.where("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")
    texts = table.where("learn").count()
    frequent = most_frequent(known)
    codes = spark.createDataFrame([(row.word, 1 + i) for i, row in enumerate(frequent)], "word string, code int")
    coded = known.join(F.broadcast(codes), "word", "left")  # FREQUENT rows
    sums = known.agg(F.sum("c"), F.count(F.lit(1))).first()
    class_weight = np.zeros(CLASSES)
    rare = coded.where("code is null").groupBy(_word_class().alias("class"))
    for row in rare.agg(F.sum(F.col("c") + F.lit(UNSEEN)).alias("weight")).collect():  # CLASSES rows
        class_weight[row["class"]] = row.weight
    corpus = Corpus((sums[0] or 0) + texts, sums[1] + (texts > 0), texts, [row.c for row in frequent], class_weight)
    rows = written(
        words.select("block", "idx", "word")
        .join(coded, "word", "left")
        .select(
            "block",
            "idx",
            F.coalesce("c", F.lit(0)).cast("bigint").alias("c"),
            F.coalesce("code", _word_class() + (1 + FREQUENT)).cast("int").alias("code"),
            F.xxhash64("word").alias("key"),
        ),
        "lm-words",
    )
    discard(known)
    return rows, corpus


def _column(words_of: pa.Table, name: str, kind) -> np.ndarray:
    """A column of a block's words, by place."""
    found = np.zeros(words_of.num_rows, dtype=kind)
    found[words_of.column("idx").to_numpy()] = words_of.column(name).to_numpy()
    return found


def _texts_of(table: DataFrame) -> DataFrame:
    return table.where("ids is not null").select("block", "doc_id", "held_out", "learn", "ids")


def training_codes(table: DataFrame, words: DataFrame) -> DataFrame:
    """``codes`` of every text to learn from, its end included."""

    def encode(texts_of: pa.Table, words_of: pa.Table) -> pa.Table:
        code = _column(words_of, "code", np.uint16)
        found = [np.append(code[np.frombuffer(raw, dtype=np.int32)], np.uint16(END)) for raw in texts_of.column("ids").to_pylist()]
        return pa.table([pa.array([own.tobytes() for own in found], pa.binary())], ["codes"])

    texts = _texts_of(table).where("learn").groupBy("block")
    joined = texts.cogroup(words.select("block", "idx", "code").groupBy("block")).applyInArrow(encode, "codes binary")
    return written(joined, "lm-codes")


@dataclass(frozen=True)
class Model:
    """Chances of the first state, of state after state, and of a code in a state (codes x states)."""

    first: np.ndarray
    after: np.ndarray
    emit: np.ndarray


def starting_model(weights: np.ndarray) -> Model:
    """States that stay, and words whose chances vary by state: by a rule, so that reruns agree."""
    raw = xxhash.xxh3_64_intdigest(b"hmm")
    vary = np.random.Generator(np.random.PCG64(raw)).random((len(weights), STATES))
    emit = weights[:, None] * (1 + SPREAD * (2 * vary - 1))
    after = np.full((STATES, STATES), (1 - STAY) / (STATES - 1))
    np.fill_diagonal(after, STAY)
    return Model(np.full(STATES, 1 / STATES), after, emit / emit.sum(axis=0))


def forward(model: Model, codes: np.ndarray, counts: np.ndarray):
    """Per group of texts: the group, scaled state chances and scales of every token, log likelihoods.

    Chances are scaled to one in all at every SCALE_STEPS-th token and at a text's last one; elsewhere the scale is 1.
    """
    total = np.ones((STATES, 1))
    for group in groups(counts, LOCKSTEP_TOKENS):
        emitted = np.take(model.emit, codes[group.items], axis=0)
        chances = np.empty_like(emitted)
        scales = np.ones((len(emitted), 1))
        bounds = group.slices.tolist()
        going_on = [*group.active.tolist()[1:], 0]
        before = chances[:0]
        for t, (begin, end, n) in enumerate(zip(bounds[:-1], bounds[1:], going_on, strict=True)):
            own = chances[begin:end]
            if t:
                np.dot(before[: end - begin], model.after, out=own)
                own *= emitted[begin:end]
            else:
                np.multiply(model.first, emitted[begin:end], out=own)
            first = begin if t % SCALE_STEPS == 0 else begin + n
            if first < end:
                chances[first:end] /= np.dot(chances[first:end], total, out=scales[first:end])
            before = own
        yield group, emitted, chances, scales[:, 0]


def log10_likelihoods(model: Model, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The exact log10 probability of every sequence of codes."""
    scores = np.zeros(len(counts))
    owner = np.repeat(np.arange(len(counts)), counts)
    for group, _, _, scales in forward(model, codes, counts):
        scaled = np.flatnonzero(scales != 1)
        scores += np.bincount(owner[group.items[scaled]], weights=np.log10(scales[scaled]), minlength=len(counts))
    return scores


def expected_counts(
    model: Model, codes: np.ndarray, counts: np.ndarray, slots: np.ndarray | None = None, size: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How often states come first, follow each other and emit codes in these texts (the E-step).

    What is emitted is counted by ``slots`` of the tokens, of which there are ``size``; by their codes if not given.
    """
    first, after = np.zeros(STATES), np.zeros((STATES, STATES))
    slots, size = (codes, len(model.emit)) if slots is None else (slots, size)
    emit = np.zeros((STATES, size))
    back = model.after.T.copy()
    for group, emitted, chances, scales in forward(model, codes, counts):
        # From the back: what emits and follows, over what was seen, then the chances given the whole text.
        ahead = emitted
        scaled = np.flatnonzero(scales != 1)
        ahead[scaled] /= scales[scaled, None]
        later = np.ones_like(chances)
        bounds = group.slices.tolist()
        for t in range(group.steps - 1, 0, -1):
            begin, end = bounds[t], bounds[t + 1]
            own = ahead[begin:end]
            own *= later[begin:end]
            np.dot(own, back, out=later[bounds[t - 1] : bounds[t - 1] + end - begin])
        # a token's place in its text, one before, is as far behind as that place has texts
        came = np.arange(bounds[1], bounds[-1]) - np.repeat(group.active[:-1], group.active[1:])
        for begin in range(0, len(came), PAIRS_AT_ONCE):
            before = np.take(chances, came[begin : begin + PAIRS_AT_ONCE], axis=0)
            after += before.T @ ahead[bounds[1] + begin : bounds[1] + begin + len(before)]
        chances *= later
        share = np.empty((STATES, len(chances)))
        for begin in range(0, len(chances), PAIRS_AT_ONCE):
            share[:, begin : begin + PAIRS_AT_ONCE] = chances[begin : begin + PAIRS_AT_ONCE].T
        first += share[:, group.at(0)].sum(axis=1)
        own = slots[group.items]
        for k in range(STATES):
            emit[k] += np.bincount(own, weights=share[k], minlength=size)
    return first, after * model.after, emit.T


def _sequences(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(raw, dtype=np.uint16) for raw in batch.column("codes").to_pylist()]
    return np.concatenate(parts).astype(np.int64), np.array([len(p) for p in parts], dtype=np.int64)


def _slices(batch: pa.RecordBatch):
    """Parts of a batch that are worked through side by side."""
    sizes = np.array([len(raw) // 2 for raw in batch.column("codes").to_pylist()])
    if not len(sizes):
        return
    part = (np.cumsum(sizes) - sizes) // (4 * LOCKSTEP_TOKENS)
    bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        yield batch.slice(begin, end - begin)


STATE_COLUMNS = [f"s{k}" for k in range(STATES)]


def baum_welch(texts: DataFrame, corpus: Corpus, rounds: int = ROUNDS) -> Model:
    """Train on the ``codes`` of all rows of ``texts``.

    A round is one pass: tasks send their expected counts, a row per code and some for the
    states, and Spark adds them up; what reaches the driver is of the size of the model.
    No rows leave the starting model as it is.
    """
    spark = texts.sparkSession
    weights = corpus.code_weights()
    model = starting_model(weights)
    overall = weights / weights.sum()
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def expect(batches, shared=shared):
            first, after, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CODES, STATES))
            for batch in batches:
                for part in _slices(batch):
                    own = expected_counts(shared.value, *_sequences(part))
                    first, after, emit = first + own[0], after + own[1], emit + own[2]
            whole = np.rint(np.vstack([emit, after, first]) / GRAIN).astype(np.int64)
            rows = np.flatnonzero(whole.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows.astype(np.int32)), *(pa.array(whole[rows, k]) for k in range(STATES))],
                ["slot", *STATE_COLUMNS],
            )
            release_memory()

        kinds = ", ".join(f"{c} bigint" for c in STATE_COLUMNS)
        sums = (
            texts.select("codes")
            .mapInArrow(expect, f"slot int, {kinds}")
            .groupBy("slot")
            .agg(*(F.sum(c).alias(c) for c in STATE_COLUMNS))
            .toArrow()
        )
        table = np.zeros((CODES + STATES + 1, STATES))
        slots = sums.column("slot").to_numpy()
        for k, column in enumerate(STATE_COLUMNS):
            table[slots, k] = sums.column(column).to_numpy()
        table *= GRAIN
        shared.unpersist()
        if not len(slots):
            return model
        emit = table[:CODES] + PRIOR * overall[:, None]
        after = table[CODES : CODES + STATES] + model.after
        first = table[-1] + 1 / STATES
        model = Model(first / first.sum(), after / after.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model


def _parts(texts_of: pa.Table):
    """Slices of a block's texts that are worked through side by side, each with its texts' words and their numbers."""
    whole = texts_of.combine_chunks()
    for batch in whole.to_batches():
        for part in slices(batch, "ids", most=16 * LOCKSTEP_TOKENS):
            ids = [np.frombuffer(raw, dtype=np.int32) for raw in part.column("ids").to_pylist()]
            yield part, ids, np.array([len(own) + 1 for own in ids], dtype=np.int64)


def _with_ends(ids: list[np.ndarray], end: int) -> np.ndarray:
    return np.concatenate([part for own in ids for part in (own, [end])]).astype(np.int64)


def word_shares(table: DataFrame, words: DataFrame, model: Model) -> DataFrame:
    """The last round: in which states every learned word is, over all training texts.

    ``key, c, e0, e1`` and so on: the word's hash, its count, and its expected count in each state. A block sends
    a row per word, with the word's shares of the states packed into one number.
    """
    shared = table.sparkSession.sparkContext.broadcast(model)
    end_key = _key(END_WORD)

    def expect(texts_of: pa.Table, words_of: pa.Table) -> pa.Table:
        code, key = _column(words_of, "code", np.int64), _column(words_of, "key", np.int64)
        code, key = np.append(code, END), np.append(key, end_key)
        size = len(key)
        emit, count = np.zeros((STATES, size)).T, np.zeros(size, dtype=np.int64)
        for _, ids, counts in _parts(texts_of):
            slots = _with_ends(ids, size - 1)
            emit += expected_counts(shared.value, code[slots], counts, slots, size)[2]
            count += np.bincount(slots, minlength=size)
        used = np.flatnonzero(count)
        share = np.rint(emit[used] / count[used, None] * SHARES).astype(np.uint8)
        packed = np.ascontiguousarray(share).view(np.int64)[:, 0]
        return pa.table([pa.array(key[used]), pa.array(count[used]), pa.array(packed)], ["key", "n", "packed"])

    texts = _texts_of(table).where("learn").groupBy("block")
    known = words.select("block", "idx", "code", "key").groupBy("block")
    rows = texts.cogroup(known).applyInArrow(expect, "key bigint, n bigint, packed bigint")
    states = [F.expr(f"sum(n * (shiftright(packed, {8 * k}) & 255))").alias(f"e{k}") for k in range(STATES)]
    sums = rows.groupBy("key").agg(F.sum("n").alias("c"), *states)
    total = F.expr(" + ".join(f"e{k}" for k in range(STATES)))
    return written(
        sums.select("key", "c", *((F.col("c") * F.col(f"e{k}") / total).alias(f"e{k}") for k in range(STATES))), "lm-shares"
    )


def _key(word: str) -> int:
    """As Spark's xxhash64 has it."""
    return int(np.uint64(xxhash.xxh64_intdigest(word.encode(), seed=42)).astype(np.int64))


@dataclass(frozen=True)
class Emissions:
    """Chances of states, which words lean towards or away from, and what states emit in all.

    A state emits a word by (c + UNSEEN) * chance * lean over its total. A word that was never seen leans nowhere.
    """

    first: np.ndarray
    after: np.ndarray
    chance: np.ndarray
    total: np.ndarray
    end: np.ndarray

    def of(self, count: np.ndarray, packed: np.ndarray) -> np.ndarray:
        """Words x states, from counts and packed leanings; the end of a text comes last."""
        steps = np.ascontiguousarray(packed).view(np.uint8).reshape(-1, STATES).astype(np.float64)
        lean = np.where(count[:, None] > 0, np.exp2(steps / LEAN_STEPS + LEAN_LEAST), 1.0)
        own = (count[:, None] + UNSEEN) * lean
        return np.concatenate([own, self.end[None]]) * (self.chance / self.total)


def _lean_steps(k: int, chance: float) -> Column:
    """How much likelier a word is in a state than all tokens are, as a number of steps from 0 to 255."""
    ratio = (F.col(f"e{k}") + EVEN * chance) / ((F.col("c") + EVEN) * chance)
    steps = F.round((F.log2(ratio) - LEAN_LEAST) * LEAN_STEPS)
    return F.greatest(F.least(steps, F.lit(255.0)), F.lit(0.0)).cast("bigint")


def _exact_sum(value: Column) -> Column:
    """A sum that does not depend on the order of the rows."""
    return F.sum(value.cast("decimal(38,6)"))


def emissions(shares: DataFrame, model: Model) -> tuple[DataFrame, Emissions]:
    """``key, packed`` of every learned word, and what all words share.

    Every word has its own leaning: its expected counts, and EVEN tokens as all tokens are. A
    state's chances of all words, and of what was never seen, add up to one.
    """
    sums = shares.agg(*(_exact_sum(F.col(f"e{k}")) for k in range(STATES))).first()
    counts = np.array([float(x or 0) for x in sums]) + 1e-3
    chance = counts / counts.sum()
    steps = [_lean_steps(k, float(chance[k])) for k in range(STATES)]
    packed = steps[0]
    for k in range(1, STATES):
        packed = packed.bitwiseOR(F.shiftleft(steps[k], 8 * k))
    words = shares.select("key", "c", packed.alias("packed"), *(s.alias(f"l{k}") for k, s in enumerate(steps)))
    weight = [
        _exact_sum((F.col("c") + UNSEEN) * F.pow(F.lit(2.0), F.col(f"l{k}") / LEAN_STEPS + LEAN_LEAST)) for k in range(STATES)
    ]
    total = chance * (np.array([float(x or 0) for x in words.agg(*weight).first()]) + UNSEEN)
    end = words.where(F.col("key") == _key(END_WORD)).select("c", "packed").first()
    known = Emissions(model.first, model.after, chance, total, np.full(STATES, UNSEEN))
    if end:
        known = Emissions(model.first, model.after, chance, total, known.of(np.array([end.c]), np.array([end.packed]))[0] / (chance / total))
    return words.select("key", "packed"), known


def scored(table: DataFrame, words: DataFrame, leanings: DataFrame, known: Emissions, corpus: Corpus) -> DataFrame:
    """Every text with its base score and the model's log10 probability of it.

    ``leanings`` (``key, packed``) come to the words of the blocks by a join, and those to the texts of theirs.
    """
    shared = table.sparkSession.sparkContext.broadcast(known)
    whole = corpus.whole
    end_score = float(np.log10((corpus.texts + UNSEEN) / whole))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def run(texts_of: pa.Table, words_of: pa.Table) -> pa.Table:
        count, packed = _column(words_of, "c", np.int64), _column(words_of, "packed", np.int64)
        base = np.log10((count + UNSEEN) / whole)
        model = Model(shared.value.first, shared.value.after, shared.value.of(count, packed))
        parts = []
        for part, ids, counts in _parts(texts_of):
            score = log10_likelihoods(model, _with_ends(ids, len(count)), counts)
            columns = [
                pa.array(counts),
                pa.array([int((count[own] > 0).sum()) + (corpus.texts > 0) for own in ids], pa.int64()),
                pa.array([float(base[own].sum()) + end_score for own in ids], pa.float64()),
                pa.array(score),
            ]
            parts.append(pa.table([part.column("doc_id"), part.column("held_out"), *columns], names))
        return pa.concat_tables(parts)

    kinds = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    own = words.select("block", "idx", "c", "key").join(leanings, "key", "left")
    known_words = own.select("block", "idx", "c", F.coalesce("packed", F.lit(0).cast("bigint")).alias("packed"))
    return _texts_of(table).groupBy("block").cogroup(known_words.groupBy("block")).applyInArrow(run, kinds)


def score_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``docs`` has at least ``doc_id`` and ``text``; others are ignored. A null text is empty and has
    its end as its only token. Rows without id are neither held out nor learned from. Rows that
    repeat an id count by their own texts, so a repeated text is learned as often as it is there. Words of
    equal counts are frequent in order of the words. Texts are looked at whole, whatever their
    length. With nothing to learn from, all words are as likely as the end. No rows give no rows.
    """
    table = blocks(docs)
    words, corpus = counted(table)
    codes = training_codes(table, words)
    model = baum_welch(codes, corpus)
    discard(codes)
    leanings, known = emissions(word_shares(table, words, model), model)
    return scored(table, words, leanings, known, corpus).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(corpus.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
