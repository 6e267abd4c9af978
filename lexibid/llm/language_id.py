"""Language identification of words, spans and documents.

A word is a run of letters. Ranges of code points give its script, and only languages that
were learned with that script are candidates. A word's score in a language is the log-likelihood
of its letter trigrams, and Viterbi with a penalty for every change of language labels the
words of a document, so that mixed texts come out as spans.
"""

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexibid.llm.common import release_memory
from lexibid.llm.lockstep import groups

UNDETERMINED = "und"

# Scripts by ranges of code points (first and last); what is in none is "other".
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF),
    ("arabic", 0x0750, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("han", 0x20000, 0x323AF),
    ("hangul", 0xAC00, 0xD7AF),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]

#: Trigrams are counted by a hash of so many values: the model's size depends on nothing else.
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
#: A language is a candidate for a script that has at least this share of its letters.
SCRIPT_SHARE = 0.01
#: What a change of language costs, as a log-likelihood.
SWITCH = 10.0
#: Characters scored at once, and characters of texts labelled together.
PIECE = 1 << 18
PORTION = 1 << 22
#: Words labelled side by side.
VITERBI_WORDS = 1 << 20

LAST = 0x323AF
BLANK = 32


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: its lower case if it is a letter, else a blank; and its script."""
    folded = np.full(LAST + 2, BLANK, dtype=np.uint32)
    script = np.zeros(LAST + 2, dtype=np.uint8)
    for point in range(LAST + 1):
        character = chr(point)
        if character.isalpha():
            folded[point] = ord(character.lower()[0])
    for name, first, last in SCRIPTS:
        script[first : last + 1] = SCRIPT_NAMES.index(name)
    return folded, script


@dataclass(frozen=True)
class Letters:
    """Of a piece of text: trigram bucket and script of every letter, and the words: where each starts
    among the letters and in the piece. The first may go on from before the piece."""

    bucket: np.ndarray
    script: np.ndarray
    first: np.ndarray
    start: np.ndarray
    goes_on: bool


def letters(piece: str, before: str = "", after: str = "") -> Letters:
    """``before`` and ``after`` are the characters next to the piece, if any."""
    folded, script = _tables()
    points = np.frombuffer(f"{before or ' '}{piece}{after or ' '}".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.minimum(points, LAST + 1)
    padded = folded[points]
    is_letter = padded[1:-1] != BLANK
    hashed = padded[:-2] * np.uint32(0x9E3779B1)
    hashed ^= padded[1:-1] * np.uint32(0x85EBCA77)
    hashed ^= padded[2:] * np.uint32(0xC2B2AE3D)
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x2C1B3C6D)
    hashed >>= np.uint32(32 - BUCKET_BITS)
    starts = is_letter.copy()
    starts[1:] &= ~is_letter[:-1]
    return Letters(
        hashed[is_letter].astype(np.int32),
        script[points[1:-1][is_letter]],
        np.flatnonzero(starts[is_letter]),
        np.flatnonzero(starts),
        bool(padded[0] != BLANK and is_letter[:1].any()),
    )


def pieces(text: str):
    """(offset, letters) of parts of PIECE characters. A part may end within a word; its trigrams do not."""
    for start in range(0, len(text), PIECE):
        end = start + PIECE
        yield start, letters(text[start:end], text[start - 1 : start] if start else "", text[end : end + 1])


@dataclass(frozen=True)
class Model:
    """Learned languages in order of name, their trigram log-likelihoods and their scripts."""

    langs: list[str]
    weights: np.ndarray  # languages x BUCKETS
    candidate: np.ndarray  # languages x scripts


def _held_out(remainder: int, modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % modulus == remainder


def train(docs: DataFrame) -> Model:
    """Learn from every row of ``docs`` that has a ``text`` and a ``lang``.

    Counts are added up within tasks, then by Spark; what reaches the driver has
    languages x BUCKETS rows at most. No such rows give a model without languages.
    """

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            texts = pd.DataFrame({"text": batch.column("text"), "lang": batch.column("lang")})
            for lang, own in texts.groupby("lang")["text"]:
                table = counts.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES), dtype=np.int64))
                for _, found in pieces("\n".join(own)):
                    table[:BUCKETS] += np.bincount(found.bucket, minlength=BUCKETS)
                    table[BUCKETS:] += np.bincount(found.script, minlength=len(SCRIPT_NAMES))
        for lang, table in counts.items():
            slots = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slots), pa.string()), pa.array(slots.astype(np.int32)), pa.array(table[slots])],
                ["lang", "slot", "n"],
            )

    labelled = docs.where("lang is not null and text is not null").select("text", "lang")
    sums = (
        labelled.mapInArrow(count, "lang string, slot int, n bigint")
        .groupBy("lang", "slot")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    langs = sorted(set(sums.column("lang").to_pylist()))
    tables = np.zeros((len(langs), BUCKETS + len(SCRIPT_NAMES)))
    which = np.array([langs.index(lang) for lang in sums.column("lang").to_pylist()], dtype=int)
    tables[which, sums.column("slot").to_numpy()] = sums.column("n").to_numpy()
    trigrams, scripts = tables[:, :BUCKETS], tables[:, BUCKETS:]
    weights = np.log((trigrams + 0.5) / (trigrams.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    candidate = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    candidate[:, ~candidate.any(axis=0)] = True  # no language has the script: it tells nothing
    return Model(langs, weights.astype(np.float32), candidate)


@dataclass(frozen=True)
class Words:
    """Words of texts that lie one after another: start, number of letters, and languages x words scores."""

    start: np.ndarray
    letters: np.ndarray
    scores: np.ndarray


def scored_words(text: str, model: Model) -> Words:
    """A word that lies in several pieces is put together again: its letters and scores add up."""
    starts, sizes, scripts, scores = [], [], [], []
    for offset, found in pieces(text):
        if not len(found.first):
            continue
        own = np.empty((len(model.langs), len(found.first)), dtype=np.float32)
        for row, weights in zip(own, model.weights, strict=True):
            np.add.reduceat(weights[found.bucket], found.first, out=row)
        size = np.diff(found.first, append=len(found.bucket))
        skip = int(found.goes_on)
        if skip:
            scores[-1][:, -1] += own[:, 0]
            sizes[-1][-1] += size[0]
        if len(size) > skip:
            starts.append(found.start[skip:] + offset)
            sizes.append(size[skip:])
            scripts.append(found.script[found.first[skip:]])
            scores.append(own[:, skip:])
    if not starts:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, np.zeros((len(model.langs), 0), dtype=np.float32))
    whole = np.concatenate(scores, axis=1)
    whole[~model.candidate[:, np.concatenate(scripts)]] -= 1e6
    return Words(np.concatenate(starts), np.concatenate(sizes), whole)


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The best label of every word; texts lie one after another, ``counts`` words each."""
    labels = np.zeros(scores.shape[1], dtype=np.int16)
    own = np.arange(len(scores), dtype=np.int16)[:, None]
    for group in groups(counts, VITERBI_WORDS):
        own_scores = scores[:, group.items]
        came = np.zeros(own_scores.shape, dtype=np.int16)
        best = own_scores[:, : group.active[0]].astype(np.float64)
        state = np.zeros(len(group.members), dtype=np.int16)
        for t in range(1, group.steps):
            n, here = group.active[t], group.at(t)
            if n < best.shape[1]:
                state[n : best.shape[1]] = best[:, n:].argmax(axis=0)
                best = best[:, :n]
            changed = best.max(axis=0) - penalty
            came[:, here] = np.where(best >= changed, own, best.argmax(axis=0))
            best = np.maximum(best, changed) + own_scores[:, here]
        state[: best.shape[1]] = best.argmax(axis=0)
        label = np.empty(len(group.items), dtype=np.int16)
        for t in range(group.steps - 1, -1, -1):
            n, here = group.active[t], group.at(t)
            label[here] = state[:n]
            state[:n] = came[:, here][state[:n], np.arange(n)]
        labels[group.items] = label
    return labels


@dataclass(frozen=True)
class Labelled:
    """Texts, their words, and which words are whose: text i has those from bound i to bound i+1."""

    words: Words
    labels: np.ndarray
    bounds: np.ndarray
    offsets: np.ndarray


def labelled_words(texts: list[str], model: Model) -> Labelled:
    """The words of all texts with their labels, scored and labelled together."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64) + 1
    offsets = np.cumsum(lengths) - lengths
    words = scored_words("\n".join(texts), model) if model.langs else scored_words("", model)
    bounds = np.append(np.searchsorted(words.start, offsets), len(words.start))
    return Labelled(words, viterbi(words.scores, np.diff(bounds)), bounds, offsets)


def _portions(texts: list):
    """Consecutive texts of about PORTION characters together."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= PORTION:
            yield held
            held, size = [], 0
    if held:
        yield held


def documents_of(found: Labelled, model: Model) -> tuple[list[str], np.ndarray]:
    """Language of most letters and its share of them for every text."""
    texts, size = len(found.offsets), len(model.langs)
    if not size:
        return [UNDETERMINED] * texts, np.zeros(texts)
    owner = np.repeat(np.arange(texts), np.diff(found.bounds))
    letters_in = np.bincount(owner * size + found.labels, weights=found.words.letters, minlength=texts * size)
    letters_in = letters_in.reshape(texts, size)
    total, best = letters_in.sum(axis=1), letters_in.argmax(axis=1)
    names = [model.langs[b] if t else UNDETERMINED for b, t in zip(best, total, strict=True)]
    return names, letters_in.max(axis=1) / np.maximum(total, 1)


def spans_of(found: Labelled, model: Model) -> list[list[dict]]:
    """Runs of words of one language for every text: ``start, end, lang`` in code points, end exclusive."""
    spans = []
    for begin, end, offset in zip(found.bounds[:-1], found.bounds[1:], found.offsets, strict=True):
        labels = found.labels[begin:end]
        first = np.flatnonzero(np.diff(labels, prepend=-1))
        last = np.append(first[1:], len(labels))[: len(first)] - 1
        start = found.words.start[begin:end] - offset
        stop = start + found.words.letters[begin:end]
        spans.append(
            [
                {"start": int(start[a]), "end": int(stop[b]), "lang": model.langs[labels[a]]}
                for a, b in zip(first, last, strict=True)
            ]
        )
    return spans


def _shared(model: Model):
    return SparkSession.active().sparkContext.broadcast(model)


def language(text: Column, model: Model) -> Column:
    """``lang_pred, score`` of a text: the language of most letters and its share of them.

    A text that is null, empty or without letters is ``und`` with score 0, and so is every text
    if no language was learned. Of languages with as many letters the first by name counts.
    """
    shared = _shared(model)

    @F.pandas_udf("lang_pred string, score double")
    def identify(texts: pd.Series) -> pd.DataFrame:
        names, scores = [], [np.zeros(0)]
        for portion in _portions(texts.tolist()):
            own_names, own_scores = documents_of(labelled_words(portion, shared.value), shared.value)
            names += own_names
            scores.append(own_scores)
        release_memory()
        return pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": np.concatenate(scores)})

    return identify(text)


def language_spans(text: Column, model: Model) -> Column:
    """The spans of a text as an array of ``start, end, lang``; empty where ``language`` says ``und``."""
    shared = _shared(model)

    @F.pandas_udf("array<struct<start: bigint, end: bigint, lang: string>>")
    def spans(texts: pd.Series) -> pd.Series:
        found = []
        for portion in _portions(texts.tolist()):
            found += spans_of(labelled_words(portion, shared.value), shared.value)
        return pd.Series(found, dtype=object)

    return spans(text)


#: Fold that is never learned from: the remainder of crc32(doc_id) by the modulus.
FOLD, FOLDS = 2, 4


def train_on_folds(docs: DataFrame) -> Model:
    """Learn from the rows outside the held-out fold; rows without id are not learned from."""
    return train(docs.where(~_held_out(FOLD, FOLDS)))


def language_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    ``docs`` has at least ``doc_id``, ``text`` and ``lang``; others are ignored. Rows without id are
    neither held out nor learned from, rows with a null lang are not learned from. Rows that repeat an
    id count by their own texts. Texts without letters, null and empty ones are ``und``; words
    and texts of any length are looked at whole. No rows give no rows.
    """
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    found = slim.select(
        "doc_id",
        F.coalesce(_held_out(FOLD, FOLDS), F.lit(False)).alias("held_out"),
        language(F.col("text"), train_on_folds(slim)).alias("found"),
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def determined(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language can be told, columns unchanged: ``und`` is rejected."""
    model = train_on_folds(docs.select("doc_id", "text", "lang"))
    rows = docs.select(F.struct("*").alias("content"), language(F.col("text"), model).alias("found"))
    return rows.where(F.col("found.lang_pred") != UNDETERMINED).select("content.*")
