"""N-gram Jaccard join: a grouped prefix join over sets of word shingles.

Shingles have one order for all documents, frequent ones last. Two sets that are similar enough
share a shingle among the first of each, their prefixes. Documents of the same prefix and size
are one group, and documents of the same set one class. Candidates come from prefixes of groups,
are filtered by size and by place in the order, expanded to classes and verified on the texts.

Components come first. Every group meets the pivot of its prefix shingles, the most usual of the
documents there, and members of a group meet one of them. What shares enough prefix shingles
across the components found so far is compared next, and then no pair of different components
is linked. Links are found within components: those too large for one task are dealt to blocks,
and every two blocks meet in a task of their own.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexibid.llm.common import (
    SLICED_BATCHES,
    discard,
    flag_members,
    located,
    membership_filter,
    place,
    release_memory,
    rows_without,
    session_settings,
    slices,
    text_or_empty,
    written,
)
from lexibid.llm.components import smallest_labels

# Words in a shingle, and the similarity from which documents are linked, in percent.
WORDS = 5
PERCENT = 75

#: Shingles are counted by the upper bits of their hash: the order's size depends on nothing else.
ORDER_BITS = 22
ORDER_SIZE = 1 << ORDER_BITS
ORDER_BLOCK = 1 << 12
ORDER_ROWS = 32
NARROW = {np.dtype(kind).itemsize: np.dtype(kind) for kind in ("u1", "u2", "u4", "i8")}
#: Shingles and classes in a block of a component, of which two meet in a task.
UNIT_SHINGLES = 1 << 18
UNIT_CLASSES = 1 << 10
UNIT_COLUMNS = ["grp", "k", "block", "label", "cls", "size"]
#: A shingle is counted by matrices if more than one in so many pairs of sets share it.
DENSE = 256
MATRIX_COLUMNS = 1 << 10
PAIRS_AT_ONCE = 1 << 20
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: A group's number has its usualness in the upper bits and a hash below.
HASH_BITS = 52
MOST_USUAL = (1 << (63 - HASH_BITS)) - 1


def _odd_numbers() -> np.ndarray:
    """A multiplier for every place in a shingle, from a rule."""
    return np.array([xxhash.xxh3_64_intdigest(bytes([i])) | 1 for i in range(WORDS)], dtype=np.uint64)


MULTIPLIERS = _odd_numbers()
SEED = MULTIPLIERS[0]
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of a value."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one text after another, and how many words each has.

    A-Z is lower case and words end at ASCII blanks. A word is hashed by eight bytes at a time,
    the same step for many words at once, and a long one by itself.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words = lists.flatten()
    ends = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    start, size = ends[:-1], np.diff(ends)
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    whole = size > 0  # blanks at either end of a text leave an empty string there
    start, size, owner = start[whole], size[whole], owner[whole]
    raw = words.buffers()[2]
    raw = np.append(np.frombuffer(raw, dtype=np.uint8) if raw else np.zeros(0, dtype=np.uint8), np.zeros(8, dtype=np.uint8))
    eight = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    hashes = size.astype(np.uint64)
    live, at = np.arange(len(size)), start
    left = np.where(size <= LONG_WORD, size, 0)
    while len(live):
        more = left > 0
        live, at, left = live[more], at[more], left[more]
        hashes[live] = _mixed((hashes[live] + SEED) ^ (eight[at] & FIRST_BYTES[np.minimum(left, 8)]))
        at, left = at + 8, left - 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(raw[start[i] : start[i] + size[i]])
    return hashes, np.bincount(owner, minlength=len(lists))


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of all texts, sorted within each, and how many each text has."""
    hashes, words = word_hashes(texts)
    begin = np.cumsum(words) - words
    padded = np.append(hashes, np.zeros(WORDS - 1, dtype=np.uint64))
    sums = hashes * MULTIPLIERS[0]
    for i in range(1, WORDS):
        sums += padded[i : len(hashes) + i] * MULTIPLIERS[i]
    short = np.flatnonzero((words > 0) & (words < WORDS))
    whole = words[short].astype(np.uint64)
    for i in range(WORDS - 1):
        has = words[short] > i
        whole[has] += hashes[begin[short[has]] + i] * MULTIPLIERS[i]
    sums[begin[short]] = whole

    sizes = np.where(words < WORDS, np.minimum(words, 1), words - WORDS + 1)
    ends = np.cumsum(sizes)
    found = _mixed(sums[np.repeat(begin - (ends - sizes), sizes) + np.arange(sizes.sum())])
    for first, last in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        found[first:last].sort()
    new = np.ones(len(found), dtype=bool)
    new[1:] = found[1:] != found[:-1]
    new[(ends - sizes)[sizes > 0]] = True
    return found[new], np.bincount(np.repeat(np.arange(len(sizes)), sizes)[new], minlength=len(sizes))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Of every text the sorted distinct 64-bit hashes of its shingles; empty without words."""
    found, sizes = shingles(texts)
    ends = np.cumsum(sizes)
    return [found[first:last] for first, last in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def shingle_set(text: str | None) -> np.ndarray:
    return shingle_sets(pa.array([text], pa.string()))[0]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets are similar enough, in whole numbers."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def prefix_size(n: int) -> int:
    """So many first shingles of a set of n must hold one of any set it is linked with."""
    return n - (PERCENT * n + 99) // 100 + 1


def _narrow(counts: np.ndarray) -> np.ndarray:
    """``counts`` in the narrowest whole numbers that hold them."""
    return counts.astype(next(kind for kind in NARROW.values() if counts.max() <= np.iinfo(kind).max))


def frequency_order(texts: DataFrame) -> bytes:
    """A class per hash value, higher for those whose shingles are in more documents than usual.

    Counts are over all documents, added up within tasks and then across them. The order
    decides how many candidates there are and not which pairs are linked, so it may be coarse.
    """

    def count(batches):
        counts, seen = np.zeros(ORDER_SIZE, dtype=np.uint32), 0
        for batch in batches:
            for part in slices(batch, "text"):
                found = shingles(part.column("text"))[0]
                seen += len(found)
                if seen > np.iinfo(counts.dtype).max:
                    counts = counts.astype(np.int64)
                np.add.at(counts, (found >> np.uint64(64 - ORDER_BITS)).astype(np.int64), counts.dtype.type(1))
        blocks = counts.reshape(-1, ORDER_BLOCK)
        for first in range(0, len(blocks), ORDER_ROWS):
            raw = [_narrow(own).tobytes() for own in blocks[first : first + ORDER_ROWS]]
            block = np.arange(first, first + len(raw), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(raw, pa.binary())], ["block", "counts"])
        del counts, blocks
        release_memory()

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                own = np.frombuffer(raw, dtype=NARROW[len(raw) // ORDER_BLOCK])
                if block in sums:
                    sums[block] += own
                else:
                    sums[block] = own.astype(np.int64)
        raw = [s.astype(np.float32).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(raw, pa.binary())], ["block", "counts"])

    counted = texts.mapInArrow(count, "block int, counts binary").repartition("block")
    with session_settings(texts.sparkSession, SLICED_BATCHES):
        rows = counted.mapInArrow(add, "block int, counts binary").collect()  # ORDER_SIZE numbers, whatever the input
    totals = np.zeros(ORDER_SIZE, dtype=np.float32)
    for row in rows:
        totals[row.block * ORDER_BLOCK : (row.block + 1) * ORDER_BLOCK] = np.frombuffer(row.counts, dtype=np.float32)
    usual = totals.mean(dtype=np.float64)
    excess = (totals - usual) / (2 * np.sqrt(usual) + 2)
    return np.floor(np.log2(np.maximum(2 * excess, 1))).astype(np.uint8).tobytes()


SIGNATURES = "doc_id bigint, file string, row bigint, n bigint, grp bigint, cls binary, prefix array<bigint>"


def signatures(rows: DataFrame, order) -> DataFrame:
    """Of every row its set's size, group, class and prefix, in the order of the broadcast classes."""

    def sign(batches):
        classes = np.frombuffer(order.value, dtype=np.uint8)
        for batch in (part for whole in batches for part in slices(whole, "text")):
            sizes, groups, ids, prefixes = [], [], [], []
            for found in shingle_sets(batch.column("text")):
                n = len(found)
                sizes.append(n)
                if not n:
                    groups.append(None)
                    ids.append(None)
                    prefixes.append([])
                    continue
                # hashes are sorted, so a stable sort by class keeps them in order within one
                own = classes[found >> np.uint64(64 - ORDER_BITS)]
                by_class = np.argsort(own, kind="stable")
                prefix = found[by_class[: prefix_size(n)]].view(np.int64)
                usual = min(MOST_USUAL, int(100 * own.mean()))
                hashed = xxhash.xxh3_64_intdigest(prefix.tobytes(), seed=n) >> (64 - HASH_BITS)
                groups.append((usual << HASH_BITS) + hashed)
                ids.append(xxhash.xxh3_128_digest(found.tobytes()))
                prefixes.append(prefix)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("file"),
                    batch.column("row"),
                    pa.array(sizes, pa.int64()),
                    pa.array(groups, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                ["doc_id", "file", "row", "n", "grp", "cls", "prefix"],
            )
        release_memory()

    with session_settings(rows.sparkSession, SLICED_BATCHES):
        return written(rows.select("doc_id", "file", "row", "text").mapInArrow(sign, SIGNATURES), "jaccard-signatures")


def _sizes_fit(n: str, m: str) -> Column:
    return F.expr(f"100 * least({n}, {m}) >= {PERCENT} * greatest({n}, {m})")


def _suffix(n: str) -> str:
    """How many shingles of a set of n are not in its prefix."""
    return f"(({PERCENT} * {n} + 99) div 100 - 1)"


def _enough_shared(shared: str, n: str, m: str, suffixes: str) -> Column:
    """Whether sets of n and m can be linked if their prefixes share no more than so many shingles.

    A linked pair shares at least PERCENT / (100 + PERCENT) of n + m. Of the set whose prefix ends
    first, shared shingles are in both prefixes or in its suffix; ``suffixes`` is the larger suffix.
    """
    return F.expr(f"{100 + PERCENT} * ({shared} + {suffixes}) >= {PERCENT} * ({n} + {m})")


def one_per_group(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``signed`` that stand for their groups, and a few others.

    A filter of fixed size over the places of one document per group lets them through without
    a join. What else it lets through only makes ``shared_postings`` count more as shared.
    """
    ones = classes.groupBy("grp").agg(F.min(F.struct("file", "row")).alias("at")).select("at.file", "at.row")
    members = membership_filter(ones.select(place("file", "row")), "place")
    return flag_members(signed.withColumn("place", place("file", "row")), "place", members).where("_maybe")


def shared_postings(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Prefix shingles that several groups have: ``token, grp, n, pivot, left``.

    Each token's pivot is the group with the largest number: documents made of what many
    have come before edited ones. ``left`` is how many such tokens the group has from this one on,
    rare ones first: what two groups share is at most what either has left at the first
    token they share. The first shuffle carries a row per token and task; a filter of fixed
    size then holds back tokens of one group, so little is joined.
    """
    postings = one_per_group(signed, classes).select("grp", "n", F.explode("prefix").alias("token"))
    pivots = written(
        postings.groupBy("token")
        .agg(F.max("grp").alias("pivot"), F.min("grp").alias("other"), F.count(F.lit(1)).alias("df"))
        .where("other < pivot")
        .select("token", "pivot", "df"),
        "jaccard-pivots",
    )
    maybe = flag_members(postings, "token", membership_filter(pivots, "token")).where("_maybe").drop("_maybe")
    frequent_first = Window.partitionBy("grp").orderBy(F.desc("df"), F.desc("token"))
    rows = maybe.join(pivots, "token").withColumn("left", F.row_number().over(frequent_first))
    found = written(rows.select("token", "grp", "n", "pivot", "left"), "jaccard-postings")
    discard(pivots)
    return found


def class_table(signed: DataFrame) -> DataFrame:
    """One row per set: ``cls, grp, n, doc_id`` (the smallest), number of documents, and the place of one."""
    return written(
        signed.where("n > 0")
        .groupBy("cls")
        .agg(
            F.min("grp").alias("grp"),
            F.min("n").alias("n"),
            F.min("doc_id").alias("doc_id"),
            F.count(F.lit(1)).alias("size"),
            F.min(F.struct("file", "row")).alias("at"),
        )
        .select("cls", "grp", "n", "doc_id", "size", "at.file", "at.row"),
        "jaccard-classes",
    )


def with_texts(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """``wanted`` (``file, row`` and others) with the ``text`` stored there.

    Other texts are not moved: a filter of fixed size over the places holds them back.
    """
    members = membership_filter(wanted.select(place("file", "row")), "place")
    flagged = flag_members(rows.withColumn("place", place("file", "row")), "place", members)
    return flagged.where("_maybe").select("file", "row", "text").join(wanted, ["file", "row"])


def verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """The ``pairs`` (``a, b`` of classes) that are linked, by the whole texts of one document each."""
    asked = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    wanted = written(classes.join(asked, "cls", "left_semi").select("cls", "file", "row"), "jaccard-asked")
    texts = written(with_texts(wanted, rows).select("cls", "text"), "jaccard-texts")

    def verify(batches):
        for batch in (part for whole in batches for part in slices(whole, "text_a", "text_b")):
            # rows come in order of b
            b = batch.column("b").to_pylist()
            new = [i for i in range(len(b)) if not i or b[i] != b[i - 1]]
            of_b = np.repeat(np.arange(len(new)), np.diff([*new, len(b)]))
            sets_a, sets_b = shingle_sets(batch.column("text_a")), shingle_sets(batch.column("text_b").take(pa.array(new)))
            keep = [i for i, (own, k) in enumerate(zip(sets_a, of_b.tolist(), strict=True)) if linked(own, sets_b[k])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(pa.array(keep, pa.int64())), batch.column("b").take(pa.array(keep, pa.int64()))],
                ["a", "b"],
            )
        release_memory()

    with_a = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    with_both = with_a.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    with session_settings(rows.sparkSession, SLICED_BATCHES):
        found = written(with_both.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a binary, b binary"), "jaccard-links")
    discard(wanted, texts)
    return found


def _pivot_pairs(postings: DataFrame, classes: DataFrame) -> DataFrame:
    """Every class with one class of a pivot of its group, and with one of its own group.

    A pivot is worth a look if the tokens whose pivot it is are enough for a link by themselves.
    What is left out here is open to the comparison across components.
    """
    ones = classes.groupBy("grp").agg(F.min("cls").alias("one"), F.first("n").alias("pivot_n"))
    met = (
        postings.where("grp <> pivot")
        .groupBy("grp", "pivot")
        .agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("together"))
        .join(ones.withColumnRenamed("grp", "pivot"), "pivot")
        .where(_sizes_fit("n", "pivot_n"))
        .where(_enough_shared("together", "n", "pivot_n", f"greatest({_suffix('n')}, {_suffix('pivot_n')})"))
        .select("grp", "one")
    )
    return written(
        classes.select("grp", "cls")
        .join(met.unionByName(ones.select("grp", "one")), "grp")
        .where("cls <> one")
        .select(F.col("cls").alias("a"), F.col("one").alias("b")),
        "jaccard-pairs",
    )


def _open_pairs(postings: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of classes in different components whose prefixes may share enough shingles.

    Tokens within one component are gone before anything is paired, and so are rows that have
    too little left for any size at their token. Components are paired per token first, then
    expanded, so members of one component never meet. Every linked pair has enough left at
    the first token it shares, so it is found there at least.
    """
    placed = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select(
        "grp", "cls", F.coalesce("label", "cls").alias("label")
    )
    rows = postings.join(placed, "grp").select("token", "n", "left", F.expr(_suffix("n")).alias("suffix"), "cls", "label")
    spanning = (
        rows.groupBy("token")
        .agg(
            F.min("label").alias("first_label"),
            F.max("label").alias("last_label"),
            F.min("n").alias("least_n"),
            F.max("suffix").alias("most_suffix"),
        )
        .where("first_label < last_label")
        .select("token", "least_n", "most_suffix")
    )
    partner = f"greatest(least_n, ({PERCENT} * n + 99) div 100)"
    largest = f"greatest(suffix, least(most_suffix, {_suffix(f'(100 * n div {PERCENT})')}))"
    rows = written(
        rows.join(spanning, "token").where(_enough_shared("left", "n", partner, largest)).drop("least_n", "most_suffix"),
        "jaccard-open",
    )
    sides = rows.groupBy("token", "label").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("left").alias("left"), F.max("suffix").alias("suffix")
    )
    of_a, of_b = (sides.select("token", *(F.col(c).alias(f"{c}_{side}") for c in sides.columns[1:])) for side in "ab")
    met = (
        of_a.join(of_b, "token")
        .where("label_a < label_b")
        .where(f"100 * most_a >= {PERCENT} * least_b and 100 * most_b >= {PERCENT} * least_a")
        .where(_enough_shared("least(left_a, left_b)", "least_a", "least_b", "greatest(suffix_a, suffix_b)"))
        .select("token", "label_a", "label_b")
    )
    a, b = (
        rows.select(
            "token",
            F.col("label").alias(f"label_{side}"),
            F.col("cls").alias(side),
            *(F.col(c).alias(f"{c}_{side}") for c in ("n", "left", "suffix")),
        )
        for side in "ab"
    )
    across = (
        met.join(a, ["token", "label_a"])
        .join(b, ["token", "label_b"])
        .where(_sizes_fit("n_a", "n_b"))
        .where(_enough_shared("least(left_a, left_b)", "n_a", "n_b", "greatest(suffix_a, suffix_b)"))
        .select("a", "b")
    )
    # A group's own tokens need not be in any other, so its classes are compared as they are.
    split = (
        placed.groupBy("grp")
        .agg(F.min("label").alias("first_label"), F.max("label").alias("last_label"))
        .where("first_label < last_label")
        .select("grp")
    )
    members = placed.join(split, "grp", "left_semi")
    c, d = (members.select("grp", F.col("label").alias(f"label_{x}"), F.col("cls").alias(x)) for x in "ab")
    within = c.join(d, "grp").where("label_a < label_b").select("a", "b")
    pairs = written(across.union(within).distinct(), "jaccard-pairs")
    discard(rows)
    return pairs


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many shingles every set of ``a`` shares with every one of ``b``.

    Shingles that many of both have are columns of two matrices whose product counts them; of all
    others the few pairs of sets that have them are counted one by one, some at a time.
    """
    size = len(a) * len(b)
    _, token = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    in_a = np.repeat(np.arange(len(a)), [len(own) for own in a])
    in_b = np.repeat(np.arange(len(b)), [len(own) for own in b])
    of_a, of_b = token[: len(in_a)], token[len(in_a) :]
    kinds = int(token.max(initial=-1)) + 1
    df_a, df_b = np.bincount(of_a, minlength=kinds), np.bincount(of_b, minlength=kinds)
    counts = np.zeros((len(a), len(b)), dtype=np.int64)

    frequent = df_a * df_b * DENSE > size
    columns = np.flatnonzero(frequent)
    rank = np.cumsum(frequent) - 1
    for first in range(0, len(columns), MATRIX_COLUMNS):
        width = min(MATRIX_COLUMNS, len(columns) - first)
        factors = []
        for tokens, owner, sets in ((of_a, in_a, a), (of_b, in_b, b)):
            own = frequent[tokens] & (rank[tokens] >= first) & (rank[tokens] < first + width)
            factor = np.zeros((len(sets), width), dtype=np.float32)
            factor[owner[own], rank[tokens[own]] - first] = 1
            factors.append(factor)
        counts += (factors[0] @ factors[1].T).astype(np.int64)

    by_token = np.argsort(of_b, kind="stable")
    owners, begin = in_b[by_token], np.cumsum(df_b) - df_b
    rare = np.flatnonzero(~frequent[of_a] & (df_b[of_a] > 0))
    repeats = df_b[of_a[rare]]
    done = np.cumsum(repeats)
    first = 0
    while first < len(rare):
        last = max(first + 1, int(np.searchsorted(done, done[first] - repeats[first] + PAIRS_AT_ONCE, side="right")))
        own, many = rare[first:last], repeats[first:last]
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        met = np.repeat(in_a[own], many) * len(b) + owners[np.repeat(begin[of_a[own]], many) + nth]
        counts += np.bincount(met, minlength=size).reshape(counts.shape)
        first = last
    return counts


def _blocks_met(table: pa.Table):
    """Per component in a unit: its rows on one side and on the other, and which of them are linked.

    A unit of one block meets itself, so each of its pairs is there twice.
    """
    label = np.array(table.column("label").to_pylist(), dtype=object)
    block, i, j = (table.column(c).to_numpy() for c in ("block", "i", "j"))
    sets = [np.frombuffer(raw, dtype=np.uint64) for raw in table.column("hashes").to_pylist()]
    _, component = np.unique(label, return_inverse=True)
    order = np.argsort(component, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(component[order])) + 1):
        twice = i[rows[0]] == j[rows[0]]
        a, b = (rows, rows) if twice else (rows[block[rows] == i[rows]], rows[block[rows] == j[rows]])
        if len(a) and len(b):
            shared = shared_counts([sets[r] for r in a], [sets[r] for r in b])
            sizes = [np.array([len(sets[r]) for r in side], dtype=np.int64) for side in (a, b)]
            linked_sets = 100 * shared >= PERCENT * (sizes[0][:, None] + sizes[1] - shared)
            if twice:
                np.fill_diagonal(linked_sets, False)
            yield a, b, twice, linked_sets, shared


def component_units(classes: DataFrame, labels: DataFrame, rows: DataFrame) -> DataFrame:
    """The sets of all classes in components of several, dealt to units of bounded size in which they meet.

    ``grp, i, j`` is a unit, ``block`` the row's own, ``label`` its component. Small components go
    together by a hash. A large one has k blocks by a hash of its classes, and each block meets
    each once: its sets are sent k times, and no task has more than two blocks.
    """
    linked_classes = classes.join(labels.withColumnRenamed("node", "cls"), "cls")
    sizes = linked_classes.groupBy("label").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    sizes = written(
        sizes.where("members > 1").select(
            "label",
            "shingles",
            F.ceil(F.greatest(F.col("shingles") / UNIT_SHINGLES, F.col("members") / UNIT_CLASSES)).alias("k"),
        ),
        "jaccard-sizes",
    )
    small = sizes.where("k = 1").agg(F.sum("shingles")).first()[0] or 0
    units = 1 + int(small) // UNIT_SHINGLES
    wanted = written(
        linked_classes.join(sizes, "label").select(
            "file",
            "row",
            "cls",
            "size",
            "label",
            "k",
            F.when(F.col("k") == 1, F.pmod(F.xxhash64("label"), F.lit(units))).otherwise(F.xxhash64("label")).alias("grp"),
            F.pmod(F.xxhash64("cls"), F.col("k")).alias("block"),
        ),
        "jaccard-members",
    )

    def as_sets(batches):
        for batch in (part for whole in batches for part in slices(whole, "text")):
            raw = [own.tobytes() for own in shingle_sets(batch.column("text"))]
            kept = [batch.column(c) for c in UNIT_COLUMNS]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(raw, pa.binary())], [*UNIT_COLUMNS, "hashes"])
        release_memory()

    texts = with_texts(wanted, rows).select(*UNIT_COLUMNS, "text")
    sets = texts.mapInArrow(as_sets, "grp bigint, k bigint, block bigint, label binary, cls binary, size bigint, hashes binary")
    partner = F.explode(F.expr("sequence(0L, k - 1)")).alias("partner")
    # a unit of small components and one of a large one are told apart by i
    i = F.when(F.col("k") == 1, F.lit(-1)).otherwise(F.least("block", "partner")).cast("bigint")
    j = F.when(F.col("k") == 1, F.lit(-1)).otherwise(F.greatest("block", "partner")).cast("bigint")
    return sets.select("*", partner).select("grp", i.alias("i"), j.alias("j"), "block", "label", "cls", "size", "hashes")


def links_of_classes(units: DataFrame) -> DataFrame:
    """How many classes and documents of other classes every class in ``units`` is linked with: ``cls, classes, documents``."""

    def count(table: pa.Table) -> pa.Table:
        size = table.column("size").to_numpy()
        classes, documents = np.zeros(len(size), dtype=np.int64), np.zeros(len(size), dtype=np.int64)
        for a, b, twice, is_linked, _ in _blocks_met(table):
            classes[a] += is_linked.sum(axis=1)
            documents[a] += is_linked @ size[b]
            if not twice:
                classes[b] += is_linked.sum(axis=0)
                documents[b] += size[a] @ is_linked
        return pa.table([table.column("cls"), pa.array(classes), pa.array(documents)], ["cls", "classes", "documents"])

    parts = units.groupBy("grp", "i", "j").applyInArrow(count, "cls binary, classes bigint, documents bigint")
    return parts.groupBy("cls").agg(F.sum("classes").alias("classes"), F.sum("documents").alias("documents"))


def linked_pairs(units: DataFrame) -> DataFrame:
    """Every pair of linked classes once: ``a, b, shared``, the number of shingles that both have."""

    def pairs(table: pa.Table) -> pa.Table:
        cls, found = table.column("cls"), [[np.zeros(0, dtype=np.int64)] * 3]
        for a, b, twice, is_linked, shared in _blocks_met(table):
            x, y = np.nonzero(np.triu(is_linked) if twice else is_linked)
            found.append([a[x], b[y], shared[x, y]])
        a, b, both = (np.concatenate(column) for column in zip(*found, strict=True))
        return pa.table([cls.take(pa.array(a)), cls.take(pa.array(b)), pa.array(both)], ["a", "b", "shared"])

    return units.groupBy("grp", "i", "j").applyInArrow(pairs, "a binary, b binary, shared bigint")


def located_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, file, row, text`` of ``docs``."""
    return located(docs).select(
        F.col("content.doc_id").cast("bigint").alias("doc_id"), "file", "row", text_or_empty(F.col("content.text")).alias("text")
    )


def signed_components(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows (see ``located_texts``), their classes, and ``node, label`` of every linked class."""
    spark = rows.sparkSession
    order = spark.sparkContext.broadcast(frequency_order(rows.select("text")))
    signed = signatures(rows, order)
    classes = class_table(signed)
    postings = shared_postings(signed, classes)

    pairs = _pivot_pairs(postings, classes)
    links = verified(pairs, classes, rows)
    so_far = smallest_labels(links)
    open_pairs = _open_pairs(postings, classes, so_far)
    discard(pairs, postings, so_far)
    more = verified(open_pairs, classes, rows)
    labels = smallest_labels(links.union(more))
    discard(open_pairs, links, more)
    return signed, classes, labels


def _of_rows(signed: DataFrame, of_class: DataFrame) -> DataFrame:
    """Rows with what is known of their class; rows without shingles have nulls there."""
    filled = signed.where("n > 0").select("doc_id", "file", "row", "n", "cls").join(of_class, "cls").drop("cls")
    names = filled.columns[4:]
    none = [F.lit(None).cast(filled.schema[c].dataType).alias(c) for c in names]
    return filled.unionByName(signed.where("n = 0").select("doc_id", "file", "row", "n", *none))


def _named_components(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``cls, class_id, size, component, component_id`` of every class."""
    named = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", F.col("doc_id").alias("class_id"), "size", F.coalesce("label", "cls").alias("component")
    )
    ids = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    return named.join(ids, "component")


def linked_documents(rows: DataFrame) -> DataFrame:
    """Component of every row (see ``located_texts``): ``doc_id, file, row, n, component, component_id``.

    ``component`` is a name of the component; ``component_id`` its smallest doc_id, null if none has
    an id. Rows with the same set are linked. A text that is null or has no words has an
    empty set and is linked with nothing: its component is null and its id its own.
    """
    signed, classes, labels = signed_components(rows)
    of_class = written(
        _named_components(classes, labels).select("cls", "component", "component_id"), "jaccard-components"
    )
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    return _of_rows(signed, of_class).select("doc_id", "file", "row", "n", "component", own)


def similar_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The whole join: all links between classes, and which document is in which class.

    The first has ``a, b, shared``, names of classes of equal sets that are linked, every pair once,
    and the number of shingles that both have. The second has ``doc_id, cls, n`` of every row, ``n``
    being the size of its set; ``cls`` is null without words. Rows of one class are linked too.
    """
    rows = located_texts(docs)
    signed, classes, labels = signed_components(rows)
    return linked_pairs(component_units(classes, labels, rows)), signed.select("doc_id", "cls", "n")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` but for all but one of each component, columns unchanged.

    The row with the smallest doc_id stays, rows without id last; of rows that repeat it the
    first by where it is stored. Rows linked with nothing all stay.
    """
    rows = located(docs)
    found = written(linked_documents(located_texts(docs)).where("component is not null"), "jaccard-found")
    key = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "file", "row")
    stays = found.groupBy("component").agg(F.min(key).alias("stays"))
    dropped = found.join(stays, "component").where("file <> stays.file or row <> stays.row")
    return rows_without(rows, dropped).select("content.*")


def component_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, class_id, n_links``.

    ``class_id`` is the smallest id among documents of the same set, and ``n_links`` the number of other
    documents that this one is linked with. ``docs`` has at least ``doc_id`` and ``text``; other
    columns may have any names. Null and empty texts and those without words are linked with
    nothing. Rows that repeat an id are rows of their own, and ids are null where a class or
    component has none. No rows give no rows.
    """
    rows = located_texts(docs)
    signed, classes, labels = signed_components(rows)
    links = written(links_of_classes(component_units(classes, labels, rows)), "jaccard-counts")
    of_class = written(
        _named_components(classes, labels)
        .join(links, "cls", "left")
        .select(
            "cls",
            "component_id",
            "class_id",
            (F.col("size") - 1 + F.coalesce("documents", F.lit(0))).alias("n_links"),
        ),
        "jaccard-components",
    )
    empty = F.col("n") == 0
    return _of_rows(signed, of_class).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
    )
