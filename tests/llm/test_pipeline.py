import hashlib
import random
from collections import Counter

import duckdb

import corpus_pipeline
from lexibid.llm.mixing import DRAW_DIGITS, SEED
from tests.llm.brute import components, normal, targets, tokenizer, words

SF_DIR = "/root/testdata/sf0.001"
STAGES = "language ID,exact dedup,n-gram Jaccard join,mixing sources to target weights,byte-level BPE encoding and decoding"


def brute_force(rows):
    """Every stage over {id: (text, source)}, plainly. Documents with letters have a language here."""
    rows = {k: (t, s) for k, (t, s) in rows.items() if any(c.isalpha() for c in t or "")}
    last = {}
    for k, (t, _) in rows.items():
        last[normal(t)] = max(k, last.get(normal(t), k))
    rows = {k: v for k, v in rows.items() if k in last.values()}
    smallest = components({k: t for k, (t, _) in rows.items()})
    rows = {k: v for k, v in rows.items() if smallest[k] == k}
    sizes = Counter()
    for t, s in rows.values():
        sizes[s] += len(words(t))
    target, encoder, found = targets(dict(sizes)), tokenizer(), Counter()
    for k, (t, s) in rows.items():
        digest = hashlib.md5(f"{SEED}:{k}:{t}".encode()).hexdigest()
        rate = target[s] / sizes[s]
        copies = int(rate) + (int(digest[:DRAW_DIGITS], 16) / 16**DRAW_DIGITS < rate - int(rate))
        ids = encoder.encode_ordinary(t)
        digests = (hashlib.sha256(b).hexdigest() for b in (",".join(map(str, ids)).encode(), t.encode()))
        if copies:
            found[(k, len(ids), *digests)] = copies
    return found


def test_rows_by_brute_force(spark):
    source = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF_DIR}/documents.parquet'").fetchall()
    found = Counter(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
    assert found == brute_force({k: (t, s) for k, t, s in source})


def test_stages(spark):
    assert ",".join(name for name, _ in corpus_pipeline.STAGES) == STAGES
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(20), SF_DIR)
        assert out.schema == docs.schema


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def some_rows(n=60):
    rng = random.Random(4)
    vocabulary = [f"w{c}{d}" for c in "abcdefgh" for d in "ijklmnop"]
    rows = [(1000, None, "en", "s1", None), (1001, "", None, "s1", 0), (1002, "12 34", "en", None, 5)]
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.choice([1, 3, 5, 20, 60]))
        source = rng.choice([None, "", "s1", "hot", "hot"])
        rows.append((3 * i, " ".join(words), rng.choice([None, "en", "de"]), source, 7))
        if i % 4 == 0:
            rows.append((3 * i + 1, " ".join(words).upper(), "en", source, 7))
        if i % 5 == 0:
            rows.append((3 * i + 2, " ".join([*words, "more"]), "en", source, 7))
    return [*rows, (2000, "long " * 30_000, "en", "s1", 1)]


def result(spark, folder):
    return Counter(map(tuple, corpus_pipeline.run(spark, str(folder)).collect()))


def test_nulls_long_texts_and_clashing_names(spark, stored, tmp_path):
    rows = some_rows()
    stored(rows, SCHEMA)
    assert result(spark, tmp_path) == brute_force({k: (t, s) for k, t, _, s, _ in rows})


def test_repeated_rows_change_nothing(spark, stored, tmp_path):
    rows = some_rows(12)
    stored([*rows, *rows[::2], *rows[::3]], SCHEMA)
    assert result(spark, tmp_path) == brute_force({k: (t, s) for k, t, _, s, _ in rows})


def test_rows_without_id_stay(spark, stored, tmp_path):
    rows = [(None, "alpha beta gamma delta epsilon zeta", "en", "s", 1), (None, None, "en", "s", 1), *some_rows(12)]
    stored(rows, SCHEMA)
    found = result(spark, tmp_path)
    assert sum(n for row, n in found.items() if row[0] is None) >= 1
    assert {row[0] for row in found} <= {r[0] for r in rows}


def test_empty_table(spark, stored, tmp_path):
    stored([], SCHEMA)
    assert result(spark, tmp_path) == {}
