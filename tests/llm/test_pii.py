import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from lexibid.llm import pii as X

CARD = "4111111111111111"


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def base(text):
    found = [(0, m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            found.append((1, m.start(), "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((3, m.start(), "phone", m.end()))
    return sorted(found)


TEXTS = [
    None,
    "",
    "nothing here",
    "a" * 5000 + " a@b.c_d@e.f x@y.z. @q.r u@v u@v. a@b.c@d.e.f",
    "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.0001 1.1.1.256 1..2.3.4 7.7.7.7",
    f"{CARD} 4111 1111 1111 1111 5 and 4111-1111-1111-1112, 4111 1111-1111 1111-{CARD} 1",
    "+1 (235) 555-3833 +12 345 +123456789012345678 + 1 234 567 890 ++49 30 1234567",
    "é漢🙂 joe@x.org ß +49 30 1234567 é 10.0.0.1",
    "5" * 30_000,
    "1 " * 20_000,
    "joe@x.org " * 300,
    "0000000000000 0000000000000000000 00000000000000000000",
]


def test_base_by_brute_force(stored, by_id):
    found = by_id(X.personal_data_report(stored(list(enumerate(TEXTS)))))
    for i, text in enumerate(TEXTS):
        spans = base(text or "")
        joined = ",".join(f"{kind}:{start}:{end}" for _, start, kind, end in spans)
        row, counts = found[i], Counter(kind for _, _, kind, _ in spans)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), i
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(counts[k] for k in X.KINDS), i


def contexts():
    rows = [f"please call me at +1 (235) 555-38{i:02d} today" for i in range(12)]
    rows += [f"or write to user{i}@host{i}.example for more" for i in range(12)]
    rows += [f"as figure {1234500 + i} shows clearly" for i in range(12)]
    rows += [f"on the whole +1 (235) 555-99{i:02d} is" if i % 2 else f"on the whole 10.0.0.{i} is" for i in range(12)]
    return rows


PLANTED = {
    100: "please call me at 235 555 7777 today",
    101: "or write to jane (at) mail.example for more",
    102: "as figure 7654321 shows clearly",
    103: "then 555 888 9999 and so on",
    104: "on the whole 235 555 1234 is",
}


def test_contexts_of_known_formats_find_others(stored, by_id):
    rows = list(enumerate(contexts())) + list(PLANTED.items())
    found = by_id(X.personal_data_report(stored(rows)))
    spans = {i: found[i].spans for i in PLANTED}
    assert spans == {100: "phone:18:30", 101: "email:12:34", 102: "", 103: "", 104: ""}
    for i, text in enumerate(contexts()):
        assert found[i].spans == ",".join(f"{kind}:{start}:{end}" for _, start, kind, end in base(text))


def test_seeds_in_looser_forms_are_found_in_any_context(stored, by_id):
    rows = [
        (1, "call +1 (235) 555-3833 now"),
        (2, f"pay by {CARD} only"),
        (3, "somewhere 1-235-555-3833 else"),
        (4, "and 4111.1111.1111.1111 too"),
        (5, "host 10.0.0.123 is no 1000123 at all"),
    ]
    found = by_id(X.personal_data_report(stored(rows)))
    assert [found[i].spans for i in (3, 4, 5)] == ["phone:10:24", "card:4:23", "ip:5:15"]


def test_identifiers_carry_confidence_to_other_patterns(spark):
    """A number seen in a good pattern makes another of its patterns good, round by round."""
    edges = [("p1", f"seed{i}", "phone") for i in range(8)] + [("p1", "n1", None), ("p2", "n1", None)]
    edges += [("p2", f"more{i}", "phone") for i in range(8)] + [("p2", "n2", None), ("p3", "n3", None)]
    df = spark.createDataFrame(edges, "pattern string, identifier string, seed_kind string")
    scores = {r.identifier: r for r in X.score_identifiers(df).collect()}
    assert scores["seed1"].score_phone == 1 and scores["seed1"].score_email == 0
    assert scores["n1"].score_phone >= scores["n2"].score_phone > 0.8 and scores["n3"].score_phone == 0
    single = {r.identifier: r for r in X.score_identifiers(df, rounds=1).collect()}
    assert scores["n2"].score_phone > single["n2"].score_phone


def test_few_seeds_do_not_raise_a_pattern_by_what_it_raises(spark):
    """1% seeds in overlapping patterns, which must not feed each other either."""
    names = [(f"seed{i}", "phone") for i in range(3)] + [(f"n{i}", None) for i in range(300)]
    edges = [(pattern, name, kind) for pattern in ("L the", "LL on the") for name, kind in names]
    df = spark.createDataFrame(edges, "pattern string, identifier string, seed_kind string")
    assert all(r.score_phone < 0.1 for r in X.score_identifiers(df).collect() if r.identifier.startswith("n"))


def test_discovered_identifiers_make_new_patterns(spark):
    """Three generations: no seed stands in the second and third pattern."""
    edges = [("call", f"seed{i}", "phone") for i in range(40)] + [("call", f"a{i}", None) for i in range(10)]
    edges += [("tel", f"a{i}", None) for i in range(10)] + [("tel", f"b{i}", None) for i in range(4)]
    edges += [("line", f"a{i}", None) for i in range(5)] + [("line", f"b{i}", None) for i in range(4)] + [("line", "c", None)]
    df = spark.createDataFrame(edges, "pattern string, identifier string, seed_kind string")
    scores = {r.identifier: r.score_phone for r in X.score_identifiers(df).collect()}
    assert all(scores[name] >= X.ACCEPTED for name in ("a0", "b0", "c"))


def test_no_python(stored, plan):
    assert not re.search("Python|Pandas|Arrow", plan(X.personal_data_report(stored([(1, "x")]))))


def test_missing_and_repeated_ids_and_empty_table(stored):
    rows = [(None, f"a@b.c {CARD}"), (1, "a@b.c"), (1, "a@b.c"), (1, None)]
    found = X.personal_data_report(stored(rows)).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.n_card) for r in found) == [(0, 1, 1), (1, 0, 0), (1, 1, 0), (1, 1, 0)]
    assert X.personal_data_report(stored([], name="none")).collect() == []


@pytest.mark.parametrize("digits", ["0", "18", "4111111111111111", "79927398713", "79927398710", "1" * 19])
def test_luhn(spark, digits):
    assert spark.range(1).select(X.passes_luhn(F.lit(digits))).first()[0] == luhn(digits)


NUMBER = r"(?<![A-Za-z0-9_@./+-])[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![A-Za-z0-9_@])"
ADDRESS = r"[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++"
ALLOWED = {"email": None, "card": (13, 19), "phone": (7, 15)}


def digits_of(found):
    return re.sub("[^0-9]", "", found)


def allowed(found, kind):
    """Whether a candidate's form lets it be of a kind."""
    if re.fullmatch(r"[0-9\x20().-]+", found) is None:
        return kind == "email"
    return kind in ("card", "phone") and ALLOWED[kind][0] <= len(digits_of(found)) <= ALLOWED[kind][1]


def brute_force(texts):
    """Spans of {id: text}: seeds, patterns and candidates in plain dictionaries, round by round."""
    mentions, edges = [], {}
    for doc, text in texts.items():
        seeds = [(rank, a, kind, b) for rank, a, kind, b in base(text)]
        found = [(a, b, text[a:b], kind) for _, a, kind, b in seeds]
        for m in [*re.finditer(NUMBER, text), *re.finditer(ADDRESS, text)]:
            if not any(m.start() < b and a < m.end() for _, a, _, b in seeds):
                found.append((m.start(), m.end(), m[0], None))
        for a, b, name, kind in found:
            number = re.fullmatch(r"[0-9\x20().+-]+", name) and kind != "ip"
            identity = digits_of(name) if number else name.lower()
            left, right = (re.sub("[0-9]+", "0", part.lower()) for part in (text[max(0, a - 60) : a], text[b : b + 60]))
            before, after = ["^", "^", *re.findall(r"[^\x20\x09-\x0D]+", left)], [*re.findall(r"[^\x20\x09-\x0D]+", right), "$"]
            for pattern in (f"L {before[-1]}", f"LL {before[-2]} {before[-1]}", f"LR {before[-1]} {after[0]}"):
                own = edges.setdefault((pattern, identity), set())
                own.update([kind] if kind else [])
            if kind is None:
                mentions.append((doc, a, b, name, identity))
    seed_kind = {}
    for (_, identity), kinds in edges.items():
        seed_kind[identity] = max(kinds | {seed_kind.get(identity) or ""}) or None
    given = {(i, k): 1.0 for i, k in seed_kind.items() if k}
    score = dict(given)
    while True:
        size = len(given)
        confidence = {}
        for pattern in {p for p, _ in edges}:
            inside = [i for p, i in edges if p == pattern]
            weight = sum(max([0.2, *(given.get((i, k), 0) for k in X.KINDS)]) for i in inside)
            for k in X.KINDS:
                seen = [given[i, k] for i in inside if (i, k) in given]
                confidence[pattern, k] = sum(seen) / (weight + 0.5) if len(seen) >= 3 else 0
        for identity, own in seed_kind.items():
            for k in X.KINDS:
                if own is None:
                    best = max(confidence[p, k] for p, i in edges if i == identity)
                    score[identity, k] = max(given.get((identity, k), 0), best)
        for (identity, k), value in score.items():
            number = re.fullmatch("[0-9]+", identity)
            form = number and ALLOWED[k][0] <= len(identity) <= ALLOWED[k][1] if k in ("card", "phone") else k == "email" and not number
            if form and value >= 0.85:
                given.setdefault((identity, k), value)
        if len(given) == size:
            break
    spans = {doc: base(text) for doc, text in texts.items()}
    for doc, a, b, name, identity in mentions:
        rated = [(score.get((identity, k), 0), -i) for i, k in enumerate(X.KINDS) if allowed(name, k)]
        if rated and max(rated)[0] >= 0.85:
            rank = -max(rated)[1]
            spans[doc].append((rank, a, X.KINDS[rank], b))
    return {doc: sorted(own) for doc, own in spans.items()}


def planted(n=100, seeds=200, seed=3):
    """Known and looser formats in a few contexts, by number."""
    rng = random.Random(seed)
    rows = []
    for i in range(n + seeds):
        number = [rng.randrange(200, 999), rng.randrange(200, 999), rng.randrange(1000, 9999)]
        name, host = (f"{''.join(rng.choices('abcdefgh', k=6))}{i}" for _ in range(2))
        known, loose = (
            ("+1 ({}) {}-{}", ["{}-{}-{}", "1.{}.{}.{}", "{} {} {}"]) if i % 2 else ("{}@{}.example", ["{} (at) {}.example", "{}[at]{} [dot] example"])
        )
        values = number if i % 2 else (name, host)
        shown = (known if i < seeds else rng.choice(loose)).format(*values)
        frame = rng.choice(["please call me at {} today", "my number is {} as ever"] if i % 2 else ["or write to {} for more", "mail {} instead"])
        rows.append((10**6 + i, frame.format(shown)))
    return rows


def test_spans_by_brute_force(stored, by_id):
    source = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    rows = [*source, *planted(20, 60), *enumerate(contexts(), 2 * 10**6)]
    expected = brute_force({i: t or "" for i, t in rows})
    found = by_id(X.personal_data_report(stored(rows)))
    for i, own in expected.items():
        assert found[i].spans == ",".join(f"{kind}:{a}:{b}" for _, a, kind, b in own), i
        assert found[i].n_spans == len(own)
    assert sum(map(len, expected.values())) > sum(len(base(t or "")) for _, t in rows) + 15


def test_recall_of_planted_identifiers(stored, by_id):
    """Looser forms among documents, two thirds of their contexts being of known formats; others gain next to nothing."""
    source = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    rows = planted()
    found = by_id(X.personal_data_report(stored([*source, *rows])))
    assert sum(found[i].n_spans > 0 for i, _ in rows[200:]) >= 0.95 * 100
    added = sum(found[i].n_spans - len(base(t or "")) for i, t in source)
    assert 0 <= added <= 5
