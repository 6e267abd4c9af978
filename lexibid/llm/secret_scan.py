"""Secret scans: formats known beforehand, and strings that are too random for a text.

Of a candidate string a window slides over the characters. The entropy of the window follows from
the sum of c log c over its character counts, and a step changes two counts only. All of it is
column expressions in one pass over the texts, without a shuffle.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexibid.llm import spans as S
from lexibid.llm.common import text_or_empty

# What is looked for, in this order.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 8
ACCESS = "AKIA[A-Z0-9]+"
ACCESS_LEAST = 16
HEX = "(?<![0-9a-f])[0-9a-f]{32,}"

#: Candidates: runs of characters that encodings use, long enough for a window.
WINDOW = 20
#: Windows that are worked through in one piece of a long run.
PIECE = 500
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Classes of candidates, the first that fits, and the entropy in bits a character that some window must reach.
#: Smaller alphabets have less entropy, and words have more of it than their letters suggest.
CLASSES = (
    ("^[0-9a-fA-F]+$", 3.0),
    ("^(?:[a-z]+|[A-Z]+)$", 3.8),
    ("^(?:[A-Za-z]+|[A-Za-z/]*[+][A-Za-z+/]*)=*$", 3.9),
    ("^[a-z0-9]+$", 3.6),
    ("^[A-Z0-9]+=*$", 3.5),
    ("^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])", 3.8),
)
#: A part of a path: words and numbers of at most 16 characters; what mixes them otherwise may be random.
WORD = "(?:[A-Za-z]++[0-9]*+|[0-9]++)"
PATH_PART = f"(?![^/]{{17}})[_-]*+{WORD}(?:[_-]++{WORD})*+[_-]*+"
# Candidates that are no secrets whatever their entropy.
ALLOWED = (
    "^(?:[A-Za-z0-9_-]+=)?[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "(?i)example|sample|dummy|placeholder|changeme",
    "^(?:[A-Za-z0-9_-]+=)?sha(?:256|384|512)-",
    "^(?=.*[_-])[A-Za-z_-]+$",
    "^[a-z]*+(?:[A-Z]{1,4}[a-z]{2,}+)++[A-Z]{0,4}$",
    "(?i)abcdefgh|zyxwvuts|qwertyui",
    "^[0-9_-]+$",
    f"^/?{PATH_PART}(?:/{PATH_PART}){{2,}}+/?$",
)

#: Parts of a candidate that are looked at by themselves, since names and values may be glued: what stands behind
#: an equals sign, and what is left when the characters that only one encoding has end a part. A digest with
#: its name is one part.
DIGEST = r"(?<![A-Za-z0-9])sha(?:256|384|512)-[A-Za-z0-9+/]++={0,2}"
PARTS = tuple(
    rf"{DIGEST}|{start}[{characters}]{{{WINDOW},}}+{end}"
    for start, characters, end in (
        ("(?<==)", "A-Za-z0-9+/_-", "={0,6}"),
        ("(?<![A-Za-z0-9+/])", "A-Za-z0-9+/", "={0,6}"),
        ("(?<![A-Za-z0-9_-])", "A-Za-z0-9_-", ""),
        ("(?<![A-Za-z0-9])", "A-Za-z0-9", ""),
    )
)
#: What follows names of letters only, as many as leave enough.
NAMED = rf"^(?:[A-Za-z]++[+/_=-]+(?=.{{{WINDOW}}}))++(.{{{WINDOW},}})$"


def _c_log_c(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(count)).otherwise(F.lit(0.0))


def _counts(window: Column) -> Column:
    """Every character of a window and how often it is there, as a map."""

    def entry(c):
        return F.struct(c, F.length(window) - F.length(F.replace(window, c, F.lit(""))))

    characters = F.filter(F.array_distinct(F.split(window, "")), lambda c: c != "")
    return F.map_from_entries(F.transform(characters, entry))


def max_entropy(string: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy of any ``window`` characters in a row, in bits a character.

    Zero for strings shorter than the window and for null. Long strings are cut into pieces that overlap
    by a window less one character, since finding a character takes as long as its place is far.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.length(string) - (window - 1), F.lit(1)), F.lit(PIECE))
    pieces = F.transform(starts, lambda i: F.substring(string, i, F.lit(PIECE + window - 1)))
    most = F.array_max(F.transform(pieces, lambda piece: _max_entropy(piece, window)))
    return F.when(F.length(string) >= window, most).otherwise(F.lit(0.0))


def _max_entropy(string: Column, window: int) -> Column:
    """The same for a short string. With c of each character in a window of w, the entropy is
    log w minus the sum of c log c over w. The counts go along from window to window: a step takes
    the character that leaves and the one that enters out of the sum, and puts them back with
    their new counts.
    """
    at_first = _counts(F.substring(string, 1, window))
    total = F.aggregate(F.map_values(at_first), F.lit(0.0), lambda sum_so_far, n: sum_so_far + _c_log_c(n))
    steps = F.when(
        F.length(string) > window, F.sequence(F.lit(1), F.length(string) - window)
    ).otherwise(F.array().cast("array<int>"))

    def step(done, i):
        leaving, entering = F.substring(string, i, F.lit(1)), F.substring(string, i + window, F.lit(1))
        out = F.try_element_at(done["counts"], leaving)
        into = F.coalesce(F.try_element_at(done["counts"], entering), F.lit(0))
        others = F.map_filter(done["counts"], lambda c, n: (n > 0) & (c != leaving) & (c != entering))
        counts = F.map_concat(others, F.create_map(leaving, out - 1, entering, into + 1))
        change = _c_log_c(out - 1) - _c_log_c(out) + _c_log_c(into + 1) - _c_log_c(into)
        same = leaving == entering
        total = F.when(same, done["total"]).otherwise(done["total"] + change)
        return F.struct(
            F.when(same, done["counts"]).otherwise(counts).alias("counts"),
            total.alias("total"),
            F.least(done["least"], total).alias("least"),
        )

    start = F.struct(at_first.alias("counts"), total.alias("total"), total.alias("least"))
    least = F.aggregate(steps, start, step, lambda done: done["least"])
    return F.lit(math.log2(window)) - least / window


def is_random(string: Column) -> Column:
    """Whether a candidate's class and entropy speak for a secret and no allowed form explains it."""
    least = F.lit(None).cast("double")
    for form, bits in reversed(CLASSES):
        least = F.when(string.rlike(form), F.lit(bits)).otherwise(least)
    random = F.when(least.isNotNull(), max_entropy(string) >= least).otherwise(F.lit(False))
    for allowed in ALLOWED:
        random = ~string.rlike(allowed) & random
    return random


def _random_parts(run: Column) -> Column:
    """Parts of a candidate that are random by themselves, those of earlier PARTS before what overlaps them."""
    string = run["found"]
    named = F.regexp_extract(string, NAMED, 1)
    rest = S.span(F.length(string) - F.length(named), F.length(string), 3, "entropy", named)
    parts = [S.matches(string, pattern, 3, "entropy") for pattern in PARTS]
    parts.insert(1, F.when(named != "", F.array(rest)).otherwise(S.no_spans()))
    random = F.filter(F.concat(*parts), lambda s: is_random(s["found"]))
    apart = F.aggregate(
        random, S.no_spans(), lambda kept, s: F.concat(kept, S.apart_from(F.array(s), kept)).cast(S.NO_SPANS)
    )
    return F.transform(
        apart, lambda s: S.span(run["start"] + s["start"], run["start"] + s["end"], 3, "entropy", s["found"])
    )


def random_spans(runs: Column) -> Column:
    """Candidates that are random as a whole, and of the others the parts that are."""
    return F.flatten(
        F.transform(runs, lambda run: F.when(is_random(run["found"]), F.array(run)).otherwise(_random_parts(run)))
    )


def _base(text: Column) -> Column:
    lowered = F.lower(text)
    named = F.lit(False)
    for word in ASSIGN_WORDS:
        named = named | F.contains(lowered, F.lit(word))
    assign = F.filter(S.matches(text, ASSIGN, 0, "assign", 1), lambda s: F.length(s["found"]) >= ASSIGN_LEAST)
    access = F.filter(S.matches(text, ACCESS, 1, "access"), lambda s: F.length(s["found"]) >= ACCESS_LEAST)
    return F.concat(
        F.when(named, assign).otherwise(S.no_spans()),
        F.when(F.contains(text, F.lit("AKIA")), access).otherwise(S.no_spans()),
        F.when(F.col("has_run"), S.matches(text, HEX, 2, "hex")).otherwise(S.no_spans()),
    )


def secrets(docs: DataFrame) -> DataFrame:
    """Spans of every row of ``docs`` (``doc_id, text``; others are ignored): ``doc_id, base, spans``.

    Both are arrays of ``start, end, rank, kind, found`` sorted by start, then kind. ``base`` are the
    known formats, leftmost and without overlap within a kind; ``spans`` has in addition random
    strings, or random parts of them, in runs that overlap none of those. A null text is empty and has
    no spans. Rows stand for themselves, repeated ones and those without id too; no rows give none. Whole texts
    are scanned, and neither runs nor allowed forms have a largest length.
    """
    text = F.col("text")
    scanned = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty("text").alias("text")
    ).withColumn("has_run", text.rlike(CANDIDATE))
    base = scanned.select("doc_id", "text", "has_run", S.by_start(_base(text)).alias("base"))
    candidates = F.when(F.col("has_run"), S.matches(text, CANDIDATE, 3, "entropy")).otherwise(S.no_spans())
    unknown = base.select("doc_id", "base", candidates.alias("candidates")).select(
        "doc_id", "base", S.apart_from(F.col("candidates"), F.col("base")).alias("candidates")
    )
    random = random_spans(F.col("candidates"))
    return unknown.select("doc_id", "base", S.by_start(F.concat("base", random)).alias("spans"))


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans``."""
    return secrets(docs).select(
        "doc_id",
        *(S.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(S.joined(F.col("base")), 256).alias("base_sha256"),
        S.joined(F.col("spans")).alias("spans"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )
