"""Places of regex matches within texts, as columns. All of it stays in the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spans of one document: code points, end exclusive, the kind's place in its list, what was found.
SPAN = "struct<start: int, end: int, rank: int, kind: string, found: string>"
NO_SPANS = f"array<{SPAN}>"


def no_spans() -> Column:
    return F.array().cast(NO_SPANS)


def span(start: Column, end: Column, rank: int, kind: str, found: Column) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        end.cast("int").alias("end"),
        F.lit(rank).alias("rank"),
        F.lit(kind).alias("kind"),
        found.alias("found"),
    ).cast(SPAN)


def matches(text: Column, pattern: str, rank: int, kind: str, group: int = 0) -> Column:
    """Spans of all matches from left to right, ``found`` being ``group`` of each.

    The text between matches and the matches follow one another, so lengths add up to places.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    steps = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), found.alias("found"))

    def step(done, match):
        start = done["at"] + F.length(match["gap"])
        end = start + F.length(match["whole"])
        own = span(start, end, rank, kind, match["found"])
        return F.struct(end.cast("int").alias("at"), F.concat(done["spans"], F.array(own)).alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), no_spans().alias("spans"))
    return F.aggregate(steps, empty, step, lambda done: done["spans"])


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def apart_from(spans: Column, others: Column) -> Column:
    """The spans that overlap none of ``others``."""
    return F.filter(
        spans,
        lambda s: ~F.exists(others, lambda o: (s["start"] < o["end"]) & (o["start"] < s["end"])),
    )


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined in the order of the array."""
    part = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(part, ",")


def by_start(spans: Column) -> Column:
    """Sorted by start, then kind as listed: the order of the struct's fields, but for its end."""
    return _sorted(spans, "start", "rank")


def by_kind(spans: Column) -> Column:
    """Sorted by kind as listed, then start."""
    return _sorted(spans, "rank", "start")


def _sorted(spans: Column, *keys: str) -> Column:
    keyed = F.transform(spans, lambda s: F.struct(*(s[k].alias(f"k{i}") for i, k in enumerate(keys)), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])
