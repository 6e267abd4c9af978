"""Personal data: known formats, and what stands where known formats stand.

Spans of the known formats are seeds. The words around a seed are lexical patterns. Patterns and
the identifiers seen in them form a graph on which confidence goes back and forth: a
pattern is as good as the identifiers in it, an identifier as good as its patterns. Looser
candidates that reach a high confidence are spans too. Column expressions, joins and sums only.
"""

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexibid.llm import spans as S
from lexibid.llm.common import discard, located, text_or_empty, written

# What is looked for, in this order. A match begins where a run of its characters
# does or where the last match ended: elsewhere no attempt could succeed that failed before.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
CARD_DIGITS = (13, 19)
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PHONE_DIGITS = (9, 15)
#: Without such a pair of digits a text has neither an address nor a card number.
DIGITS = r"[0-9][\x20.-]?[0-9]"

#: Candidates: groups of digits that stand alone, and addresses spelled out.
NUMBER = r"(?<![A-Za-z0-9_@./+-])[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![A-Za-z0-9_@])"
NUMBER_DIGITS = {"card": (13, 19), "phone": (7, 15)}
ADDRESS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++"
    r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++"
)

#: Characters on either side that may hold the words of a pattern.
CONTEXT = 60
#: A pattern counts once it has been seen with so many identifiers of a kind, seeds or accepted ones.
LEAST_SEEN = 3
#: What an identifier that is not accepted takes from a pattern's confidence, and what doubt is left.
UNKNOWN = 0.2
DOUBT = 0.5
#: A candidate is a span from this confidence on.
ACCEPTED = 0.85

MENTION = (
    "struct<start: int, end: int, rank: int, kind: string, found: string, left: string, right: string, seed: boolean>"
)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _between(found: Column, bounds: tuple[int, int]) -> Column:
    return F.length(_digits(found)).between(*bounds)


def passes_luhn(digits: Column) -> Column:
    """Whether the check digit fits: every second digit from the right is doubled."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total, i):
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans of the known formats by kind, then start: leftmost, without overlap within a kind."""
    has_digits = text.rlike(DIGITS)
    card = F.filter(
        S.matches(text, CARD, 2, "card"),
        lambda s: F.when(_between(s["found"], CARD_DIGITS), passes_luhn(_digits(s["found"]))).otherwise(F.lit(False)),
    )
    phone = F.filter(S.matches(text, PHONE, 3, "phone"), lambda s: _between(s["found"], PHONE_DIGITS))
    ip = F.filter(S.matches(text, IP, 1, "ip"), lambda s: s["found"].rlike(IP_PARTS))
    return F.concat(
        F.when(F.contains(text, F.lit("@")), S.matches(text, EMAIL, 0, "email")).otherwise(S.no_spans()),
        F.when(has_digits, ip).otherwise(S.no_spans()),
        F.when(has_digits, card).otherwise(S.no_spans()),
        F.when(F.contains(text, F.lit("+")), phone).otherwise(S.no_spans()),
    )


def candidate_spans(text: Column) -> Column:
    spelled = F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]"))
    return F.concat(
        F.when(text.rlike(DIGITS), S.matches(text, NUMBER, 4, "number")).otherwise(S.no_spans()),
        F.when(spelled, S.matches(text, ADDRESS, 5, "address")).otherwise(S.no_spans()),
    )


def _mentions(spans: Column, text: Column, seed: bool) -> Column:
    """Spans with the lower-case text on either side."""

    def mention(s):
        begin = F.greatest(s["start"] - CONTEXT, F.lit(0))
        left = F.lower(F.substring(text, begin + 1, s["start"] - begin))
        right = F.lower(F.substring(text, s["end"] + 1, F.lit(CONTEXT)))
        fields = [s[f].alias(f) for f in ("start", "end", "rank", "kind", "found")]
        return F.struct(*fields, left.alias("left"), right.alias("right"), F.lit(seed).alias("seed")).cast(MENTION)

    return F.transform(spans, mention)


def _words(context: Column) -> Column:
    """The words of a context, digits made equal."""
    return F.regexp_extract_all(F.regexp_replace(context, "[0-9]+", "0"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def _patterns(left: Column, right: Column) -> Column:
    """Word before; two words before; word before and word after. Ends of the text are words too."""
    before = F.concat(F.array(F.lit("^"), F.lit("^")), _words(left))
    after = F.concat(_words(right), F.array(F.lit("$")))
    last, second, following = F.element_at(before, -1), F.element_at(before, -2), F.element_at(after, 1)
    return F.array(
        F.concat(F.lit("L "), last),
        F.concat(F.lit("LL "), second, F.lit(" "), last),
        F.concat(F.lit("LR "), last, F.lit(" "), following),
    )


def _identity(found: Column, kind: Column) -> Column:
    """Numbers are the same by their digits, all else in lower case; an IP's points tell it from a number."""
    is_number = found.rlike(r"^[0-9\x20().+-]+$") & (kind != "ip")
    return F.when(is_number, _digits(found)).otherwise(F.lower(found))


def _score(kind: str) -> str:
    return f"score_{kind}"


def _given(kind: str) -> str:
    return f"given_{kind}"


def _forms() -> dict[str, Column]:
    """The kinds that an identifier's form allows."""
    is_number, digits = F.col("identifier").rlike("^[0-9]+$"), F.length("identifier")
    numbers = {kind: is_number & digits.between(*bounds) for kind, bounds in NUMBER_DIGITS.items()}
    return {"email": ~is_number, "ip": F.lit(False), **numbers}


def score_identifiers(edges: DataFrame, rounds: int | None = None, forms: dict[str, Column] | None = None) -> DataFrame:
    """Confidence of every identifier per kind: ``identifier, seed_kind, score_<kind>...``.

    ``edges`` has ``pattern, identifier, seed_kind``; a seed's kind is fixed. Sums combine
    within tasks, so a pattern or identifier that holds a third of the edges is one row per task.
    Every round is written to the shared folder. Without ``rounds`` they go on until none accepts
    a further identifier, and thus no pattern gets any further ones; what is accepted stays so.

    An identifier is unknown to a pattern, and weighs UNKNOWN, until it is accepted for a kind that
    ``forms`` allows; from then on it gives its patterns the confidence with which it was accepted.
    What is not accepted adds nothing to a pattern, so a pattern cannot raise itself.
    """
    forms = forms or {kind: F.lit(True) for kind in KINDS}
    edges = written(edges.groupBy("pattern", "identifier").agg(F.max("seed_kind").alias("seed_kind")), "pii-edges")
    links = edges.select("pattern", "identifier")
    own = [F.when(F.col("seed_kind") == kind, 1.0).otherwise(0.0).alias(_score(kind)) for kind in KINDS]
    given = [F.col(_score(kind)).alias(_given(kind)) for kind in KINDS]
    seeds = edges.groupBy("identifier").agg(F.max("seed_kind").alias("seed_kind")).select("identifier", "seed_kind", *own)
    seeds = seeds.select("*", *given)
    scores = written(seeds, "pii-scores")
    discovered = 0
    for _ in count() if rounds is None else range(rounds):
        known = F.greatest(F.lit(UNKNOWN), *(F.col(_given(kind)) for kind in KINDS))
        sums = (
            links.join(scores, "identifier")
            .groupBy("pattern")
            .agg(
                F.sum(known).alias("weight"),
                *(F.sum(_given(kind)).alias(_score(kind)) for kind in KINDS),
                *(F.count_if(F.col(_given(kind)) > 0).alias(f"seen_{kind}") for kind in KINDS),
            )
        )
        confidence = [
            F.when(F.col(f"seen_{kind}") >= LEAST_SEEN, F.col(_score(kind)) / (F.col("weight") + DOUBT))
            .otherwise(0.0)
            .alias(_score(kind))
            for kind in KINDS
        ]
        any_confidence = reduce(lambda a, b: a | b, (F.col(_score(kind)) > 0 for kind in KINDS))
        patterns = written(sums.select("pattern", *confidence).where(any_confidence), "pii-patterns")
        # The patterns of a mention overlap, so an identifier has the confidence of its best one.
        best = (
            links.join(patterns, "pattern")
            .groupBy("identifier")
            .agg(*(F.max(_score(kind)).alias(f"best_{kind}") for kind in KINDS))
        )
        raised = [
            F.when(F.col("seed_kind").isNotNull(), F.col(_score(kind)))
            .otherwise(F.greatest(F.col(_given(kind)), F.coalesce(f"best_{kind}", F.lit(0.0))))
            .alias(_score(kind))
            for kind in KINDS
        ]
        accepted = [
            F.when(F.col(_given(kind)) > 0, F.col(_given(kind)))
            .when((F.col(_score(kind)) >= ACCEPTED) & forms[kind], F.col(_score(kind)))
            .otherwise(0.0)
            .alias(_given(kind))
            for kind in KINDS
        ]
        raised = scores.join(best, "identifier", "left").select("identifier", "seed_kind", *raised, *map(_given, KINDS))
        earlier, scores = scores, written(raised.select("identifier", "seed_kind", *map(_score, KINDS), *accepted), "pii-scores")
        discard(earlier, patterns)
        before, discovered = discovered, scores.select(F.sum(sum(F.when(F.col(_given(k)) > 0, 1).otherwise(0) for k in KINDS))).first()[0]
        if discovered == before:
            break
    discard(edges)
    return scores.drop(*map(_given, KINDS))


def _accepted_kind(found: Column) -> Column:
    """The kind whose confidence is highest among those that the candidate's form allows, or null."""
    allowed = {
        "email": ~found.rlike(r"^[0-9\x20().-]+$"),
        "ip": F.lit(False),
        **{kind: found.rlike(r"^[0-9\x20().-]+$") & _between(found, bounds) for kind, bounds in NUMBER_DIGITS.items()},
    }
    rated = F.array(
        *(
            F.struct(F.when(allowed[kind], F.col(_score(kind))).otherwise(0.0).alias("score"), F.lit(-i).alias("order"))
            for i, kind in enumerate(KINDS)
        )
    )
    best = F.array_max(rated)
    names = F.array(*(F.lit(kind) for kind in KINDS))
    return F.when(best["score"] >= ACCEPTED, F.element_at(names, 1 - best["order"]))


def personal_data(docs: DataFrame, rounds: int | None = None) -> DataFrame:
    """Spans of every row of ``docs`` (``doc_id, text``; others are ignored): ``doc_id, base, spans``.

    Both are arrays of ``start, end, rank, kind, found`` sorted by kind, then start. ``base`` are the
    known formats, ``spans`` has in addition the candidates found by their context, which
    overlap none of those. Of kinds that explain a candidate equally well the first counts. An address
    of a machine has no looser form, so none is ever discovered. A null text is empty and has no
    spans. Rows stand for themselves, repeated ones and those without id too, but an identifier
    counts once per pattern however often it is repeated. No rows give none. Whole texts are read,
    once; only CONTEXT characters around a mention become patterns.
    """
    rows = located(docs)
    text = F.col("text")
    scanned = rows.select(
        F.col("content.doc_id").cast("bigint").alias("doc_id"), "file", "row", text_or_empty(F.col("content.text")).alias("text")
    ).withColumn("base", base_spans(text))
    candidates = scanned.withColumn("candidates", S.apart_from(candidate_spans(text), F.col("base")))
    found = written(
        candidates.select(
            "doc_id",
            "file",
            "row",
            S.by_kind(F.col("base")).alias("base"),
            F.concat(_mentions(F.col("base"), text, True), _mentions(F.col("candidates"), text, False)).alias("mentions"),
        ),
        "pii-mentions",
    )
    mentions = found.select("file", "row", F.inline("mentions"))
    edges = mentions.select(
        F.explode(_patterns(F.col("left"), F.col("right"))).alias("pattern"),
        _identity(F.col("found"), F.col("kind")).alias("identifier"),
        F.when(F.col("seed"), F.col("kind")).alias("seed_kind"),
    )
    # A seed that is written in a looser form elsewhere is a span there too, whatever stands around it.
    scores = score_identifiers(edges, rounds, _forms()).drop("seed_kind")

    open_mentions = mentions.where("not seed").withColumn("identifier", _identity(F.col("found"), F.col("kind")))
    accepted = open_mentions.join(scores, "identifier").withColumn("kind", _accepted_kind(F.col("found")))
    ranks = F.create_map(*(F.lit(v) for i, kind in enumerate(KINDS) for v in (kind, i)))
    discovered = (
        accepted.where("kind is not null")
        .select("file", "row", F.struct("start", "end", ranks[F.col("kind")].alias("rank"), "kind", "found").cast(S.SPAN).alias("span"))
        .groupBy("file", "row")
        .agg(F.collect_list("span").alias("more"))
    )
    return found.join(discovered, ["file", "row"], "left").select(
        "doc_id", "base", S.by_kind(F.concat("base", F.coalesce("more", S.no_spans()))).alias("spans")
    )


def personal_data_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans``."""
    return personal_data(docs).select(
        "doc_id",
        *(S.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(S.joined(F.col("base")), 256).alias("base_sha256"),
        S.joined(F.col("spans")).alias("spans"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )
