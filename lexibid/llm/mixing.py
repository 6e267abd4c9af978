"""Mixing sources to target weights.

Sizes are summed per source, each source gets a target and from it a repetition rate, and
every document is taken floor(rate) times plus once more with the probability of the rest.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexibid.llm.common import WORD, text_or_empty, written

# Fixed values of the mix.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
SEED = "mix-1"

#: 13 hex digits are 52 bits, which a double holds exactly.
DRAW_DIGITS = 13


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, limit=LIMIT) -> DataFrame:
    """Target per source: ``source, source_size, target``, from ``source, size`` rows.

    Sources by code point, null last, weigh ``weights`` in turn and get ``share`` of all
    sizes by weight. A target stops at ``limit`` times its source's size, and the excess
    is shared again by weight until none is above: sorted by the level at which a source
    fills up, the first k are full for the smallest k whose common level does not fill the
    next one. Sizes of 0 in all get targets of 0; no sources give no rows. The windows run
    over one row per source, not over documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), place + 1)
    weighed = totals.withColumn("weight", weight.cast("double"))

    everything = Window.partitionBy()
    filling = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    later = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        weighed.withColumn("full_at", F.col("source_size") * float(limit) / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full_before", F.coalesce(F.sum("source_size").over(earlier), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(later))
        .withColumn(
            "level",
            (F.col("total") * float(share) - F.col("full_before") * float(limit)) / F.col("weight_left"),
        )
    )
    # The level of the first source that its own level does not fill is the common one.
    common = F.min_by(
        F.when(F.col("level") <= F.col("full_at"), F.col("level")),
        F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", F.col("source").isNull(), "source")),
    ).over(everything)
    return levels.withColumn("common", common).select(
        "source",
        "source_size",
        F.least(F.col("source_size") * float(limit), F.coalesce(F.col("common"), F.lit(0.0)) * F.col("weight")).alias(
            "target"
        ),
    )


def repetitions(docs: DataFrame, weights=WEIGHTS, share=SHARE, limit=LIMIT, seed=SEED) -> DataFrame:
    """How often the mix takes each row of ``docs`` (``doc_id, text, source`` and any others).

    ``row, size, source_size, target, copies``, ``row`` holding all columns as they came, so
    their names cannot clash. Null texts have size 0, a null source is a source of its own,
    a source whose size is 0 is taken 0 times. The draw for the extra copy is a hash of
    seed, id and text, so reruns agree; rows that repeat both are drawn alike.

    Targets are a written table of one row per source: Spark broadcasts it up to its size
    limit and shuffles beyond it, where adaptive execution splits a hot source.
    """
    text = text_or_empty("text")
    size = F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    digits = F.conv(F.substring(F.md5(key), 1, DRAW_DIGITS), 16, 10).cast("bigint")
    targets = written(source_targets(docs.select("source", size), weights, share, limit), "mix-targets")

    rows = docs.select(
        F.struct("*").alias("row"), size, (digits / float(16**DRAW_DIGITS)).alias("draw"), F.col("source").alias("own")
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor("rate")
    extra = F.when(F.col("draw") < F.col("rate") - whole, 1).otherwise(0)
    return (
        rows.join(targets, F.col("own").eqNullSafe(F.col("source")))
        .select("row", "size", "source_size", "target", "draw", rate.alias("rate"))
        .select("row", "size", "source_size", "target", (whole + extra).cast("bigint").alias("copies"))
    )


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, limit=LIMIT, seed=SEED) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as ``repetitions`` says, columns unchanged."""
    taken = repetitions(docs, weights, share, limit, seed).select("row", "copies")
    return taken.select("row", F.explode(F.expr("array_repeat(0, int(copies))")).alias("copy")).select("row.*")


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    slim = docs.select("doc_id", "text", "source")
    return repetitions(slim).select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
