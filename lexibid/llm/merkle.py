"""Merkle manifest of a dataset: a tree of digests per source, and one over the sources' roots.

A level is a table of nodes, and the next one comes from it by a slot pivot: conditional
aggregates spread the children of a parent into as many columns as its fanout, and the hash of the
concatenated columns is the parent. On the way down the columns become rows again, and what
concatenates the others, without the own slot's column, are the siblings on a leaf's path.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexibid.llm.common import written

# Children of a node, and one document of so many is tampered with.
FANOUT = 3
TAMPERED = 2

#: ``monotonically_increasing_id`` has the row's place in its partition in the lower bits.
ROW_BITS = 33


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def record_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return _digest(*(_field(c) for c in (doc_id, source, lang, n_chars, text)))


def group_key(source: Column) -> Column:
    """A source as a string that is never null and sorts as sources do: null first, then bytewise."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source))


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, their place in their ``grp`` by ``order`` from 0 on, and the group's size ``n``.

    Rows are sorted by ranges, so a hot group is in many tasks. A task's rows of a group follow one
    another, and a table of one row per group and task says where they begin in the group.
    """
    ranged = nodes.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    placed = written(ranged.withColumn("at", F.monotonically_increasing_id()), "merkle-sorted")
    placed = placed.withColumn("task", F.shiftright("at", ROW_BITS))
    runs = placed.groupBy("grp", "task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    same = Window.partitionBy("grp")
    earlier = same.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        runs.select(
            "grp",
            "task",
            (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("rows").over(same).alias("n"),
        ),
        "merkle-starts",
    )
    return placed.join(starts, ["grp", "task"]).select(
        *nodes.columns, (F.col("at") + F.col("shift")).alias("pos"), "n"
    )


def _slot(i: int) -> Column:
    return F.coalesce(F.col(f"c{i}.hash"), F.lit(""))


def parents(nodes: DataFrame) -> DataFrame:
    """The slot pivot: the next level of all groups that have several nodes.

    ``nodes`` are ``grp, pos, n, hash, item``; parents have their children in ``c0``, ``c1`` and so on,
    null where the last run of a group is shorter, and no item.
    """
    child = F.struct("hash", "item")
    pivot = [F.max(F.when(F.col("pos") % FANOUT == i, child)).alias(f"c{i}") for i in range(FANOUT)]
    above = F.expr(f"pos div {FANOUT}").alias("pos")
    size = F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n")
    item = nodes.schema["item"].dataType
    return (
        nodes.where("n > 1")
        .groupBy("grp", above, size)
        .agg(*pivot)
        .withColumn("hash", _digest(*map(_slot, range(FANOUT))))
        .withColumn("item", F.lit(None).cast(item))
    )


def levels(leaves: DataFrame) -> list[DataFrame]:
    """``leaves`` (``grp, pos, n, hash, item``) and the levels above them, each a written table.

    There are as many as the largest group asks for; smaller groups end on lower levels,
    with a single node.
    """
    tables = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        tables.append(written(parents(tables[-1]), "merkle-level"))
        most = (most + FANOUT - 1) // FANOUT
    return tables


def tops(tables: list[DataFrame]) -> DataFrame:
    """The last node of every group: ``grp, hash, level``."""
    found = [t.where("n = 1").select("grp", "hash", F.lit(i).alias("level")) for i, t in enumerate(tables)]
    top = found[0]
    for other in found[1:]:
        top = top.unionByName(other)
    return written(top, "merkle-tops")


STEP = "struct<left: string, right: string>"


def _children(nodes: DataFrame) -> DataFrame:
    """A level with paths, a row per child: its siblings come before the path of its parent."""
    spread = []
    for i in range(FANOUT):
        left = F.concat(F.lit(""), *map(_slot, range(i)))
        right = F.concat(F.lit(""), *map(_slot, range(i + 1, FANOUT)))
        step = F.struct(left.alias("left"), right.alias("right"))
        spread.append(F.struct((F.col("pos") * FANOUT + i).alias("pos"), F.col(f"c{i}").alias("child"), step.alias("step")))
    kept = F.filter(F.array(*spread), lambda s: s["child"].isNotNull())
    rows = nodes.select("grp", "path", "top", F.explode(kept).alias("own"))
    return rows.select(
        "grp",
        "own.pos",
        "own.child.hash",
        "own.child.item",
        F.concat(F.array("own.step"), F.col("path")).alias("path"),
        "top",
    )


def proofs(tables: list[DataFrame], roots: DataFrame) -> DataFrame:
    """Every leaf with its path: ``hash, item, path, top``.

    ``path`` has, level by level, what lies left and right of the own slot, and ends with the path
    that ``roots`` (``grp, hash, level, path``) give to the group's last node, which is ``top``. A
    path is moved once per parent and not per leaf.
    """
    kept = ["hash", "item", "path", "top"]
    nodes = None
    for level in reversed(range(len(tables))):
        here = roots.where(F.col("level") == level).select("grp", "path", F.col("hash").alias("top"))
        last = tables[level].where("n = 1").join(here, "grp")
        if nodes is None:
            nodes = last
        elif level:
            paths = _children(nodes).select("grp", "pos", "path", "top")
            nodes = last.unionByName(tables[level].join(paths, ["grp", "pos"]))
        else:
            nodes = last.select(kept).unionByName(_children(nodes).select(kept))
    return nodes.select(kept)


def _no_steps() -> Column:
    return F.array().cast(f"array<{STEP}>")


def manifest(docs: DataFrame) -> DataFrame:
    """Every document's leaf, path and roots: ``doc_id, leaf, tampered, path, subroot, root``.

    ``docs`` has at least ``doc_id, source, lang, n_chars, text``; other columns may have any names. The
    leaves of a source ascend by id, null ids first and rows of one id by digest; a null source is a
    source of its own and comes first. ``tampered`` is the digest of the record with its newlines
    deleted, null where that is not done (no id, or an id not chosen). A table without rows
    has no root and gives no rows. The only thing that reaches the driver is the root.
    """
    doc_id = F.col("doc_id").cast("bigint")
    rest = [F.col(c) for c in ("source", "lang", "n_chars")]
    chosen = F.crc32(doc_id.cast("string")) % TAMPERED == 0
    without = record_digest(doc_id, *rest, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    leaves = written(
        docs.select(
            group_key(F.col("source")).alias("grp"),
            record_digest(doc_id, *rest, F.col("text")).alias("hash"),
            F.struct(doc_id.alias("doc_id"), F.when(chosen, without).alias("tampered")).alias("item"),
            doc_id.alias("by_id"),
        ),
        "merkle-leaves",
    )
    tables = levels(written(numbered(leaves, ["by_id", "hash"]).drop("by_id"), "merkle-level"))
    ends = tops(tables)

    subroots = ends.select(F.lit("").alias("grp"), "hash", F.struct("grp", "level").alias("item"), F.col("grp").alias("by_source"))
    over = levels(written(numbered(subroots, ["by_source"]).drop("by_source"), "merkle-level"))
    last = tops(over)
    top = last.first()
    root = F.lit(top.hash if top else None).cast("string")
    of_sources = proofs(over, last.withColumn("path", _no_steps()))
    roots = written(of_sources.select("item.grp", "hash", "item.level", "path"), "merkle-roots")
    return proofs(tables, roots).select(
        "item.doc_id", F.col("hash").alias("leaf"), "item.tampered", "path", F.col("top").alias("subroot"), root.alias("root")
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda own, step: _digest(step["left"], own, step["right"]))


def manifest_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``."""
    siblings = F.transform("path", lambda step: F.concat(step["left"], step["right"]))
    rows = manifest(docs).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
