"""Merkle manifest of a dataset: a root over all rows, and a proof for each row.

Every row is a leaf. Per source the leaves are numbered in the order of their ids; while several nodes remain, each
run of ``FAN`` becomes the digest of its digests. The subroots of the sources, in the order of
the sources, are combined in the same way.

Numbers come from one range sort: tasks count along their sorted rows, and one row per task, with the rows of its first
source in earlier tasks, completes them. The tree is a roll-up of nested structs: the hexadecimal
digits of a number are grouped away one after the other, ``DIGITS`` of them within a block of
``FAN ** DIGITS`` neighbours, so a row holds one block and no more. One exchange brings a block together. Blocks become the nodes of the
next tier, and so on until one node is left. On the way down the nested structs are exploded, each level adding the
digests left and right of its node, so proofs need no join of leaves; between tiers
one row per block takes up the steps above it.

Defined cases: NULL sources are one source, which comes first; sources are ordered bytewise. NULL fields count as ``-``.
Rows without id come first and are never tampered with. Rows with the same id are ordered by their
digests, and rows alike in all fields are leaves of their own with equal digests. A row alone in its
source is its subroot. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, width

FAN, BITS, DIGITS = 16, 4, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows that one task sorts and numbers.
TASK_ROWS = 250_000
_STEP = "array<struct<l:string,r:string>>"


def field(value: Column) -> Column:
    """A value with its length, so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def with_leaves(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``doc_id``, ``source``, the ``leaf`` and the leaf after tampering, ``bent``: every fifth row by the checksum of its id has its text lower-cased."""
    whole = [F.col(f) for f in fields]
    low = [F.translate(F.col(f), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if f == text_col else F.col(f) for f in fields]
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), leaf_digest(whole).alias("leaf"), F.when(hit, leaf_digest(low)).alias("bent")
    )


def numbered(nodes: DataFrame, group: str, order: list[str], rows: int) -> DataFrame:
    """Add ``rank``, from 0 along ``order`` in each group; stored, so a lost executor changes no number."""
    names, sort = [group, *[c for c in nodes.columns if c != group]], [group, *order]
    dealt = nodes.repartitionByRange(width(rows, TASK_ROWS, 2), *sort).sortWithinPartitions(*sort)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, after = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            coded = pc.dictionary_encode(b.column(0), null_encoding="encode")
            codes, values = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            n = np.diff(np.r_[starts, b.num_rows])
            base = np.zeros(len(starts), np.int64)
            if last is not None and last[0] == values[codes[0]]:
                base[0] = after
            place = np.arange(b.num_rows) - np.repeat(starts - base, n)
            last, after = (values[codes[-1]],), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(place)], names=[*names, "part", "place"])

    shape = ", ".join(f"`{c}` {t}" for c, t in dealt.select(*names).dtypes)
    kept = stored(dealt.select(*names).mapInArrow(count, f"{shape}, part int, place long"), "merkle-rows")
    # A group that goes on from earlier tasks is the first of each later one: one row a task.
    held = kept.groupBy("part", group).agg(F.max("place").alias("_m"))
    ends = held.groupBy("part").agg(F.min_by(F.struct(group), F.struct(group)).alias("first"), F.max_by(F.struct(group, (F.col("_m") + 1).alias("n")), F.struct(group)).alias("last"))
    along = W.partitionBy(F.lit(0)).orderBy("part")
    same = F.col(f"last.{group}").eqNullSafe(F.col(f"first.{group}"))
    # Rows of the last group of a task since the task where that group began.
    run = F.sum(F.when(F.col("begins"), 1).otherwise(0)).over(along)
    chained = (
        ends.withColumn("goes_on", F.lag(F.col("last")).over(along)[group].eqNullSafe(F.col(f"first.{group}")) & F.lag("part").over(along).isNotNull())
        .withColumn("begins", ~(same & F.coalesce("goes_on", F.lit(False))))
        .withColumn("run", run)
        .withColumn("so_far", F.sum("last.n").over(W.partitionBy("run").orderBy("part")))
        .select("part", F.col("first").alias("_first"), F.when(F.col("goes_on"), F.lag("so_far").over(along)).otherwise(F.lit(0)).alias("before"))
    )
    # At most one row for each task of the sort above.
    joined = kept.join(F.broadcast(chained), "part")
    here = F.when(F.col(group).eqNullSafe(F.col(f"_first.{group}")), F.col("before")).otherwise(F.lit(0))
    return joined.withColumn("rank", F.col("place") + here).select(*nodes.columns, "rank")


def rolled(nodes: DataFrame, group: str, payload: list[str], label: str) -> DataFrame:
    """One row per block: ``group``, ``block``, its ``node``, the ``levels`` it took and the nested ``tree``.

    ``nodes`` has ``group``, ``rank``, ``node`` and payload columns.
    """
    rank = F.col("rank")
    digits = [F.shiftright(rank, BITS * i).bitwiseAND(FAN - 1).cast("int").alias(f"d{i}") for i in range(DIGITS)]
    dealt = nodes.select(group, F.shiftright(rank, BITS * DIGITS).alias("block"), *digits, "node", *payload).repartition(group, "block")
    tree = dealt.withColumn("c", F.struct("d0", "node", *payload)).withColumn("n", F.lit(1).cast("long"))
    for i in range(DIGITS):
        by = [group, "block", *[f"d{j}" for j in reversed(range(i + 1, DIGITS))]]
        # Sorting puts children in the order of their digit, which comes first in the struct.
        grown = tree.groupBy(*by).agg(F.sort_array(F.collect_list("c")).alias("kids"), F.sum("n").alias("n"))
        node = F.sha2(F.array_join(F.col("kids.node"), ""), 256)
        tree = grown.withColumn("node", node)
        if i + 1 < DIGITS:
            tree = tree.withColumn("c", F.struct(f"d{i + 1}", "node", "kids")).select(*by, "c", "n")
    # Only the first block of a group may be low: elsewhere every level is hashed, even over one node.
    n, low = F.col("n"), F.col("kids")
    tops = [F.col("node")]
    for _ in range(DIGITS):
        tops.append(F.get(low, 0)["node"])
        low = F.get(low, 0)["kids"] if len(tops) <= DIGITS else low
    levels = F.lit(DIGITS)
    for h in reversed(range(DIGITS)):
        levels = F.when((F.col("block") == 0) & (n <= FAN**h), h).otherwise(levels)
    shaped = tree.withColumn("levels", levels)
    top = F.lit(None).cast("string")
    for h in range(DIGITS + 1):
        top = F.when(F.col("levels") == h, tops[DIGITS - h]).otherwise(top)
    return stored(shaped.select(group, "block", top.alias("node"), "levels", F.col("kids").alias("tree")), label)


def opened(blocks: DataFrame, group: str, payload: list[str], carry: list[str]) -> DataFrame:
    """The nodes of blocks again: ``group``, ``rank``, payload and ``steps`` up to the root, the lowest first.

    ``blocks`` has ``steps`` of the nodes above it, and ``carry`` columns for all its nodes.
    """
    keep = [group, "block", "levels", "steps", *carry]
    out = blocks.select(*keep, F.col("tree").alias("kids"), F.lit(0).cast("long").alias("rank"), F.array().cast(_STEP).alias("mine"))
    for i in reversed(range(DIGITS)):
        digests = F.col("kids.node")
        at = out.select(*keep, "rank", "mine", digests.alias("all"), F.posexplode("kids").alias("pos", "kid"))
        step = F.struct(
            F.array_join(F.slice("all", F.lit(1), F.col("pos")), "").alias("l"),
            F.array_join(F.slice("all", F.col("pos") + 2, F.lit(FAN)), "").alias("r"),
        )
        # Steps above the top of a low block do not exist.
        mine = F.when(F.col("levels") > i, F.concat(F.array(step), F.col("mine"))).otherwise(F.col("mine"))
        rank = F.col("rank") * FAN + F.col(f"kid.d{i}")
        below = [F.col("kid.kids").alias("kids")] if i else [F.col("kid.node").alias("node"), *[F.col(f"kid.{p}").alias(p) for p in payload]]
        out = at.select(*keep, rank.alias("rank"), mine.alias("mine"), *below)
    return out.select(group, (F.col("block") * FAN**DIGITS + F.col("rank")).alias("rank"), "node", *payload, F.concat("mine", "steps").alias("steps"), *carry)


def _tiers(nodes: DataFrame, group: str, payload: list[str], label: str) -> list[DataFrame]:
    """Blocks of blocks, until every group has one."""
    tiers = [rolled(nodes, group, payload, f"{label}-0")]
    while not tiers[-1].where(F.col("block") > 0).isEmpty():
        above = tiers[-1].select(group, F.col("block").alias("rank"), "node")
        tiers.append(rolled(above, group, [], f"{label}-{len(tiers)}"))
    return tiers


def _down(tiers: list[DataFrame], top: DataFrame, group: str, payload: list[str], carry: list[str]) -> DataFrame:
    """Nodes with all their steps; ``top`` is the last tier with the ``steps`` above each group and what all nodes of it carry."""
    for i in reversed(range(len(tiers))):
        nodes = opened(top, group, payload if i == 0 else [], carry)
        if i:
            paths = nodes.select(F.col(group).alias("_group"), F.col("rank").alias("_block"), "steps", *carry)
            top = tiers[i - 1].join(paths, F.col(group).eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_block"))).drop("_group", "_block")
    return nodes


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]), 256))


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per row: ``doc_id``, ``leaf``, ``subroot`` of its source, ``root``, the digest of its siblings ``proof_sha256``,
    the root folded from its leaf as it is after tampering, ``folded_root``, and ``verified``."""
    leaves = with_leaves(docs, id_col, source_col, text_col, fields)
    ranked = numbered(leaves, "source", ["doc_id", "leaf"], docs.count())
    tiers = _tiers(ranked.withColumnRenamed("leaf", "node"), "source", ["doc_id", "bent"], "merkle-source")
    subroots = tiers[-1].select(F.lit(0).alias("_one"), "source", F.col("node").alias("subroot"))
    # Nulls come first in Spark's order, and strings are compared bytewise.
    placed = numbered(subroots, "_one", ["source"], subroots.count())
    upper = _tiers(placed.select("_one", "rank", F.col("subroot").alias("node"), "source"), "_one", ["source"], "merkle-root")
    root = upper[-1].withColumn("steps", F.array().cast(_STEP)).withColumn("root", F.col("node"))
    each = _down(upper, root, "_one", ["source"], ["root"]).select(F.col("source").alias("_group"), "steps", F.col("node").alias("subroot"), "root")
    top = tiers[-1].join(each, F.col("source").eqNullSafe(F.col("_group"))).drop("_group")
    nodes = _down(tiers, top, "source", ["doc_id", "bent"], ["subroot", "root"])
    proof = F.sha2(F.array_join(F.transform("steps", lambda s: F.concat(s["l"], s["r"])), ""), 256)
    back = folded(F.coalesce("bent", "node"), F.col("steps"))
    out = nodes.select("doc_id", "source", F.col("node").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), back.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
