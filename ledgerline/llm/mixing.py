"""Mix sources to target weights by Pfair scheduling with earliest deadline first.

The documents of a source, in hashed order, form blocks. Block j (from 1) of a source
with weight w may run from slot floor((j-1)/w) on and must run before slot ceil(j/w).
Each slot takes the released block with the earliest deadline, so that after any
number of slots every source is less than one block away from its share.

Weights are whole numbers of slots of a period, so the schedule repeats with the
period. One period follows from the weights alone and is planned before the job; its
length depends on the number of sources, never on the number of rows. Spark numbers
the documents of a source (counts per hash bucket, running totals of these, positions
inside a bucket), so a source with most of the rows is spread over many tasks.

Defined cases: a NULL source is a source of its own; NULL ids and texts are ordered
like any value; an empty table gives an empty result. All rows are returned.
``in_mix`` is true up to the slot in which a source first has no block left: before
it the weights hold, behind it they cannot. Input columns named like output columns
are replaced.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.llm.common import aside, without

OUT = ("block", "slot", "position", "in_mix")


#: Columns used on the way; input columns of these names are renamed meanwhile.
_INNER = ("_s", "_h", "_b", "_n", "_start", "_r", "_t", "a", "p", "s", "t")


def period_shares(weights: dict[str, float], slots: int) -> dict[str, int]:
    """Whole slots for each source, at least one, that sum to ``slots`` (largest remainders)."""
    total = sum(weights.values())
    exact = {s: w / total * slots for s, w in weights.items()}
    shares = {s: max(1, int(x)) for s, x in exact.items()}
    by_need = sorted(exact, key=lambda s: (shares[s] - exact[s], s))
    missing, i = slots - sum(shares.values()), 0
    while missing:
        s = by_need[i % len(by_need)] if missing > 0 else by_need[-1 - i % len(by_need)]
        step = 1 if missing > 0 else -1
        if shares[s] + step >= 1:
            shares[s] += step
            missing -= step
        i += 1
    return shares


def edf_period(shares: dict[str, int]) -> dict[str, list[int]]:
    """The slots of each source within one period."""
    slots = sum(shares.values())
    waiting = [(0, -(-slots // a), s) for s, a in shares.items()]
    ready: list[tuple[int, str]] = []
    taken: dict[str, list[int]] = {s: [] for s in shares}
    heapq.heapify(waiting)
    for slot in range(slots):
        while waiting and waiting[0][0] <= slot:
            _, deadline, s = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, s))
        _, s = heapq.heappop(ready)
        taken[s].append(slot)
        j, a = len(taken[s]), shares[s]
        if j < a:
            heapq.heappush(waiting, (j * slots // a, -(-(j + 1) * slots // a), s))
    return taken


def tempered(counts: dict[str, int], alpha: float) -> dict[str, float]:
    """Weights between the natural shares (alpha 1) and equal ones (alpha 0)."""
    return {s: n**alpha for s, n in counts.items()}


def mix_sources(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    block: int = 8,
    alpha: float = 0.7,
    slots: int = 1024,
    bucket_rows: int = 10_000,
) -> DataFrame:
    """All rows with ``block``, ``slot``, ``position`` and ``in_mix``.

    Without ``weights`` a source weighs its number of rows to the power ``alpha``.
    Given weights must name every source. The list of sources is configuration: it,
    and nothing else, comes to the driver.
    """
    if other := aside(docs, _INNER):
        given = docs.toDF(*[other.get(c, c) for c in docs.columns])
        names = [other.get(c, c) for c in (id_col, source_col, text_col)]
        mixed = mix_sources(given, weights, *names, block, alpha, slots, bucket_rows)
        back = {v: k for k, v in other.items()}
        return mixed.toDF(*[back.get(c, c) for c in mixed.columns])
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    counts = {r["_s"]: r["n"] for r in docs.groupBy(key.alias("_s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    base = without(docs, *OUT)
    if not counts:
        return base.select("*", *[F.lit(None).cast("long").alias(c) for c in OUT[:3]], F.lit(True).alias("in_mix"))
    if weights is None:
        wanted = tempered(counts, alpha)
    else:
        wanted = {"null" if s is None else f"={s}": w for s, w in weights.items()}
        if missing := sorted(counts.keys() - wanted.keys()):
            raise ValueError(f"sources without a weight: {missing[:5]}")
    slots = max(slots, 4 * len(wanted))
    shares = period_shares(wanted, slots)
    taken = edf_period(shares)
    ends = []
    for s, a in shares.items():
        blocks = -(-counts.get(s, 0) // block)
        ends.append(blocks // a * slots + taken[s][blocks % a])

    # The plan of one period as a small inline table.
    plan = [{"s": s, "t": t, "p": slot} for s, at in taken.items() for t, slot in enumerate(at)]
    schema = "array<struct<s:string,t:bigint,p:bigint>>"
    period = docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(plan)), schema)))
    per = docs.sparkSession.range(1).select(
        F.inline(F.from_json(F.lit(json.dumps([{"s": s, "a": a} for s, a in shares.items()])), "array<struct<s:string,a:bigint>>"))
    )

    buckets = max(256, sum(counts.values()) // bucket_rows)
    mixed = F.xxhash64(F.col(id_col), F.col(text_col).cast("string"), F.lit(17))
    rows = base.select("*", key.alias("_s"), mixed.alias("_h")).withColumn("_b", F.pmod("_h", F.lit(buckets)))
    sizes = rows.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("_s").orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("_s", "_b", F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy("_s", "_b").orderBy("_h", id_col)) - 1
    ranked = rows.withColumn("_r", inside).join(starts, ["_s", "_b"]).withColumn("_r", F.col("_r") + F.col("_start"))
    turns = ranked.withColumn("block", F.floor(F.col("_r") / block)).join(F.broadcast(per.withColumnRenamed("s", "_s")), "_s")
    turns = turns.withColumn("_t", F.col("block") % F.col("a"))
    placed = turns.join(F.broadcast(period.select(F.col("s").alias("_s"), F.col("t").alias("_t"), "p")), ["_s", "_t"])
    slot = F.floor(F.col("block") / F.col("a")) * slots + F.col("p")
    return placed.select(
        *[F.col(f"`{c}`") for c in base.columns],
        "block",
        slot.alias("slot"),
        (slot * block + F.col("_r") % block).alias("position"),
        (slot < min(ends)).alias("in_mix"),
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The part of the documents in which the weights hold, with the columns of the input."""
    names = [f"c{i}_{c}" for i, c in enumerate(docs.columns)]
    given = docs.toDF(*names)
    at = {k: names[docs.columns.index(options.pop(k, d))] for k, d in (("id_col", "doc_id"), ("source_col", "source"), ("text_col", "text"))}
    return mix_sources(given, **at, **options).where("in_mix").select(*names).toDF(*docs.columns)
