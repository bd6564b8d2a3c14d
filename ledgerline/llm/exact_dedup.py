"""Exact duplicates by progressive refinement: length, then hash of the first bytes, then hash of everything.

Texts are compared after every run of ASCII white space has become one space. Each
step groups only what the step before left in a group of two or more; the full
digest is computed for those rows alone. All grouping starts in the map tasks, and
what is joined back to the rows has one row per group, so Spark's adaptive
execution can split a group that holds a large share of the rows.

Defined cases: NULL text is the empty text. Ids are compared as they are; rows with
the same id and text are one document (they share its verdict, and
``drop_exact_duplicates`` keeps one of them). The smallest non-NULL id stays; a
group without any id is kept, since its rows cannot be told apart. Input columns
named like output columns are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import aside, plain_text, small_or_plain, stored, without

WHITE = r"[\x20\x09-\x0D]+"
OUT = ("keep_id", "group_size", "kept")
_KEY = ("_length", "_head")


def normalised(text_col: str) -> Column:
    return F.regexp_replace(plain_text(text_col), WHITE, " ")


def _keyed(docs: DataFrame, id_col: str, text_col: str, head: int) -> DataFrame:
    texts = docs.select(F.col(id_col).alias("_id"), normalised(text_col).alias("_norm"))
    start = F.xxhash64(F.substring("_norm", 1, head))
    return texts.select("_id", "_norm", F.octet_length("_norm").alias("_length"), start.alias("_head"))


#: Columns returned beside ``OUT``, and those used on the way.
_MORE = ("_same", "_id", *_KEY)
_INNER = (*_MORE, "_member", *[f"_m{c}" for c in _KEY])


def duplicate_members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = 128) -> DataFrame:
    """One row per id, length and head hash of every text that occurs twice or more: ``keep_id``,
    ``group_size`` and ``_same``, the number of rows with this very id and text."""
    rows = _keyed(docs, id_col, text_col, head)
    more = F.count(F.lit(1)).alias("_n")
    lengths = rows.groupBy("_length").agg(more).where("_n > 1").select("_length")
    heads = rows.join(lengths, "_length", "left_semi").groupBy(*_KEY).agg(more).where("_n > 1").select(*_KEY)
    heads = small_or_plain(heads, "exact-heads")
    full = rows.join(heads, list(_KEY), "left_semi").select("_id", *_KEY, F.sha2("_norm", 256).alias("_digest"))
    per_id = full.groupBy("_id", *_KEY, "_digest").agg(F.count(F.lit(1)).alias("_same"))
    groups = per_id.groupBy(*_KEY, "_digest").agg(F.min("_id").alias("keep_id"), F.sum("_same").alias("group_size"))
    found = per_id.join(groups.where("group_size > 1"), [*_KEY, "_digest"])
    return found.select("_id", *_KEY, "keep_id", "group_size", "_same")


def with_verdict(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = 128, carry: dict[str, Column] | None = None
) -> DataFrame:
    """All rows with ``keep_id``, ``group_size`` and ``kept``.

    ``carry`` names expressions over the input to return in place of its columns, so
    that texts need not travel when only a digest of them is wanted.
    """
    if carry is None and (other := aside(docs, _INNER)):
        given = docs.toDF(*[other.get(c, c) for c in docs.columns])
        kept = with_verdict(given, other.get(id_col, id_col), other.get(text_col, text_col), head)
        # The operator's own columns replace those of the input.
        back = {v: k for k, v in other.items() if k.lower() not in {n.lower() for n in _MORE}}
        return kept.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in kept.columns if c in back or c not in other.values()])
    members = duplicate_members(docs, id_col, text_col, head).withColumnRenamed("_id", "_member")
    members = members.select("_member", *[F.col(c).alias(f"_m{c}") for c in _KEY], "keep_id", "group_size", "_same")
    base = without(docs, *OUT) if carry is None else docs
    cols = [F.col(f"`{c}`") for c in base.columns] if carry is None else [e.alias(n) for n, e in carry.items()]
    norm = normalised(text_col)
    rows = base.select(
        *cols, F.col(id_col).alias("_id"), F.octet_length(norm).alias("_length"),
        F.xxhash64(F.substring(norm, 1, head)).alias("_head"),
    )
    on = F.col("_id").eqNullSafe(F.col("_member"))
    for c in _KEY:
        on = on & (F.col(c) == F.col(f"_m{c}"))
    alone = F.col("group_size").isNull()
    return rows.join(members, on, "left").select(
        *[F.col(f"`{c}`") for c in (base.columns if carry is None else carry)],
        F.when(alone, F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(alone, F.lit(True)).otherwise(F.col("_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.coalesce("_same", F.lit(1)).alias("_same"), "_id", *_KEY,
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = 128) -> DataFrame:
    """The rows that stay, with the columns of the input; texts move only if very many rows go."""
    members = stored(duplicate_members(docs, id_col, text_col, head), "exact-members")
    gone = members.where("NOT _id <=> keep_id").select("_id", *_KEY)
    twice = members.where("_id <=> keep_id AND _same > 1 AND _id IS NOT NULL").select("_id", *_KEY)
    norm = normalised(text_col)
    at = [F.col(id_col), F.octet_length(norm), F.xxhash64(F.substring(norm, 1, head))]

    def meet(side: DataFrame):
        on = at[0].eqNullSafe(side["_id"])
        for c, name in zip(at[1:], _KEY):
            on = on & (c == side[name])
        return on

    both = small_or_plain(gone.union(twice), "exact-gone")
    rest = docs.join(both, meet(both), "left_anti")
    some = small_or_plain(twice, "exact-twice")
    names = [f"c{i}_{c}" for i, c in enumerate(docs.columns)]
    again = docs.join(some, meet(some), "left_semi").toDF(*names)
    where = [names[docs.columns.index(c)] for c in (id_col, text_col)]
    again = again.withColumn("_norm", normalised(where[1])).dropDuplicates([where[0], "_norm"]).select(*names)
    return rest.union(again.toDF(*docs.columns))
