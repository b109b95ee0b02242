"""Referential integrity between DataFrames.

Every check is an equi-join of the child with the distinct keys of the parent. Spark
picks the join: broadcast where it measured the key set to be small, sort-merge
otherwise. No side is ever broadcast by a hint. For the sort-merge case the joins are
laid out so that a value held by a large share of the child is split over tasks:

* the distinct keys get their own exchange, which is the shape adaptive execution needs to split a hot child partition;
* rows whose key is missing match nothing; they share a partition, which is split in the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowharbor.functions.numbers import parse_number
from rowharbor.functions.text import REFERENCE_TOKENS, is_missing, strip
from rowharbor.session import cut_lineage
from rowharbor.spec import ForeignKey, SpecError

REASON = "rejection_reason"

#: Wording of a foreign-key rejection.
FK_REASON = "Foreign key violation: "
FK_NOT_FOUND = " not found in "
FK_EMPTY_PARENT = " (reference table is empty)"

#: Texts of a parent key that also match by number.
_NUMERIC_KEY = r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def keyed_join(rows: DataFrame, keys: DataFrame, row_cols: Sequence[str], key_cols: Sequence[str]) -> tuple[DataFrame, Column]:
    """The unique ``keys``, prepared for an equi-join with ``rows``, and the join condition.

    Keys that come from an aggregation lie where the join wants them already, and a join without an exchange of its own on
    both sides cannot be split. The keys pass through an expression that gives them back unchanged but hides this.
    """
    unchanged = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key_cols]), F.lit(1)) == 0
    right = keys.withColumns({k: F.when(unchanged, F.col(f"`{k}`")) for k in key_cols})
    return right, reduce(and_, [rows[f"`{r}`"] == right[f"`{k}`"] for r, k in zip(row_cols, key_cols)])


def reference_keys(parent: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of a column."""
    return parent.select(column).where(F.col(column).isNotNull()).distinct()


def _text_like(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def same_family(child: DataFrame, fk: str, parent: DataFrame, ref: str) -> bool:
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    a, b = child.schema[fk].dataType, parent.schema[ref].dataType
    if isinstance(a, whole) and isinstance(b, whole):
        return True
    return type(a) is type(b) and not isinstance(a, T.StringType)


def _resolved_text_keys(child: DataFrame, fk: str, parent: DataFrame, ref: str, out: str) -> DataFrame:
    """Distinct child values that equal a parent value as text or as a number.

    Only distinct values take part, so a hot value counts once; text and number are
    two separate equi-joins because one OR condition would compare all pairs.
    """
    key = F.col(fk).cast("string")
    values = child.where(~is_missing(F.col(fk), REFERENCE_TOKENS)).select(key.alias(out)).distinct()
    refs = parent.where(F.col(ref).isNotNull())
    text_refs = refs.select(F.col(ref).cast("string").alias("_ref_text")).distinct()
    number = (
        F.when(F.col(ref).rlike(_NUMERIC_KEY), F.col(ref).try_cast("double"))
        if _text_like(parent, ref)
        else F.col(ref).cast("double")
    )
    number_refs = refs.select(number.alias("_ref_number")).where("_ref_number IS NOT NULL").distinct()
    numbered = values.withColumn("_number", parse_number(strip(F.col(out))))
    by_text = numbered.join(text_refs, F.col(out) == F.col("_ref_text"), "left_semi").select(out)
    by_number = numbered.join(number_refs, F.col("_number") == F.col("_ref_number"), "left_semi").select(out)
    return by_text.unionByName(by_number).distinct()


def with_hit(
    child: DataFrame, fk: str, parent: DataFrame, ref: str, hit: str
) -> DataFrame:
    """Child rows plus a flag ``hit``: the value exists in the parent or is missing."""
    key = f"_ref_{hit}"
    if same_family(child, fk, parent, ref):
        refs = parent.where(F.col(ref).isNotNull()).select(F.col(ref).alias(key))
        keys, rows, join_col = refs.distinct(), child, fk
    else:
        keys = _resolved_text_keys(child, fk, parent, ref, key)
        join_col = f"_text_{hit}"
        rows = child.withColumn(
            join_col, F.when(~is_missing(F.col(fk), REFERENCE_TOKENS), F.col(fk).cast("string"))
        )
    right, condition = keyed_join(rows, keys.withColumn(hit, F.lit(True)), [join_col], [key])
    joined = rows.join(right, condition, "left")
    found = F.col(join_col).isNull() | F.col(hit).isNotNull()
    return joined.withColumn(hit, found).drop(key, *([join_col] if join_col != fk else []))


def _empty_suffix(parent: DataFrame, ref: str) -> Column:
    """Suffix for the reason when the parent has no usable key, read once as a scalar."""
    some = parent.where(F.col(ref).isNotNull()).limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
    return F.when(some == 0, F.lit(FK_EMPTY_PARENT)).otherwise(F.lit(""))


def fk_reason(fk: ForeignKey, parent: DataFrame | None = None, mark_empty: bool = True) -> Column:
    """Text of a foreign-key rejection for the current row."""
    parts = [
        F.lit(f"{FK_REASON}{fk.column}="),
        F.col(fk.column).cast("string"),
        F.lit(f"{FK_NOT_FOUND}{fk.parent}.{fk.parent_column}"),
    ]
    if mark_empty and parent is not None:
        parts.append(_empty_suffix(parent, fk.parent_column))
    return F.concat(*parts)


def _with_hits(
    child: DataFrame, fks: Sequence[ForeignKey], parents: Mapping[str, DataFrame]
) -> tuple[DataFrame, list[ForeignKey]]:
    """Child rows with a flag ``_hit<i>`` for every key that can be tested, and those keys."""
    tested = [fk for fk in fks if fk.column in child.columns and fk.parent in parents]
    flagged = child
    for i, fk in enumerate(tested):
        flagged = with_hit(flagged, fk.column, parents[fk.parent], fk.parent_column, f"_hit{i}")
    return flagged, tested


def fk_flags(
    child: DataFrame,
    fks: Sequence[ForeignKey],
    parents: Mapping[str, DataFrame],
    all_reasons: bool = False,
    mark_empty: bool = True,
) -> DataFrame:
    """Child rows with the reason of their first broken foreign key (NULL when none).

    All keys are tested over one scan of the child. A key is not tested when its
    column or its parent table is absent. With ``all_reasons`` an array of every
    broken key's reason is added as ``all_reasons``.
    """
    flagged, tested = _with_hits(child, fks, parents)
    reasons = [
        F.when(~F.col(f"_hit{i}"), fk_reason(fk, parents[fk.parent], mark_empty)) for i, fk in enumerate(tested)
    ]
    out = {REASON: F.coalesce(*reasons) if reasons else F.lit(None).cast("string")}
    if all_reasons:
        out["all_reasons"] = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return flagged.withColumns(out).drop(*[f"_hit{i}" for i in range(len(tested))])


def _numbered(number: Column) -> Column:
    """A match key that equal numbers share."""
    return F.concat(F.lit("n"), (number + F.lit(0.0)).cast("string"))


def orphan_pairs(child: DataFrame, fks: Sequence[ForeignKey], parents: Mapping[str, DataFrame]) -> DataFrame:
    """``ref, value``: the values of all keys (``ref`` counts them) that their parents lack, from one scan of the child and one join.

    The distinct (key, value) pairs of the child meet the stacked keys of all parents. Where child and parent differ in type, a value
    also matches as a number, so it takes part under two keys.
    """
    mixed = {i for i, fk in enumerate(fks) if not same_family(child, fk.column, parents[fk.parent], fk.parent_column)}
    values, known = [], []
    for i, fk in enumerate(fks):
        own, parent = F.col(fk.column), parents[fk.parent].where(F.col(fk.parent_column).isNotNull())
        ref = F.col(fk.parent_column)
        values.append(F.struct(F.lit(i).alias("ref"), (F.when(~is_missing(own, REFERENCE_TOKENS), own.cast("string")) if i in mixed else own.cast("string")).alias("value")))
        keys = F.array(ref.cast("string"))
        if i in mixed:
            number = F.when(ref.rlike(_NUMERIC_KEY), ref.try_cast("double")) if _text_like(parent, fk.parent_column) else ref.cast("double")
            keys = F.array_compact(F.array(F.concat(F.lit("t"), ref.cast("string")), _numbered(number)))
        known.append(parent.select(F.lit(i).alias("ref"), F.explode(keys).alias("key")))
    pairs = child.select(F.explode(F.array(*values)).alias("p")).select("p.*").where("value IS NOT NULL").distinct()
    both = F.array_compact(F.array(F.concat(F.lit("t"), F.col("value")), _numbered(parse_number(strip(F.col("value"))))))
    asked = F.when(F.col("ref").isin(*mixed), both).otherwise(F.array("value")) if mixed else F.array("value")
    keyed = pairs.select("ref", "value", F.explode(asked).alias("key"))
    there = reduce(DataFrame.unionAll, known).distinct().withColumn("there", F.lit(True))
    found = keyed.join(there, ["ref", "key"], "left").groupBy("ref", "value").agg(F.bool_or(F.col("there").isNotNull()).alias("found"))
    return found.where("NOT found").select("ref", "value")


def _orphan_flags(child: DataFrame, fks: Sequence[ForeignKey], parents: Mapping[str, DataFrame], mark_empty: bool) -> DataFrame:
    """:func:`fk_flags` by the values that are missing, which are worked out and written once for all that read the result.

    They are mostly few, so the child meets them where it is; keys without orphans take no join.
    """
    tested = [fk for fk in fks if fk.column in child.columns and fk.parent in parents]
    reasons, flagged = [], child
    if tested:
        orphans = cut_lineage(orphan_pairs(child, tested, parents), "orphans")
        broken = {r["ref"] for r in orphans.groupBy("ref").count().collect()}  # at most a row per key
        for i in sorted(broken):
            fk, key, hit = tested[i], f" orphan{i}", f" hit{i}"
            mixed = not same_family(child, fk.column, parents[fk.parent], fk.parent_column)
            kind = "string" if mixed else child.schema[fk.column].dataType
            own = orphans.where(F.col("ref") == i).select(F.col("value").cast(kind).alias(key), F.lit(True).alias(hit))
            value = F.col(f"`{fk.column}`").cast("string") if mixed else F.col(f"`{fk.column}`")
            flagged = flagged.join(own, value == own[f"`{key}`"], "left")
            reasons.append(F.when(F.col(f"`{hit}`"), fk_reason(fk, parents[fk.parent], mark_empty)))
        flagged = flagged.withColumn(REASON, F.coalesce(*reasons) if reasons else F.lit(None).cast("string"))
        return flagged.drop(*[f" {n}{i}" for i in broken for n in ("orphan", "hit")])
    return flagged.withColumn(REASON, F.lit(None).cast("string"))


def fk_split_many(
    child: DataFrame,
    fks: Sequence[ForeignKey],
    parents: Mapping[str, DataFrame],
    policy: str = "filter",
    mark_empty: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy every foreign key, and the others with their first reason.

    All keys are checked together when this is called, and both halves read the same outcome. Policy ``skip`` lets all
    rows pass unchecked.
    """
    if policy == "skip":
        return child, child.limit(0).withColumn(REASON, F.lit(None).cast("string"))
    if policy != "filter":
        raise SpecError(f"unknown foreign key policy {policy!r}")
    return _halves(_orphan_flags(child, fks, parents, mark_empty))


def _halves(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return flagged.where(F.col(REASON).isNull()).drop(REASON), flagged.where(F.col(REASON).isNotNull())


def fk_split(
    child: DataFrame, fk: ForeignKey, parent: DataFrame, mark_empty: bool = True
) -> tuple[DataFrame, DataFrame]:
    """:func:`fk_split_many` for one foreign key."""
    return fk_split_many(child, [fk], {fk.parent: parent}, mark_empty=mark_empty)


def orphan_values(child: DataFrame, fk: ForeignKey, parent: DataFrame) -> DataFrame:
    """Distinct child values without a parent; cheap because only distinct values join."""
    values = child.select(fk.column).distinct()
    return with_hit(values, fk.column, parent, fk.parent_column, "_hit").where("NOT _hit").drop("_hit")


def fk_all_or_nothing(child: DataFrame, fks: Sequence[ForeignKey], parents: Mapping[str, DataFrame]) -> DataFrame:
    """Rows marked ``accepted``: all true, or all false as soon as one row is an orphan.

    The child itself is not joined: one scalar tells whether any key has orphans.
    """
    tested = [fk for fk in fks if fk.column in child.columns and fk.parent in parents]
    if not tested:
        return child.withColumn("accepted", F.lit(True))
    some = orphan_pairs(child, tested, parents).limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
    return child.withColumn("accepted", some == 0)


def fk_cascade(
    tables: Sequence[tuple[str, DataFrame]], fks: Mapping[str, Sequence[ForeignKey]]
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Check tables in load order, each against the rows its parents have left.

    Rejecting a parent row makes its children orphans in turn. What the levels below need of a checked table, its
    referenced columns, is written once; the rows of a table are read where they are and joined with the keys of their parents.
    """
    asked = {fk.parent: set() for keys in fks.values() for fk in keys}
    for keys in fks.values():
        for fk in keys:
            asked[fk.parent].add(fk.parent_column)
    left: dict[str, DataFrame] = {}
    result: dict[str, tuple[DataFrame, DataFrame]] = {}
    for name, rows in tables:
        own = fks.get(name, ())
        result[name] = _halves(fk_flags(rows, own, left, mark_empty=False))
        columns = sorted(asked.get(name, set()) & set(rows.columns))
        checked = any(fk.parent in left and fk.column in rows.columns for fk in own)
        left[name] = cut_lineage(result[name][0].select(columns), f"{name}-keys") if checked and columns else rows
    return result


def chained_orphans(rows: DataFrame, key: str, fk: str, lost: str, stored: DataFrame) -> DataFrame:
    """Keys of rows that reach a lost row by following ``fk`` to ``key`` of the same rows, the lost ones left out.

    ``key`` is unique in ``rows``; references that ``stored`` (one column) satisfies lead nowhere. Every round a row
    takes over the reference of the row it refers to, so a round looks twice as far as the one before, and it is over
    when a round finds nothing new. Rows that are settled take no further part.
    """
    refers = rows.select(F.col(key).alias("k"), F.col(fk).alias("next"), F.col(lost).alias("lost"))
    known = stored.toDF("known").where("known IS NOT NULL").distinct()
    found = refers.where("next IS NOT NULL AND NOT lost").join(known, F.col("next") == F.col("known"), "left_anti")
    settled = F.lit(None).cast(rows.schema[fk].dataType)
    state = found.unionByName(refers.where("lost").withColumn("next", settled))
    state = cut_lineage(state, "references").withColumn("first", F.col("lost"))
    before = -1
    while (now := state.where("lost").count()) != before:
        before = now
        open_rows = state.where("next IS NOT NULL AND NOT lost")
        ahead = state.select(F.col("k").alias("ahead"), F.col("next").alias("then"), F.col("lost").alias("then_lost"))
        moved = open_rows.join(ahead, F.col("next") == F.col("ahead"), "left")
        moved = moved.select("k", F.col("then").alias("next"), F.coalesce("then_lost", F.lit(False)).alias("lost"), "first")
        state = cut_lineage(moved.unionByName(state.where("next IS NULL OR lost")), "references")
    return state.where("lost AND NOT first").select("k")


def delete_cascade(removed_keys: DataFrame, chain: Sequence[tuple[str, DataFrame, str, str]]) -> dict[str, DataFrame]:
    """What is left of each child once parent keys are deleted.

    ``chain`` lists (name, rows, foreign key column, own key column) from the top
    down; ``removed_keys`` has one column. Each level deletes by the keys the level
    above lost.
    """
    left: dict[str, DataFrame] = {}
    keys = removed_keys
    for name, rows, fk, own_key in chain:
        gone = keys.select(F.col(keys.columns[0]).alias("_gone")).where("_gone IS NOT NULL").distinct()
        gone, condition = keyed_join(rows, gone, [fk], ["_gone"])
        left[name] = rows.join(gone, condition, "left_anti")
        keys = rows.join(gone, condition, "left_semi").select(own_key)
    return left


def restrict_check(parent: DataFrame, key: str, children: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Parent rows still referenced by a child, which may not be deleted."""
    used = None
    for rows, fk in children:
        keys = rows.select(F.col(fk).alias("_used")).where("_used IS NOT NULL").distinct()
        used = keys if used is None else used.unionByName(keys)
    if used is None:
        return parent.limit(0)
    return parent.join(used, parent[key] == used["_used"], "left_semi")
