"""Load one table, or many in order: clean, check, coerce, keep last, reference check, upsert, report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rowharbor.functions.json_text import repair_json
from rowharbor.functions.messages import reason_kind
from rowharbor.operators import metrics as M
from rowharbor.operators.clean import (
    ROW_SEQ,
    clean,
    evolve_target,
    lists_to_json,
    rename,
    split_factor,
    with_row_seq,
)
from rowharbor.operators.coerce import REASON, STAGE, TYPED, check_types
from rowharbor.operators.keys import generate_keys
from rowharbor.operators.keysets import key_sides, side_counts
from rowharbor.operators.merge import ARRIVED, CHANGE, KEPT, STORED, arrived, load_warning, merged_change, merged_value, side_by_side
from rowharbor.operators.references import chained_orphans, fk_all_or_nothing, fk_flags, fk_reason, keyed_join, same_family
from rowharbor.operators.validate import UNIQUE_REASON, constraint_reason, pk_reason, range_reason
from rowharbor.plans.order import load_order
from rowharbor.session import cut_and_count, cut_lineage, fits_broadcast
from rowharbor.spec import ForeignKey, SpecError, TableSpec

#: Helper columns: the whole row, and the first constraint it breaks. Names of data columns are trimmed, so a leading blank sets these apart.
ROW = " row"
RULE = " rule"


@dataclass
class LoadResult:
    """Outcome of one table load. DataFrames are lazy reads of stages that were written once."""

    table: str
    snapshot: DataFrame
    rejected: DataFrame
    fk_rejected: DataFrame
    counts: DataFrame
    notes: DataFrame
    changes: DataFrame
    replaced: bool = False
    #: Rows by what became of them, as the writes counted them; ``kept`` are stored rows that the batch does not touch.
    tally: dict[str, int] = field(default_factory=dict)

    def metrics(self) -> DataFrame:
        """Load metrics of this table."""
        return M.load_metrics(self.counts)


def prepare(batch: DataFrame, spec: TableSpec, seq: str | None = None) -> DataFrame:
    """Clean cells, rename columns and run the table's own repairs, before anything is judged.

    ``seq`` names an ordering column of the batch; without one the place in the read files counts.
    The columns of a reject report are dropped, so that corrected rejects can be sent in as they are.
    """
    df = rename(clean(with_row_seq(batch, seq)), spec.renames).drop(REASON, STAGE)
    for transform in spec.transforms:
        df = df.transform(transform)
    df = lists_to_json(df, spec.list_columns)
    if spec.factor_column:
        df = split_factor(df, spec.factor_column)
    if spec.generated_key and spec.generated_key in df.columns:
        df = generate_keys(df, spec.generated_key)
    return df


def judge(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The typed row of every accepted row; the raw cells, reason and stage of every other.

    A missing key is reported before a type. A broken constraint is noted in ``RULE`` but does not reject yet:
    of the rows of a key only the last is held against the constraints. All of it is a
    chain of projections over the batch, without a shuffle; the columns go by their places, so that no name of the batch matters.
    """
    absent = [c for c in spec.pk if c not in df.columns]
    if absent:
        raise SpecError(f"{spec.name}: primary key columns absent from the rows: {absent}")
    data = [c for c in df.columns if c != ROW_SEQ]
    place = {c: f"c{i}" for i, c in enumerate(data)}
    placed = df.select(*[F.col(f"`{c}`").alias(place[c]) for c in data], F.col(ROW_SEQ), pk_reason(spec.pk).alias("pk_reason"))
    checked = check_types(placed, {place[c]: w for c, w in spec.types.items() if c in place}, spec.keep_time, spec.real_bools, spec.reference_year)
    typed = {c: F.col(f"{TYPED}.{place[c]}") for c in data}
    stage = F.when(F.col("pk_reason").isNotNull(), "pk").when(F.col(REASON).isNotNull(), "type")
    judged = checked.withColumns({STAGE: stage, REASON: F.coalesce("pk_reason", REASON), RULE: constraint_reason(spec, data, typed.__getitem__)})
    passed = F.col(STAGE).isNull()
    return judged.select(
        F.when(passed, F.struct(*[typed[c].alias(c) for c in data])).alias(TYPED),
        F.when(~passed, F.struct(*[F.col(place[c]).alias(c) for c in data])).alias("_raw"),
        ROW_SEQ,
        RULE,
        REASON,
        STAGE,
    )


def _last_rows(passed: DataFrame, spec: TableSpec, data: Sequence[str]) -> DataFrame:
    """The last row of every key as a struct of the wanted columns, with JSON repaired and decimals cast."""
    decimals = {f.name: f.dataType for f in spec.storage_schema() if f.name in spec.decimals}

    def value(c: str) -> Column:
        v = F.col(f"{TYPED}.`{c}`")
        v = repair_json(v) if spec.types.get(c) == "dict" else v
        return v.try_cast(decimals[c]) if c in decimals else v

    last_first = Window.partitionBy(*[F.col(f"{TYPED}.`{c}`") for c in spec.pk]).orderBy(F.col(ROW_SEQ).desc())
    last = passed.withColumn("_rn", F.row_number().over(last_first)).where("_rn = 1")
    return last.select(F.struct(*[value(c).alias(c) for c in data]).alias(ROW), ROW_SEQ, RULE)


def _check_uniques(rows: DataFrame, spec: TableSpec, target: DataFrame) -> DataFrame:
    """Note rows whose unique key another row of the batch has, or a stored row that the batch does not replace.

    NULL never collides. The keys in use are counted before the shuffle; rows meet them in one join per unique key.
    """
    for columns in spec.uniques:
        if any(c not in rows.columns for c in columns):
            continue
        names = [f"_used_{c}" for c in columns]
        good = rows.where(F.col(RULE).isNull()).dropna(subset=list(columns))
        repeated = good.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*columns)
        used = repeated
        if all(c in target.columns for c in (*columns, *spec.pk)):
            kept = target.join(rows.select(*spec.pk), list(spec.pk), "left_anti").dropna(subset=list(columns))
            used = repeated.unionByName(kept.select(*columns)).distinct()
        right, condition = keyed_join(rows, used.toDF(*names).withColumn("_taken", F.lit(True)), list(columns), names)
        text = F.lit(UNIQUE_REASON % ", ".join(columns))
        rows = rows.join(right, condition, "left").withColumn(RULE, F.coalesce(RULE, F.when(F.col("_taken"), text)))
        rows = rows.drop(*names, "_taken")
    return rows


def _own_references(rows: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    """The parents, where a table that refers to itself also has the keys of the batch."""
    own = [fk for fk in spec.foreign_keys if fk.parent == spec.name and fk.parent_column in rows.columns]
    if not own or spec.name not in parents:
        return parents
    columns = sorted({fk.parent_column for fk in own})
    return {**parents, spec.name: parents[spec.name].select(columns).unionByName(rows.select(columns))}


def _checked_references(rows: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Foreign-key reasons; a row rejected for its own table takes the rows that refer to it along.

    Rows that break a constraint are no parents, and keep that reason.
    """
    unbroken = rows.where(F.col(RULE).isNull())
    if spec.fk_policy != "filter":
        checked = fk_all_or_nothing(unbroken, spec.foreign_keys, _own_references(unbroken, spec, parents))
        text = f"Foreign key violation: an orphan row rejects the whole batch of {spec.name}"
        checked = checked.withColumn(REASON, F.when(~F.col("accepted"), F.lit(text))).drop("accepted")
        return checked.unionByName(rows.where(F.col(RULE).isNotNull()), allowMissingColumns=True)
    checked = fk_flags(rows, spec.foreign_keys, _own_references(unbroken, spec, parents))
    own = [fk for fk in spec.foreign_keys if fk.parent == spec.name and spec.name in parents and fk.column in rows.columns]
    if not own:
        return checked
    checked = cut_lineage(checked, f"{spec.name}-own-references")
    lost = F.coalesce(RULE, REASON).isNotNull()
    if checked.where(lost).isEmpty():
        return checked
    fk, stored = own[0], parents[spec.name]
    if len(own) == 1 and list(spec.pk) == [fk.parent_column] and same_family(rows, fk.column, stored, fk.parent_column):
        orphans = chained_orphans(checked.withColumn("lost", lost), fk.parent_column, fk.column, "lost", stored.select(fk.parent_column))
        names = [f"`{fk.parent_column}`", "`orphan`"]
        joined = checked.join(orphans.toDF("orphan"), F.col(names[0]) == F.col(names[1]), "left")
        return joined.withColumn(REASON, F.coalesce(REASON, F.when(F.col("orphan").isNotNull(), fk_reason(fk)))).drop("orphan")
    return _by_levels(checked, spec, parents)


def _by_levels(checked: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Repeat the check against what is left until nothing more goes, for tables with several references to themselves."""
    before = -1
    while (now := checked.where(F.col(REASON).isNotNull()).count()) != before:
        before = now
        left = checked.where(F.coalesce(RULE, REASON).isNull())
        checked = fk_flags(checked.drop(REASON), spec.foreign_keys, _own_references(left, spec, parents))
        checked = cut_lineage(checked, f"{spec.name}-own-references")
    return checked


def load_table(
    batch: DataFrame,
    spec: TableSpec,
    target: DataFrame | Callable[[DataFrame], DataFrame],
    parents: Mapping[str, DataFrame] | None = None,
    mode: str = "incremental",
    dry_run: bool = False,
    seq: str | None = None,
) -> LoadResult:
    """Run the whole load of one table and return its outcome without writing the target.

    Two tables are written to the shared folder: the judged batch, and the outcome, which holds every row of the new
    table and every row that was rejected after typing. The writes count their rows as they go. Only tables with unique keys,
    with references to themselves, or with a batch small enough to leave a large target where it is, write the rows in between.
    ``target`` may be a function from the batch's keys to the target rows that can hold
    them, so that only those are read.
    """
    if mode not in ("incremental", "initial"):
        raise SpecError(f"unknown mode {mode!r}")
    spark, parents = batch.sparkSession, parents or {}
    stages = {s: F.count_if(F.col(STAGE) == s) for s in ("pk", "type")}
    counts = {"passed": F.count_if(F.col(STAGE).isNull()), **stages}
    judged, read = cut_and_count(judge(prepare(batch, spec, seq), spec), f"{spec.name}-judged", counts)

    passed = judged.where(F.col(STAGE).isNull()).select(TYPED, ROW_SEQ, RULE)
    on_demand = callable(target)
    if on_demand:
        target = target(passed.select([F.col(f"{TYPED}.`{c}`").alias(c) for c in spec.pk]))
    data = judged.schema[TYPED].dataType.fieldNames()
    if not spec.evolve:
        data = [c for c in data if c in target.columns]
        if not data:
            raise SpecError(f"{spec.name}: no column of the batch exists in the target")
    checked = _checked_rows(passed, spec, data, target, parents, mode)
    if mode == "incremental" and not (dry_run or on_demand) and fits_broadcast(judged) and not fits_broadcast(target):
        checked = cut_lineage(checked, f"{spec.name}-checked")
    wide = evolve_target(target, checked.select(f"{ROW}.*"))
    outcome, ended = _write_outcome(checked, spec, data, target if mode == "incremental" and not dry_run else None, wide, dry_run, on_demand)

    stored = ~F.startswith(F.col(CHANGE), F.lit("rejected"))
    rows = outcome.where(stored).select("stored.*")
    if dry_run:
        snapshot = target
    else:
        snapshot = rows if mode == "incremental" or ended["inserted"] else wide
    raw = judged.where(F.col(STAGE).isNotNull()).select("_raw.*", REASON, STAGE)
    late = {s: outcome.where(F.col(STAGE) == s).select("rejected.*", REASON, STAGE) for s in ("constraint", "fk")}
    kinds = {f.name: f.dataType for f in raw.schema}
    ruled = late["constraint"]
    ruled = ruled.select([F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in ruled.columns])
    changes = outcome.where(stored & (F.col(CHANGE) != KEPT)).select("stored.*", CHANGE)

    tally = {f"rejected_{s}": read[s] for s in stages} | ended
    tally["deduplicated"] = read["passed"] - sum(n for s, n in ended.items() if s != KEPT)
    listed = [(spec.name, s, n) for s, n in tally.items() if n and s != KEPT] or [(spec.name, "read", 0)]
    return LoadResult(
        table=spec.name,
        snapshot=snapshot,
        rejected=raw.unionByName(ruled, allowMissingColumns=True),
        fk_rejected=late["fk"],
        counts=spark.createDataFrame(listed, "table string, status string, n bigint"),
        notes=_notes(spark, spec, judged, outcome, tally, parents),
        changes=changes,
        replaced=mode == "initial" and not dry_run and ended["inserted"] > 0,
        tally=tally,
    )


def _checked_rows(passed: DataFrame, spec: TableSpec, data: Sequence[str], target: DataFrame, parents: Mapping[str, DataFrame], mode: str) -> DataFrame:
    """``ROW``, ``ROW_SEQ``, stage and reason of the last row of every key."""
    rows = _last_rows(passed, spec, data)
    fields = rows.select(f"{ROW}.*")
    value = lambda c: F.col(f"{ROW}.`{c}`")
    rows = rows.withColumn(RULE, F.coalesce(RULE, range_reason(fields, target.schema, value)))
    own = {fk.parent_column for fk in spec.foreign_keys if fk.parent == spec.name}
    named = {fk.column for fk in spec.foreign_keys} | own | ({*spec.pk, *(c for u in spec.uniques for c in u)} if spec.uniques else set())
    rows = rows.select("*", *[value(c).alias(c) for c in data if c in named])
    if spec.uniques:
        stored = target.limit(0) if mode == "initial" else target
        rows = _check_uniques(cut_lineage(rows, f"{spec.name}-kept"), spec, stored)
    elif spec.fk_policy != "filter" and spec.foreign_keys:
        rows = cut_lineage(rows, f"{spec.name}-kept")
    checked = _checked_references(rows, spec, parents)
    stage = F.when(F.col(RULE).isNotNull(), "constraint").when(F.col(REASON).isNotNull(), "fk")
    return checked.select(ROW, ROW_SEQ, stage.alias(STAGE), F.coalesce(RULE, REASON).alias(REASON))


def _write_outcome(
    checked: DataFrame, spec: TableSpec, data: Sequence[str], target: DataFrame | None, wide: DataFrame, dry_run: bool, one_scan: bool
) -> tuple[DataFrame, dict[str, int]]:
    """Write the new table and the late rejects in one pass: ``stored`` or ``rejected`` row, change, reason, stage, place.

    Without a target every good row is inserted. Rejected rows do not meet the stored row of their key.
    """
    kinds = {f.name: f.dataType for f in wide.schema}
    good = F.col(STAGE).isNull()
    helpers = {ROW: F.when(~good, F.col(ROW)), " seq": F.col(ROW_SEQ), " stage": F.col(STAGE), " reason": F.col(REASON), " good": good}
    typed = [F.col(f"{ROW}.`{c}`").try_cast(kinds[c]).alias(c) for c in data]
    batch = checked.select(*typed, *[v.alias(n) for n, v in helpers.items()])
    if target is None:
        nulls = [F.lit(None).cast(f.dataType).alias(STORED + f.name) for f in wide.schema]
        both = batch.select(*[F.col(f"`{c}`").alias(ARRIVED + c) for c in batch.columns], F.lit(True).alias(ARRIVED), *nulls, F.lit(None).cast("boolean").alias(STORED))
    else:
        both = side_by_side(wide, batch, spec.pk, mergeable=" good", one_scan=one_scan)
    change = F.when(F.lit(dry_run), F.lit("valid")).otherwise(merged_change(data, spec.pk))
    change = F.when(arrived(" stage").isNotNull(), F.concat(F.lit("rejected_"), arrived(" stage"))).otherwise(change)
    row = F.struct(*[merged_value(f, data, spec.pk, spec.defaults) for f in wide.schema])
    outcome = both.select(
        F.when(arrived(" stage").isNull(), row).alias("stored"),
        arrived(ROW).alias("rejected"),
        change.alias(CHANGE),
        arrived(" reason").alias(REASON),
        arrived(" stage").alias(STAGE),
        arrived(" seq").alias(ROW_SEQ),
    )
    ends = (KEPT, *M.LOADED, "valid", "rejected_constraint", "rejected_fk")
    return cut_and_count(outcome, f"{spec.name}-outcome", {e: F.count_if(F.col(CHANGE) == e) for e in ends})


def _notes(
    spark: SparkSession, spec: TableSpec, judged: DataFrame, outcome: DataFrame, tally: Mapping[str, int], parents: Mapping[str, DataFrame]
) -> DataFrame:
    """(table, reason, n, seq): reasons by kind with their row counts in order of their first row, then the notes of the run."""
    reasons = judged.where(F.col(STAGE).isNotNull()).select(REASON, ROW_SEQ)
    reasons = reasons.unionAll(outcome.where(F.col(STAGE) == "constraint").select(REASON, ROW_SEQ))
    kinds = reasons.groupBy(reason_kind(F.col(REASON)).alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.min(ROW_SEQ).alias("first"))
    # A handful of rows: reasons are cut to their kinds.
    order = F.row_number().over(Window.partitionBy("table").orderBy("first", "reason")).cast("bigint")
    kinds = kinds.select(F.lit(spec.name).alias("table"), "reason", "n", "first").select("table", "reason", "n", order.alias("seq"))
    extra = M.standard_notes(tally["deduplicated"], tally["rejected_fk"], spec.pk)
    counted = {s for s, n in tally.items() if n and s != KEPT}
    if "unchanged" in counted and counted <= {"unchanged", "deduplicated"}:
        extra.append(M.NOTE_IDEMPOTENT)
    unknown = sorted({fk.parent for fk in spec.foreign_keys if fk.parent not in parents})
    extra += [f"References to {name} were not checked: no such table" for name in unknown]
    if not extra:
        return kinds
    last = 1 << 62
    rows = [(spec.name, text, 0, last + i) for i, text in enumerate(extra)]
    return kinds.unionByName(spark.createDataFrame(rows, "table string, reason string, n bigint, seq bigint"))


@dataclass
class RunResult:
    """Outcome of a run over many tables."""

    results: dict[str, LoadResult] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    emptied: dict[str, DataFrame] = field(default_factory=dict)
    #: Descriptions of the tables that ran, in the order they ran in, and all tables as the run leaves them.
    specs: list[TableSpec] = field(default_factory=list)
    stored: dict[str, DataFrame] = field(default_factory=dict)

    def snapshots(self) -> dict[str, DataFrame]:
        """The tables that the run has changed: those loaded, and those emptied because a parent was replaced."""
        return self.emptied | {name: r.snapshot for name, r in self.results.items()}

    def rejects(self) -> DataFrame:
        """All rejected rows of the run, with table and stage."""
        parts = [
            part.select([F.col(f"`{c}`").cast("string").alias(c) for c in part.columns]).withColumn("table", F.lit(name))
            for name, r in self.results.items()
            for part in (r.rejected, r.fk_rejected)
        ]
        if not parts:
            raise SpecError("no table was loaded")
        stacked = parts[0]
        for part in parts[1:]:
            stacked = stacked.unionByName(part, allowMissingColumns=True)
        return stacked

    def records(self, spark: SparkSession) -> DataFrame:
        """Run records: counts and notes of every table that ran, and the errors of those that failed."""
        columns = ["sheet", "table", "read_rows", "valid_rows", "rejected_rows", "inserted", "updated", "notes"]
        failed = error_records(self, spark)
        if not self.results:
            return failed
        texts = None
        for name, r in self.results.items():
            one = M.notes(r.notes, "table", "seq", "reason")
            texts = one if texts is None else texts.unionByName(one)
        ran = self.metrics().join(texts, "table", "left").withColumn("sheet", F.col("table"))
        ran = ran.withColumn("notes", F.coalesce("notes", F.lit("")))
        return ran.select(columns).unionByName(failed, allowMissingColumns=True)

    def references(self) -> DataFrame:
        """``table, column, parent, key, in_left, in_right``: every value that a loaded or orphaned row refers to, and every value there is.

        All references of all tables are stacked and reduced in one aggregation; values are compared as text.
        """
        parts = []
        for spec in self.specs:
            result = self.results[spec.name]
            for fk in spec.foreign_keys:
                if fk.parent not in self.stored or fk.column not in result.changes.columns:
                    continue
                names = [F.lit(n).alias(c) for n, c in ((spec.name, "table"), (fk.column, "column"), (fk.parent, "parent"))]
                for side, rows, column in (("l", result.changes, fk.column), ("l", result.fk_rejected, fk.column), ("r", self.stored[fk.parent], fk.parent_column)):
                    if column in rows.columns:
                        parts.append(rows.select(*names, F.col(f"`{column}`").cast("string").alias("key"), F.lit(side == "l").alias("l")))
        if not parts:
            raise SpecError("no table that was loaded refers to another")
        return key_sides(reduce(DataFrame.unionAll, parts), ["table", "column", "parent"])

    def missing_keys(self) -> DataFrame:
        """Every referenced value that does not exist after the run."""
        return self.references().where("in_left AND NOT in_right").select("table", "column", "parent", F.col("key").alias("value"))

    def missing_summary(self) -> DataFrame:
        """Per reference: missing, existing, referenced and loaded values."""
        return side_counts(self.references(), ["table", "column", "parent"])

    def issues(self) -> DataFrame:
        """What is wrong with the rejected rows of each table, in plain words, and what to do about it."""
        noted = reduce(DataFrame.unionByName, [r.notes for r in self.results.values()])
        reasons = noted.groupBy("table").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "reason"))), lambda x: x["reason"]).alias("reasons"))
        return M.issues(self.metrics().join(reasons, "table").withColumn("sheet", F.col("table")))

    def verification(self, spark: SparkSession) -> DataFrame:
        """Rows before, after and added of every table that was merged into, from the counts of its load, with a warning where fewer were added than processed."""
        rows = [
            (name, r.tally[KEPT] + r.tally["updated"] + r.tally["unchanged"], r.tally["inserted"], sum(r.tally[s] for s in M.LOADED))
            for name, r in self.results.items()
            if not r.replaced
        ]
        counted = spark.createDataFrame(rows, "table string, rows_before bigint, rows_added bigint, rows_processed bigint")
        counted = counted.withColumn("rows_after", F.col("rows_before") + F.col("rows_added"))
        return counted.select("table", "rows_before", "rows_after", "rows_processed", "rows_added", load_warning().alias("warning"))

    def metrics(self) -> DataFrame:
        """Load metrics of all tables that ran."""
        parts = [r.counts for r in self.results.values()]
        if not parts:
            raise SpecError("no table was loaded")
        stacked = parts[0]
        for part in parts[1:]:
            stacked = stacked.unionByName(part)
        return M.load_metrics(stacked)


def load_all(
    batches: Mapping[str, DataFrame],
    specs: Sequence[TableSpec],
    targets: Mapping[str, DataFrame],
    mode: str = "incremental",
    only: Sequence[str] | None = None,
    dry_run: bool = False,
    seqs: Mapping[str, str] | None = None,
    category: str | None = None,
) -> RunResult:
    """Load tables, parents before the tables that refer to them, each against the snapshots of those before it.

    Where tables refer to each other in a circle, a parent that comes later counts with its stored rows and with the keys
    that arrive for it. A table that fails is recorded and the others go on. ``only`` narrows the run to
    some tables and ``category`` to one load category; the others still serve as parents.
    """
    run = RunResult()
    stored = run.stored
    stored.update(targets)
    ordered = load_order(specs)
    for place, spec in enumerate(ordered):
        if (only is not None and spec.name not in only) or (category and spec.category != category):
            continue
        try:
            if spec.name not in batches:
                raise SpecError(f"no batch named {spec.name!r}")
            parents = stored | _later_parents(spec, ordered[place + 1 :], stored, batches)
            result = load_table(
                batches[spec.name], spec, stored[spec.name], parents, mode, dry_run, (seqs or {}).get(spec.name)
            )
            run.results[spec.name], stored[spec.name] = result, result.snapshot
            run.specs.append(spec)
            if result.replaced:
                for name in _descendants(spec.name, specs) - set(run.results):
                    run.emptied[name] = stored[name] = stored[name].limit(0)
        except Exception as e:  # whatever stops one table, the others go on
            run.errors[spec.name] = str(e)
    return run


def _later_parents(
    spec: TableSpec, later: Sequence[TableSpec], stored: Mapping[str, DataFrame], batches: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """The key columns of parents that are loaded after ``spec``: the stored keys and those that arrive."""
    found = {}
    for parent in later:
        columns = sorted({fk.parent_column for fk in spec.foreign_keys if fk.parent == parent.name})
        if not columns or parent.name not in batches or parent.name not in stored:
            continue
        rows = prepare(batches[parent.name], parent)
        columns = [c for c in columns if c in rows.columns]
        typed = check_types(rows.select(columns), {c: parent.types[c] for c in columns if c in parent.types}, parent.keep_time, parent.real_bools)
        held = stored[parent.name].select([F.col(f"`{c}`") for c in columns if c in stored[parent.name].columns])
        found[parent.name] = held.unionByName(typed.select(f"{TYPED}.*"), allowMissingColumns=True)
    return found


def _descendants(name: str, specs: Sequence[TableSpec]) -> set[str]:
    """Tables that refer to a table, directly or through others; a replaced table takes their rows along."""
    found: set[str] = set()
    waiting = [name]
    while waiting:
        parent = waiting.pop()
        children = {s.name for s in specs if any(fk.parent == parent for fk in s.foreign_keys)} - found - {name}
        found |= children
        waiting += children
    return found


def error_records(run: RunResult, spark: SparkSession) -> DataFrame:
    """Run records of the tables that failed."""
    rows = [(name, name, text) for name, text in run.errors.items()]
    return M.error_records(spark.createDataFrame(rows, "sheet string, table string, error string"))


__all__ = ["ForeignKey", "LoadResult", "RunResult", "error_records", "judge", "load_all", "load_table", "prepare"]
