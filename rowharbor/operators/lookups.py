"""Descriptions to ids, and tolerant matching of names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rowharbor.functions.numbers import parse_number
from rowharbor.functions.text import VALUE_TOKENS, is_missing, strip
from rowharbor.operators.references import keyed_join

#: Limits of the name matching tiers.
NAME_LIMIT = 31
PREFIX_CHECK = 25
CLOSE_MATCHES = 5

#: Characters of the runs by which names are listed.
GRAM = 3


def description_map(dim: DataFrame, description: str, id_column: str, order_column: str) -> DataFrame:
    """One id per description as it stands; the last row in ``order_column`` wins."""
    usable = dim.where(F.col(description).isNotNull() & F.col(id_column).isNotNull())
    return usable.groupBy(F.col(description).alias("_desc")).agg(F.max_by(id_column, order_column).alias("_mapped"))


def _left_lookup(rows: DataFrame, value: Column, keys: DataFrame, key: str) -> DataFrame:
    """Left join on a text value; partitions of hot values and of rows without one can be split."""
    valued = rows.withColumn("_value", value)
    right, condition = keyed_join(valued, keys, ["_value"], [key])
    return valued.join(right, condition, "left").drop(key)


def lookup_id(
    df: DataFrame, column: str, dim: DataFrame, description: str, id_column: str, order_column: str
) -> DataFrame:
    """Replace descriptions by ids: whole numbers stay, known descriptions map, others become NULL.

    Adds ``lookup_status``: ``id``, ``mapped``, ``unmapped`` or ``missing``.
    """
    text = strip(F.col(column).cast("string"))
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
        as_id = F.when(F.col(column) == F.floor(column), F.col(column).try_cast("bigint"))
    else:
        as_id = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))
    to_map = F.when(~is_missing(text, VALUE_TOKENS) & as_id.isNull(), text)
    joined = _left_lookup(df, to_map, description_map(dim, description, id_column, order_column), "_desc")
    status = (
        F.when(as_id.isNotNull(), "id")
        .when(F.col("_mapped").isNotNull(), "mapped")
        .when(F.col("_value").isNotNull(), "unmapped")
        .otherwise("missing")
    )
    return joined.withColumns(
        {column: F.coalesce(as_id, F.col("_mapped").cast("bigint")), "lookup_status": status, "lookup_text": text}
    ).drop("_mapped", "_value")


def lookup_id_keep(
    df: DataFrame, column: str, dim: DataFrame, description: str, id_column: str, order_column: str
) -> DataFrame:
    """Ids stay, known descriptions map, any other text is kept. The result is text."""
    text = F.when(~is_missing(F.col(column), VALUE_TOKENS), strip(F.col(column).cast("string")))
    raw = dim.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("string").alias("_id"))
    whole = raw.select(parse_number(strip(F.col("_id"))).try_cast("bigint").cast("string").alias("_id")).where(
        "_id IS NOT NULL"
    )
    ids = raw.unionByName(whole).distinct().select(F.col("_id").alias("_desc"), F.col("_id").alias("_mapped"), F.lit(0).alias("_rank"))
    named = description_map(dim, description, id_column, order_column).select(
        "_desc", F.col("_mapped").cast("string").alias("_mapped"), F.lit(1).alias("_rank")
    )
    # An id hit beats a description hit, so both share one key set and one join.
    known = ids.unionByName(named).groupBy("_desc").agg(F.min_by("_mapped", "_rank").alias("_mapped"))
    joined = _left_lookup(df, text, known, "_desc")
    return joined.withColumn(column, F.coalesce(F.col("_mapped"), F.col("_value"))).drop("_mapped", "_value")


def unmapped_values(looked_up: DataFrame) -> DataFrame:
    """Distinct texts a lookup could not map, with their row counts."""
    return (
        looked_up.where(F.col("lookup_status") == "unmapped")
        .groupBy(F.col("lookup_text").alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def lookup_coverage(looked_up: DataFrame) -> DataFrame:
    """One row: mapped rows, unmapped rows, distinct unmapped texts.

    Counted per text first, so neither a hot text nor a long list of texts meets in one task.
    """
    per_text = looked_up.groupBy("lookup_status", F.when(F.col("lookup_status") == "unmapped", F.col("lookup_text")).alias("_t")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    mapped, unmapped = F.col("lookup_status") == "mapped", F.col("lookup_status") == "unmapped"
    return per_text.agg(
        F.coalesce(F.sum(F.when(mapped, F.col("_n"))), F.lit(0)).alias("mapped"),
        F.coalesce(F.sum(F.when(unmapped, F.col("_n"))), F.lit(0)).alias("unmapped"),
        F.count_if(unmapped).alias("distinct_unmapped"),
    )


def _tiers(name: Column, requested: bool) -> list[tuple[int, Column]]:
    """Match keys of a name, best tier first. A NULL key takes no part in its tier."""
    lowered = F.lower(name)
    trimmed = strip(lowered)
    spaced = strip(F.translate(trimmed, "_-", "  "))
    if requested:
        underscored = F.replace(spaced, F.lit(" "), F.lit("_"))
        long = F.char_length(name) > NAME_LIMIT
        truncated = F.when(long, F.lower(F.left(name, F.lit(NAME_LIMIT))))
        prefix = F.when(long, F.left(trimmed, F.lit(PREFIX_CHECK)))
    else:
        underscored = F.translate(trimmed, " -", "__")
        truncated = lowered
        prefix = None
    tiers = [(1, name), (2, trimmed), (3, spaced), (4, underscored), (5, truncated)]
    return tiers + ([(6, prefix)] if prefix is not None else [])


def match_names(requested: DataFrame, name: str, available: DataFrame, available_name: str, order: str) -> DataFrame:
    """Resolve names through six tiers; the first tier that hits wins, then the earliest name.

    Tiers: exact, case and outer blanks, ``_``/``-`` as blanks, underscores, cut at 31
    characters, 25-character prefix of a longer name. All tiers are one equi-join on
    (tier, key) between distinct requested names and the first available name per key.
    Returns ``requested_name``, ``matched_name``, ``tier`` for the names that match.
    """
    wanted = requested.select(F.col(name).alias("requested_name")).where("requested_name IS NOT NULL").distinct()
    wanted_keys = wanted.select(
        "requested_name",
        F.explode(
            F.array(*[F.struct(F.lit(t).alias("tier"), k.alias("key")) for t, k in _tiers(F.col("requested_name"), True)])
        ).alias("_k"),
    ).select("requested_name", "_k.tier", "_k.key")
    base = available.select(F.col(available_name).alias("matched_name"), F.col(order).alias("_order")).where(
        "matched_name IS NOT NULL"
    )
    lowered = F.lower(F.col("matched_name"))
    prefixes = F.when(
        F.char_length("matched_name") <= NAME_LIMIT,
        F.transform(
            F.sequence(F.lit(0), F.least(F.char_length(lowered), F.lit(PREFIX_CHECK))),
            lambda n: F.struct(F.lit(6).alias("tier"), F.left(lowered, n).alias("key")),
        ),
    ).otherwise(F.array().cast("array<struct<tier:int,key:string>>"))
    keys = F.array(*[F.struct(F.lit(t).alias("tier"), k.alias("key")) for t, k in _tiers(F.col("matched_name"), False)])
    first_per_key = (
        base.select("matched_name", "_order", F.explode(F.concat(keys, prefixes)).alias("_k"))
        .groupBy("_k.tier", "_k.key")
        .agg(F.min_by("matched_name", "_order").alias("matched_name"))
    )
    hits = wanted_keys.join(first_per_key, ["tier", "key"], "inner")
    best = hits.groupBy("requested_name").agg(F.min(F.struct("tier", "matched_name")).alias("_best"))
    return best.select("requested_name", "_best.matched_name", "_best.tier")


def _grams(c: Column, sizes: Sequence[int]) -> Column:
    """The distinct runs of so many characters of a name; size 0 is the empty run."""
    length = F.char_length(c)

    def of(n: int) -> Column:
        places = F.when(length >= n, F.sequence(F.lit(1), length - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.substring(c, i, F.lit(n)))

    return F.array_distinct(F.concat(*[F.array(F.lit("")) if n == 0 else of(n) for n in sizes]))


def _contained(needles: DataFrame, needle: str, stacks: DataFrame, stack: str) -> DataFrame:
    """Pairs of columns of both sides where a needle of more than ``GRAM`` characters lies within a stack.

    A stack is listed under each of its grams, and a needle looks into the list of that of its grams that the fewest stacks have;
    a needle with a gram that no stack has is settled by that. The pairs of a list are verified.
    """
    lists = stacks.select(*stacks.columns, F.explode(_grams(F.col(stack), [GRAM])).alias("_gram"))
    sizes = lists.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    long = needles.where(F.char_length(needle) > GRAM)
    asked = long.select(F.col(needle).alias("_needle"), F.explode(_grams(F.col(needle), [GRAM])).alias("_gram")).distinct()
    rarest = asked.join(sizes, "_gram", "left").groupBy("_needle").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram")).alias("_best"))
    keyed = long.join(rarest.where("_best.n > 0").select("_needle", "_best._gram"), F.col(needle) == F.col("_needle")).drop("_needle")
    return keyed.join(lists, "_gram").where(F.contains(F.col(stack), F.col(needle))).drop("_gram")


def _first_k(names: DataFrame, key: str, k: int, position: str | None = None) -> DataFrame:
    """The first ``k`` names per key. Each task drops the rest of its rows before the shuffle."""
    by_order = Window.partitionBy(key).orderBy("_order", "close_match")
    ranked = names.withColumn("_rank", F.row_number().over(by_order)).where(F.col("_rank") <= k)
    return ranked.withColumnRenamed("_rank", position) if position else ranked.drop("_rank")


def close_matches(
    requested: DataFrame, name: str, available: DataFrame, available_name: str, order: str, k: int = CLOSE_MATCHES
) -> DataFrame:
    """Up to ``k`` available names, in their order, that contain the requested name or lie within it.

    Names are listed by their runs of three characters, and the rarest run of the shorter text says which list to look
    into, so work grows with the lengths of the names. A text of up to three characters is a run itself: of the names
    that hold it, only the first ``k`` can be wanted.
    """
    wanted = (
        requested.select(F.col(name).alias("requested_name"))
        .where("requested_name IS NOT NULL")
        .distinct()
        .withColumn("_want", strip(F.lower("requested_name")))
    )
    base = available.select(F.col(available_name).alias("close_match"), F.col(order).alias("_order")).where(
        "close_match IS NOT NULL"
    )
    shown = ["requested_name", "close_match", "_order"]
    short = range(GRAM + 1)
    # Of equal names only the first can be wanted.
    firsts = _first_k(base.withColumn("_low", F.lower("close_match")), "_low", k)

    by_run = _first_k(firsts.select("close_match", "_order", F.explode(_grams(F.col("_low"), short)).alias("_run")), "_run", k)
    holds_short = by_run.join(wanted, F.col("_run") == F.col("_want")).select(shown)
    holds_long = _contained(wanted, "_want", firsts, "_low").select(shown)

    wanted_runs = wanted.select("requested_name", F.explode(_grams(F.col("_want"), short)).alias("_run"))
    within_short = wanted_runs.join(firsts, F.col("_run") == F.col("_low")).select(shown)
    within_long = _contained(firsts, "_low", wanted, "_want").select(shown)
    containing, contained = holds_short.unionByName(holds_long), within_short.unionByName(within_long)
    pairs = containing.unionByName(contained).distinct()
    ranked = _first_k(pairs, "requested_name", k, "position")
    return ranked.select("requested_name", "position", "close_match")
