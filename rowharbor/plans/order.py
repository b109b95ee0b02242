"""What a run does before it loads: the order of its tables, and which present table each of them is read from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from rowharbor.operators.lookups import close_matches, match_names
from rowharbor.sources.tables import LoadedTables, read_tables, table_names
from rowharbor.spec import TableSpec

NOT_FOUND = "no table named %s"
CLOSE = "; close names: %s"
PRESENT = "; present: %s"


def load_order(specs: Sequence[TableSpec]) -> list[TableSpec]:
    """Parents before the tables that refer to them, otherwise as given.

    References of a table to itself and to tables outside ``specs`` do not count. Where tables refer to each other in a
    circle, the first of them by name goes first, whatever the given order.
    """
    waiting = {s.name: s for s in specs}
    reach = {n: _above(n, waiting) for n in waiting}
    ordered = []
    while waiting:
        free = [n for n, s in waiting.items() if not any(fk.parent in waiting and fk.parent != n for fk in s.foreign_keys)]
        if not free:  # only circles and what hangs on them are left: open one that waits for nothing but itself
            circles = [n for n in waiting if all(n in reach[m] for m in reach[n] if m in waiting)]
            free = [min(circles)]
        ordered.append(waiting.pop(free[0]))
    return ordered


def _above(name: str, specs: Mapping[str, TableSpec]) -> set[str]:
    """The tables that a table refers to, directly or through others."""
    found: set[str] = set()
    ahead = [name]
    while ahead:
        parents = {fk.parent for fk in specs[ahead.pop()].foreign_keys if fk.parent in specs} - found
        found |= parents
        ahead += parents
    return found


def read_batches(
    spark: SparkSession, folder: str, names: Mapping[str, str], fmt: str = "parquet", all_text: bool = False
) -> tuple[LoadedTables, dict[str, str]]:
    """Read the table each target is configured to come from, under the name it has in the folder.

    ``names`` maps a target to its configured name, which is matched as :func:`match_names` does; where nothing matches, the
    name of the target is tried. Returns the tables by target, with an error that lists close names for those not found, and
    the names they were read under.
    """
    present = spark.createDataFrame(list(enumerate(table_names(spark, folder, fmt))), "ord long, name string")
    asked = [(t, n, rank) for t, configured in names.items() for rank, n in enumerate((configured, t))]
    wanted = spark.createDataFrame(asked, "target string, asked string, rank int")
    found = {r["requested_name"]: r["matched_name"] for r in match_names(wanted, "asked", present, "name", "ord").collect()}
    chosen = {t: found.get(configured) or found.get(t) for t, configured in names.items()}
    read = read_tables(spark, folder, sorted({n for n in chosen.values() if n}), fmt, all_text)
    out = LoadedTables({t: read.tables[n] for t, n in chosen.items() if n in read.tables}, {t: read.errors[n] for t, n in chosen.items() if n in read.errors})
    lost = [t for t, n in chosen.items() if not n]
    if lost:
        near: dict[str, list[str]] = {}
        for r in close_matches(wanted.where(wanted["target"].isin(lost)), "asked", present, "name", "ord").orderBy("position").collect():
            near.setdefault(r["requested_name"], []).append(r["close_match"])
        for t in lost:
            tried = list(dict.fromkeys((names[t], t)))
            close = list(dict.fromkeys(m for n in tried for m in near.get(n, [])))
            text = NOT_FOUND % " or ".join(map(repr, tried))
            out.errors[t] = text + (CLOSE % ", ".join(close) if close else PRESENT % ", ".join(table_names(spark, folder, fmt)))
    return out, {t: n for t, n in chosen.items() if n}
