"""Line dedup by an edit-distance join over segments, in SQL expressions only.

Lines of ``min_chars`` code points or more take part. Two lines within ``edits`` edits, cut into ``edits + 1`` segments, agree in a
segment that is moved by a bounded shift. Each distinct line is indexed by its segments and probes the segments of lines that are
as long or up to ``edits`` shorter, at the shifts that the other segments leave possible. Lines that share a key are
candidates; a list of up to ``SHORT_LIST`` gives its pairs. The lines of longer lists are compared by stricter keys instead: cut into
``PIECES`` pieces, two lines within ``edits`` edits agree in all pieces but ``edits``, up to small shifts between those, so
everything outside each choice of pieces is a key. Of those, only lines pair whose letter counts differ by no more than the edits
can make them differ, which an index entry tells without the text. Candidates that share too few of some evenly spaced pieces are dropped,
the others verified by banded edit distance; for texts beyond ``NATIVE_CHARS`` it is bit-parallel: the band of ``2 * edits + 1``
diagonals lies in one integer, updated once per code point.

Linked lines and equal lines form classes. Of a class that stands in more than ``max_documents`` documents, the occurrence of the
smallest document id and line number stays and all others are removed; other lines stay. Lines under ``min_chars`` that are not
blank form classes by equality alone, as two edits would link short lines that say different things; the same number of
documents and the same choice of the first hold for them.

Lines are told apart by a 64-bit hash. Line breaks are ``\\n``.

Defined cases: a NULL text has no line, an empty text one empty line; blank lines are never removed; rows
without an id come first; repeated rows are documents of their own, so their lines count twice and the first stays in one of them only; an empty table
gives no rows; other columns are not read by ``repeated_lines``. ``remove_lines`` returns all columns of its input, without the
documents that lose their last non-blank line.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import combinations, product

from pyspark.sql import Column, DataFrame, functions as F

from rowharbor.llm.components import connected_components
from rowharbor.session import cut_lineage

EDITS = 2
MIN_CHARS = 24
MAX_DOCUMENTS = 6
SHORT_LIST = 64
#: Pieces into which the lines of longer lists are cut.
PIECES = 8
#: Letters that are counted together.
LETTERS = ("ae", "bi", "co", "du", "fs", "gt", "hn", "jr", "kl", "mv", "pw", "qx", "yz", "éè", "0123456789", " ")
HOLES = "array<struct<n:int,more:int,own:int,parts:array<struct<a:int,b:int,d:int>>>>"
#: Code points up to which Spark's own edit distance is the faster one; its time grows with their square.
NATIVE_CHARS = 1024
#: Tables of at most so many rows of 16 bytes are broadcast.
BROADCAST_ROWS = 1 << 20


def slots(edits: int) -> list[tuple[int, int, int]]:
    """How much shorter the other line is, the segment, and the shift of the segment, of every key of a line; its own segments first."""
    own = [(0, i, 0) for i in range(edits + 1)]
    more = []
    for shorter in range(edits + 1):
        for i in range(edits + 1):
            low = max(-i, shorter - (edits - i))
            high = min(i, shorter + (edits - i))
            more += [(shorter, i, shift) for shift in range(low, high + 1) if (shorter, i, shift) not in own]
    return own + more


def _segment(length: Column, edits: int, i: int) -> tuple[Column, Column]:
    """Start (from 0) and length of a segment of lines of a length; the last segments are the longer ones."""
    short = F.floor(length / (edits + 1)).cast("int")
    longer = length % (edits + 1)
    before = F.greatest(F.lit(0), longer - (edits + 1 - i))
    return (i * short + before).cast("int"), (short + F.when(longer >= edits + 1 - i, 1).otherwise(0)).cast("int")


def line_slots(text: Column, salt: Column, edits: int) -> list[tuple[Column, Column]]:
    """Condition and key of every slot. The first is of texts so short that segments may be
    empty; such texts are candidates of one another."""
    length = F.length(text)
    out = [(length <= 2 * edits, F.xxhash64(salt, F.lit("tiny")))]
    for shorter, i, shift in slots(edits):
        start, size = _segment(length - shorter, edits, i)
        at = start + shift
        key = F.xxhash64(salt, length - shorter, F.lit(i), F.substring(text, at + 1, size))
        out.append(((size > 0) & (at >= 0) & (at + size <= length), key))
    return out


def keyed_lines(lines: DataFrame, edits: int) -> DataFrame:
    """``id, keys`` of ``id, text``, once per id and without texts: a key for every slot, the index keys first, NULL where there is none.

    Plain expressions without lambdas, so that all keys of a line are worked out in generated code. Equal lines have equal
    keys; as plain numbers these are hashed together, where arrays would have to be sorted.
    """
    keys = [F.when(exists, key).alias(f"k{i}") for i, (exists, key) in enumerate(line_slots(F.col("text"), F.lit(0), edits))]
    names = [f"k{i}" for i in range(len(keys))]
    once = lines.select("id", *keys).groupBy("id").agg(*[F.min(k).alias(k) for k in names])
    return once.select("id", F.array(*names).alias("keys"))


def _sized(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast where its counted size allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _shared_entries(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of the keys that two entries share, and the entries of the keys that more share, with ``members``."""
    lists = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum("own").alias("owns"), F.min("id").alias("a"), F.max("id").alias("b"))
    lists = cut_lineage(lists.where("members > 1 and owns > 0 and a < b"), "lists")
    larger = cut_lineage(lists.where("members > 2").select("key", "members"), "larger-lists")
    return lists.where("members = 2").select("a", "b"), cut_lineage(entries.join(_sized(larger), "key"), "entries")


def letter_counts(text: Column) -> Column:
    """How often the letters of each group stand in a text."""
    return F.array(*[(F.length(text) - F.length(F.translate(text, letters + letters.upper() if letters.isalpha() else letters, ""))).cast("int") for letters in LETTERS])


def _pairs(entries: DataFrame, edits: int) -> DataFrame:
    """``a, b`` of each index entry with all entries of its key. Entries may have ``letters``: an edit changes two counts by one at most."""
    own = ["key", F.col("id").alias("x")] + [F.col("letters").alias("others")] * ("letters" in entries.columns)
    # Two index entries of a key meet once.
    met = entries.join(entries.where("own = 1").select(own), "key").where("id > x OR (own = 0 AND id != x)")
    if "letters" in entries.columns:
        apart = [F.abs(F.col("letters")[i] - F.col("others")[i]) for i in range(len(LETTERS))]
        met = met.where(reduce(Column.__add__, apart) <= 2 * edits)
    return met.select(F.least("id", "x").alias("a"), F.greatest("id", "x").alias("b"))


def candidate_pairs(source, edits: int) -> DataFrame:
    """``a, b`` (a < b) of lines that share a key. ``source(ids)`` gives ``id, text`` of the lines with these ids, or of all for None."""
    keyed = cut_lineage(keyed_lines(source(None), edits), "line-keys")
    entries = keyed.select("id", F.posexplode("keys").alias("slot", "key")).where("key IS NOT NULL")
    pairs, shared = _shared_entries(entries.select("id", "key", (F.col("slot") <= edits + 1).cast("int").alias("own")))
    found = pairs.unionByName(_pairs(shared.where(F.col("members") <= SHORT_LIST), edits))
    ids = cut_lineage(shared.where(F.col("members") > SHORT_LIST).select("id").distinct(), "long-lists")
    if not ids.isEmpty():
        texts = source(_sized(ids)).dropDuplicates(["id"])
        counted = texts.select("id", letter_counts(F.col("text")).alias("letters"), hole_keys(F.col("text"), edits).alias("keys"))
        holes = counted.select("id", "letters", F.explode("keys").alias("k")).select("id", "letters", "k.key", "k.own").where("key IS NOT NULL")
        pairs, shared = _shared_entries(cut_lineage(holes, "hole-keys"))
        found = found.unionByName(pairs).unionByName(_pairs(shared, edits))
    return cut_lineage(found.distinct(), "candidates")


def hole_table(edits: int) -> list[tuple[int, int, int, list[tuple[int, int, int]]]]:
    """For every choice of ``edits`` of the ``PIECES`` pieces of a line, and every way in which edits within these may
    shift what stands between them: number of the choice, surplus length, whether it is the line's own, and the stretches
    that stay, as first piece, end piece and shift."""
    ways = [
        shifts
        for shifts in product(range(-edits, edits + 1), repeat=edits)
        if shifts[-1] >= 0 and sum(abs(b - a) for a, b in zip((0, *shifts), shifts, strict=False)) <= edits
    ]
    out = []
    for number, holes in enumerate(combinations(range(PIECES), edits)):
        edges = list(zip([0, *(h + 1 for h in holes)], [*holes, PIECES], strict=True))
        for shifts in ways:
            out.append((number, shifts[-1], int(not any(shifts)), [(a, b, d) for (a, b), d in zip(edges, (0, *shifts), strict=True)]))
    return out


def hole_keys(text: Column, edits: int) -> Column:
    """``array<struct<key, own>>``: lines within ``edits`` edits agree in all but ``edits`` of their pieces, up to small shifts."""
    table = F.from_json(F.lit(json.dumps([{"n": n, "more": m, "own": o, "parts": [{"a": a, "b": b, "d": d} for a, b, d in p]} for n, m, o, p in hole_table(edits)])), HOLES)

    def edge(piece: Column, length: Column) -> Column:
        return F.floor(piece * length / PIECES).cast("int")

    def of(choice: Column) -> Column:
        length = F.length(text) - choice["more"]
        inside = F.forall(choice["parts"], lambda p: (edge(p["a"], length) + p["d"] >= 0) & (edge(p["b"], length) + p["d"] <= F.length(text)))
        parts = F.transform(choice["parts"], lambda p: F.substring(text, edge(p["a"], length) + p["d"] + 1, edge(p["b"], length) - edge(p["a"], length)))
        key = F.xxhash64(length, choice["n"], F.array_join(parts, "\n"))
        return F.struct(F.when(inside & (length > 0), key).alias("key"), choice["own"].alias("own"))

    return F.transform(table, of)


def banded_distance(left: Column, right: Column, edits: int) -> Column:
    """Edit distance of two texts whose lengths differ by ``edits`` at most; any value above ``edits`` only says that it is larger.

    Spark's own function runs in generated code and stays within the band, but seeks the start of the band anew for every
    code point; so longer texts are folded, without what they share at both ends.
    """
    native = F.levenshtein(left, right, edits)
    folded = _let(middles(left, right), lambda m: folded_distance(m["left"], m["right"], edits))
    return F.when((F.length(left) <= NATIVE_CHARS) & (F.length(right) <= NATIVE_CHARS), F.when(native < 0, edits + 1).otherwise(native)).otherwise(folded)


def folded_distance(left: Column, right: Column, edits: int) -> Column:
    """Edit distance of two texts whose lengths differ by ``edits`` at most; any value above ``edits`` only says that it is larger.

    Bit t of a vector belongs to row j - edits + t of column j. ``up`` and ``down`` hold where a cell is one
    more or one less than the cell above; the score follows the main diagonal and is led to the last row at the end.
    """
    width = 2 * edits + 1
    mask = (1 << width) - 1
    chars = F.struct(F.split(left, "").alias("rows"), F.split(right, "").alias("columns"), F.length(left).alias("m"), F.length(right).alias("n"))

    def distance(c: Column) -> Column:
        def step(state: Column, j: Column) -> Column:
            symbol = F.get(c["columns"], j)
            match = reduce(
                Column.bitwiseOR,
                [F.when(F.get(c["rows"], j + (t - edits)) == symbol, F.lit(1 << t)).otherwise(F.lit(0)) for t in range(width)],
            ).cast("bigint")
            # The band moves down by a row; the row that enters is taken to be one more than the row above.
            up = F.shiftright(state["up"], 1).bitwiseOR(F.lit(1 << (width - 1)))
            down = F.shiftright(state["down"], 1)
            return F.struct(match.alias("match"), up.alias("up"), down.alias("down"), state["score"].alias("score"))

        def zero(s: Column) -> Column:
            return (s["match"].bitwiseAND(s["up"]) + s["up"]).bitwiseXOR(s["up"]).bitwiseOR(s["match"]).bitwiseOR(s["down"]).bitwiseAND(F.lit(mask))

        def with_diagonal(s: Column) -> Column:
            return F.struct(zero(s).alias("zero"), s["up"].alias("up"), s["down"].alias("down"), s["score"].alias("score"))

        def across(s: Column) -> Column:
            more = s["down"].bitwiseOR(F.bitwise_not(s["zero"].bitwiseOR(s["up"])))
            return F.struct(
                s["zero"].alias("zero"),
                F.shiftleft(more, 1).bitwiseOR(F.lit(1)).bitwiseAND(F.lit(mask)).alias("more"),
                F.shiftleft(s["zero"].bitwiseAND(s["up"]), 1).bitwiseAND(F.lit(mask)).alias("less"),
                s["score"].alias("score"),
            )

        def moved(s: Column) -> Column:
            up = s["less"].bitwiseOR(F.bitwise_not(s["zero"].bitwiseOR(s["more"]))).bitwiseAND(F.lit(mask))
            score = s["score"] + F.lit(1) - F.shiftright(s["zero"], edits).bitwiseAND(F.lit(1))
            return F.struct(up.alias("up"), s["zero"].bitwiseAND(s["more"]).alias("down"), score.cast("int").alias("score"))

        def update(state: Column, j: Column) -> Column:
            # The score never falls along the diagonal, and the last row is at most ``edits`` below it.
            return F.when(state["score"] > 2 * edits, state).otherwise(_let(_let(_let(step(state, j), with_diagonal), across), moved))

        start = F.struct(
            F.lit(mask >> (edits + 1) << (edits + 1)).cast("bigint").alias("up"), F.lit(0).cast("bigint").alias("down"), F.lit(0).alias("score")
        )

        def finish(s: Column) -> Column:
            # From the diagonal cell of the last column down to the last row, or up to it.
            apart = F.abs(c["m"] - c["n"]).cast("int")
            lowest = F.when(c["m"] >= c["n"], F.lit(edits + 1)).otherwise(F.lit(edits + 1) - apart)
            rows = _shifted(_shifted(F.lit(1).cast("bigint"), apart) - 1, lowest)
            change = F.bit_count(s["up"].bitwiseAND(rows)) - F.bit_count(s["down"].bitwiseAND(rows))
            return s["score"] + F.when(c["m"] >= c["n"], change).otherwise(-change)

        return F.aggregate(F.sequence(F.lit(0), c["n"] - 1), start, update, finish)

    return F.when(F.length(right) == 0, F.length(left)).otherwise(_let(chars, distance))


def _shifted(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def middles(left: Column, right: Column) -> Column:
    """``struct<left, right>`` without the longest common start and the longest common end of what follows it.

    Both are found by halving steps; beyond twice the first step nothing more is cut, which does no harm.
    """
    steps = F.array(*[F.lit(1 << k) for k in range(16, -1, -1)])

    def shared(a: Column, b: Column, most: Column) -> Column:
        def longer(n: Column, step: Column) -> Column:
            more = n + step
            return F.when((more <= most) & (F.substring(a, F.lit(1), more) == F.substring(b, F.lit(1), more)), more).otherwise(n)

        return F.aggregate(steps, F.lit(0), longer)

    def cut_start(c: Column) -> Column:
        n = shared(c["left"], c["right"], F.least(F.length(c["left"]), F.length(c["right"])))
        return _let(n, lambda n: F.struct(*[F.substring(c[x], n + 1, F.length(c[x])).alias(x) for x in ("left", "right")]))

    def cut_end(c: Column) -> Column:
        n = shared(F.reverse(c["left"]), F.reverse(c["right"]), F.least(F.length(c["left"]), F.length(c["right"])))
        return _let(n, lambda n: F.struct(*[F.substring(c[x], F.lit(1), F.length(c[x]) - n).alias(x) for x in ("left", "right")]))

    return _let(_let(F.struct(left.alias("left"), right.alias("right")), cut_start), cut_end)


def plausible(left: Column, right: Column, edits: int) -> Column:
    """Whether enough pieces of ``left`` stand somewhere in ``right``: each edit can touch one of them only."""
    pieces = 2 * edits + 2
    length = F.length(left)
    size = F.least(F.lit(8), F.floor(length / pieces).cast("int"))
    found = [F.contains(right, F.substring(left, F.floor(length * k / pieces).cast("int") + 1, size)).cast("int") for k in range(pieces)]
    return reduce(Column.__add__, found) >= pieces - edits


def _exploded(docs: DataFrame, min_chars: int) -> DataFrame:
    lines = docs.select(F.explode(F.split(F.col("text"), "\n")).alias("text")).where(F.length("text") >= min_chars)
    return lines.select(F.xxhash64("text").alias("id"), "text")


def line_classes(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``node, component`` of the lines that are within ``edits`` edits of another line; lines are named by their hashes."""
    texts = docs.select("text")

    def source(ids: DataFrame | None) -> DataFrame:
        lines = _exploded(texts, min_chars)
        return lines if ids is None else lines.join(ids, "id", "left_semi")

    pairs = candidate_pairs(source, edits)
    ids = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "pair-lines")
    held = cut_lineage(source(_sized(ids)).dropDuplicates(["id"]), "pair-texts")
    both = pairs.join(held.select(F.col("id").alias("a"), F.col("text").alias("left")), "a").join(held.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
    likely = both.where(F.abs(F.length("left") - F.length("right")) <= edits).where(plausible(F.col("left"), F.col("right"), edits))
    near = likely.where(banded_distance(F.col("left"), F.col("right"), edits) <= edits)
    return connected_components(cut_lineage(near.select("a", "b"), "line-links"))


def repeated_lines(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, max_documents: int = MAX_DOCUMENTS, row_id: str | None = None
) -> DataFrame:
    """``row_id, doc_id, n_lines, n_repeated, removed, removed_short``: numbers of the lines (from 0) to be removed, per row.

    ``n_repeated`` counts the lines of ``min_chars`` or more whose class has another line, ``removed`` lists those that go and
    ``removed_short`` the shorter ones; ``row_id`` names a column that tells the rows apart, without which they are numbered.
    """
    own_id = F.col(row_id) if row_id else F.monotonically_increasing_id()
    parts = F.split(F.col("text"), "\n")
    kind = lambda x: F.when(F.length(x) >= min_chars, "long").when(~_blank(x), "short")
    marked = F.transform(parts, lambda x, i: F.struct(i.alias("line"), F.xxhash64(x).alias("id"), kind(x).alias("kind")))
    rows = docs.select(own_id.alias("row_id"), "doc_id", F.coalesce(F.size(parts), F.lit(0)).alias("n"), marked.alias("marked"))
    rows = rows.select("row_id", "doc_id", "n", F.filter("marked", lambda s: s["kind"] == "long").alias("lines"), F.filter("marked", lambda s: s["kind"] == "short").alias("short"))
    rows = cut_lineage(rows, "lines")
    classes = cut_lineage(line_classes(docs, edits, min_chars), "classes")
    places = rows.select("row_id", "doc_id", F.explode("lines").alias("s")).select("row_id", "doc_id", "s.line", "s.id")
    places = places.join(classes, places["id"] == classes["node"], "left").select("row_id", "doc_id", "line", F.coalesce("component", "id").alias("class"))
    places = cut_lineage(places, "places")
    in_rows = places.groupBy("class", "row_id", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("line"))
    sizes = in_rows.groupBy("class").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("n"), F.min(F.struct("doc_id", "row_id", "line")).alias("first"))
    sizes = cut_lineage(sizes.where("n > 1"), "class-sizes")
    judged = places.join(sizes, "class")
    gone = (F.col("documents") > max_documents) & ~((F.col("row_id") == F.col("first.row_id")) & (F.col("line") == F.col("first.line")))
    per_row = judged.groupBy("row_id").agg(F.count(F.lit(1)).alias("n_repeated"), F.sort_array(F.collect_list(F.when(gone, F.col("line")))).alias("removed"))
    out = rows.drop("lines", "short").join(cut_lineage(per_row, "removed-lines"), "row_id", "left")
    out = out.join(cut_lineage(short_repeats(rows, max_documents), "removed-short"), "row_id", "left")
    return out.select(
        "row_id",
        "doc_id",
        F.greatest(F.col("n"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce("n_repeated", F.lit(0)).cast("bigint").alias("n_repeated"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        F.coalesce("removed_short", F.array().cast("array<int>")).alias("removed_short"),
    )


def _blank(text: Column) -> Column:
    return F.trim(F.translate(text, "\n\r\t", "   ")) == ""


def short_repeats(rows: DataFrame, max_documents: int) -> DataFrame:
    """``row_id, removed_short`` from ``row_id, doc_id, short``: of equal lines in more than ``max_documents`` documents all but the first."""
    in_rows = rows.select(F.explode(F.array_distinct(F.transform("short", lambda s: s["id"]))).alias("id"))
    wide = cut_lineage(in_rows.groupBy("id").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") > max_documents).select("id"), "short-lines")
    places = rows.select("row_id", "doc_id", F.explode("short").alias("s")).select("row_id", "doc_id", "s.line", "s.id").join(_sized(wide), "id")
    firsts = cut_lineage(places.groupBy("id").agg(F.min(F.struct("doc_id", "row_id", "line")).alias("first")), "short-firsts")
    gone = places.join(_sized(firsts), "id").where(~((F.col("row_id") == F.col("first.row_id")) & (F.col("line") == F.col("first.line"))))
    return gone.groupBy("row_id").agg(F.sort_array(F.collect_list("line")).alias("removed_short"))


def remove_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """The documents without the lines that are repeated too widely; ``n_chars`` follows the text where the input has it."""
    columns = docs.columns
    packed = cut_lineage(docs.select(F.struct(*columns).alias("doc"), F.monotonically_increasing_id().alias("row_id")), "numbered")
    found = repeated_lines(packed.select("row_id", "doc.doc_id", "doc.text"), edits, min_chars, max_documents, "row_id")
    found = found.select("row_id", F.concat("removed", "removed_short").alias("removed"))
    cuts = cut_lineage(found.where(F.size("removed") > 0), "cuts")
    joined = packed.join(cuts, "row_id", "left")
    stay = F.filter(F.transform(F.split(F.col("doc.text"), "\n"), lambda x, i: F.when(~F.array_contains("removed", i), x)), lambda x: x.isNotNull())
    joined = joined.withColumn("clean", F.when(F.col("removed").isNull(), F.col("doc.text")).otherwise(F.array_join(stay, "\n")))
    joined = joined.where(F.col("removed").isNull() | ~_blank(F.col("clean")))
    out = {c: F.col(f"doc.{c}") for c in columns} | {"text": F.col("clean")}
    if "n_chars" in columns:
        out["n_chars"] = F.when(F.col("removed").isNull(), F.col("doc.n_chars")).otherwise(F.length("clean").cast(docs.schema["n_chars"].dataType))
    return joined.select(*[c.alias(n) for n, c in out.items()])
