"""Near-duplicate documents by bottom-k sketches from one hash function.

A document is the set of 64-bit hashes of its shingles (five words; A-Z in lower case); its sketch is the ``k`` smallest of
them. Documents with equal sets are one from then on. Inverted lists of the retained values give the candidates:

* Two sets at the threshold share at least ``needed(n)`` retained values, but for a chance below one in a million, so two
  sketches ordered by how rare their values are must meet among all but the ``needed(n) - 1`` commonest. Only those are listed.
* Lists of up to ``SHORT_LIST`` documents give all their pairs, and a longer list those with its smallest document. The estimate from
  the union of the two sketches drops pairs that are far off, and the full sets of the texts decide the rest.
* Once these links are joined to components, the documents of a long list that lie outside its largest component are compared with all
  the others by their full sets, in blocks of bounded size that emit what their links reach, not pairs. Two documents
  of one component need no comparison; no link between components is lost.

No list is cut or capped, and no list is gathered in one task.

Defined cases: a text of one to four words is one shingle; texts without words have no shingles and link with nothing; repeated rows and
rows that share an id are one document; a row without an id has no component and is kept; an empty table gives no rows.
``near_duplicates`` reads ids and texts only; ``keep_representatives`` returns all columns of its input.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from rowharbor.llm.arrow_tasks import map_rows
from rowharbor.llm.components import connected_components, reached
from rowharbor.session import cut_lineage

WORDS = 5
K = 48
SIMILARITY = 75  # per cent
SHORT_LIST = 8
BLOCK = 512
#: Standard deviations below the mean overlap at the threshold that the estimate allows for.
SLACK = 5.2

MASK = (1 << 64) - 1
MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1 << 18)
def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, width: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the shingles, as signed integers."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.int64)
    hashes = np.fromiter(map(_word_hash, words), np.uint64, len(words))
    span = min(width, len(words))
    n = len(words) - span + 1
    h = np.full(n, span, np.uint64)
    for i in range(span):
        h = _scrambled(h * MIX + hashes[i : i + n])
    return np.unique(h.view(np.int64))


def needed(n: int | np.ndarray, k: int = K, similarity: int = SIMILARITY):
    """Retained values that a set of ``n`` shares with any set that is similar enough."""
    t = similarity / 100
    sampled = max(1, math.floor(t * k - SLACK * math.sqrt(t * (1 - t) * k)))
    return np.minimum(sampled, -(-similarity * np.asarray(n) // 100))


def sketches(docs: DataFrame, k: int = K, width: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, set_key, sketch`` of every whole text; equal sets have equal keys."""

    def task(rows):
        for doc_id, text in rows:
            values = shingle_set(text, width)
            yield doc_id, len(values), xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None, values[:k]

    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("sketch", pa.list_(pa.int64()))])
    return map_rows(docs, ["doc_id", "text"], "doc_id long, n_shingles long, set_key binary, sketch array<long>", schema, task)


def listed_values(sets: DataFrame, k: int = K, similarity: int = SIMILARITY) -> DataFrame:
    """``value, id, n`` of the inverted lists: per set, the rarer retained values, if any other set retains them."""
    t = similarity / 100
    sampled = max(1, math.floor(t * k - SLACK * math.sqrt(t * (1 - t) * k)))
    least = F.least(F.lit(sampled), F.ceil(F.col("n") * similarity / 100).cast("int"))
    values = sets.select("id", "n", F.explode("sketch").alias("value"))
    shared = cut_lineage(values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared")
    found = values.join(shared, "value").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"))
    # Values that no other set retains are the rarest of all; they take their places in the order but need no list.
    alone = F.least(F.lit(k), F.col("n")).cast("int") - F.size("values")
    places = F.greatest(F.least(F.lit(k), F.col("n")).cast("int") - least + 1 - alone, F.lit(0))
    return found.select("id", "n", F.explode(F.slice("values", F.lit(1), places)).alias("v")).select(F.col("v.value").alias("value"), "id", "n")


def _comparable(a: str, b: str, similarity: int) -> Column:
    return 100 * F.least(F.col(a), F.col(b)) >= similarity * F.greatest(F.col(a), F.col(b))


def first_pairs(lists: DataFrame, sizes: DataFrame, similarity: int) -> DataFrame:
    """``a, b`` (a < b): all pairs of short lists, and the smallest document of each long list with the others."""
    sized = lists.join(sizes, "value")
    short = sized.where(F.col("members") <= SHORT_LIST).groupBy("value").agg(F.collect_list(F.struct("id", "n")).alias("m"))
    pairs = short.select(F.explode("m").alias("x"), "m").select("x", F.explode("m").alias("y")).where("x.id < y.id")
    pairs = pairs.select(F.col("x.id").alias("a"), F.col("x.n").alias("na"), F.col("y.id").alias("b"), F.col("y.n").alias("nb"))
    star = sized.where((F.col("members") > SHORT_LIST) & (F.col("id") != F.col("center.id")))
    star = star.select(F.col("center.id").alias("a"), F.col("center.n").alias("na"), F.col("id").alias("b"), F.col("n").alias("nb"))
    return pairs.unionByName(star).where(_comparable("na", "nb", similarity)).select("a", "b").distinct()


def residual_links(lists: DataFrame, sizes: DataFrame, texts: DataFrame, components: DataFrame, width: int, similarity: int) -> DataFrame:
    """``a, b`` (b < a): what links of the long lists across components reach, by the full sets.

    Long lists with one smallest document are compared as one, so that documents that share many lists meet once.
    """
    long = lists.join(sizes.where(F.col("members") > SHORT_LIST).select("value", F.col("center.id").alias("center")), "value")
    long = cut_lineage(long.select("center", "id").distinct(), "long-lists")
    long = long.join(components, long["id"] == components["node"], "left").select("center", "id", F.coalesce("component", "id").alias("component"))
    long = cut_lineage(long, "long-lists")
    parts = long.groupBy("center", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = parts.groupBy("center").agg(F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("total"))
    largest = largest.where(F.col("top.size") < F.col("total")).select(
        "center",
        F.col("top.component").alias("main"),
        F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("total") - F.col("top.size")) / BLOCK).cast("int").alias("minor_blocks"),
    )
    open_lists = long.join(cut_lineage(largest, "open-lists"), "center").withColumn("h", F.xxhash64("id", "center"))
    open_lists = cut_lineage(open_lists, "open-members")
    columns = ["center", "minor_block", "block", "minor", "id", "component"]
    every = open_lists.select(
        "*", F.pmod("h", "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("minor_blocks") - 1)).alias("minor_block"), F.lit(False).alias("minor")
    ).select(columns)
    minors = open_lists.where(F.col("component") != F.col("main")).select(
        "*", F.pmod("h", "minor_blocks").cast("int").alias("minor_block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("minor")
    ).select(columns)
    held = texts.join(open_lists.select("id").distinct(), "id", "left_semi")

    def full_sets(rows):
        for doc_id, text in rows:
            yield doc_id, shingle_set(text, width).tobytes()

    sets = cut_lineage(map_rows(held, ["id", "text"], "id long, members binary", pa.schema([("id", pa.int64()), ("members", pa.binary())]), full_sets), "full-sets")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = [np.frombuffer(m, np.int64) for m in pdf["members"]]
        minor, ids, component = pdf["minor"].to_numpy(), pdf["id"].to_numpy(), pdf["component"].to_numpy()
        n = np.array([len(m) for m in whole])
        both = shared_counts(whole)
        good = 100 * both >= similarity * (n[:, None] + n[None] - both)
        good &= (component[:, None] != component[None]) & (minor[:, None] != minor[None])
        label = reached(good, ids)
        found = good.any(1) & (label < ids)
        return pd.DataFrame({"a": ids[found], "b": label[found]})

    placed = every.unionByName(minors).join(sets, "id")
    return placed.groupBy("center", "minor_block", "block").applyInPandas(compare, "a long, b long").distinct()


def shared_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections of the sets of a block, a stretch of values at a time."""
    values = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, count = np.unique(values, return_inverse=True, return_counts=True)
    used = count[at] > 1
    renamed = np.cumsum(count > 1) - 1
    rows, at = rows[used], renamed[at[used]]
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    out = np.zeros((len(sets), len(sets)))
    width = int(at[-1]) + 1 if len(at) else 0
    for start in range(0, width, columns):
        low, high = np.searchsorted(at, [start, start + columns])
        held = np.zeros((len(sets), columns), np.float32)
        held[rows[low:high], at[low:high] - start] = 1
        out += held @ held.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def estimated(pairs: DataFrame, sets: DataFrame, k: int, similarity: int) -> DataFrame:
    """The pairs that the sketch of their union does not rule out."""
    left = sets.select(F.col("id").alias("a"), F.col("sketch").alias("sketch_a"), F.col("n").alias("n_a"))
    right = sets.select(F.col("id").alias("b"), F.col("sketch").alias("sketch_b"), F.col("n").alias("n_b"))
    both = pairs.join(left, "a").join(right, "b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
    t = similarity / 100
    size = F.size(union)
    enough = F.greatest(F.lit(1.0), t * size - SLACK * F.sqrt(t * (1 - t) * size))
    # A sketch of fewer than k values is its whole set, and so is that of the union then.
    return both.where(F.when(size < k, 100 * shared >= similarity * size).otherwise(shared >= F.floor(enough))).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, similarity: int) -> DataFrame:
    """The pairs whose full sets are similar enough; a text is moved once for each pair it stands in."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def task(rows):
        last, held = None, np.empty(0, np.int64)
        for a, b, text_a, text_b in rows:
            if a != last:
                last, held = a, shingle_set(text_a, width)
            other = shingle_set(text_b, width)
            inter = len(np.intersect1d(held, other, assume_unique=True))
            if 100 * inter >= similarity * (len(held) + len(other) - inter):
                yield a, b

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return map_rows(both, ["a", "b", "text_a", "text_b"], "a long, b long", schema, task)


def near_duplicates(docs: DataFrame, k: int = K, width: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row: the smallest id that links reach, and whether it is the row's own."""
    rows = cut_lineage(sketches(docs, k, width), "sketches")
    known = rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    groups = cut_lineage(known.groupBy("set_key").agg(F.min("doc_id").alias("id")), "sets")
    member = known.select("doc_id", "set_key").join(groups, "set_key").select("doc_id", "id").distinct()
    member = cut_lineage(member, "members")
    # One row per distinct set; the sketches of copies stay behind.
    sets = known.join(groups, (known["set_key"] == groups["set_key"]) & (known["doc_id"] == groups["id"])).select(
        "id", F.col("n_shingles").alias("n"), "sketch"
    )
    sets = cut_lineage(sets.dropDuplicates(["id", "n", "sketch"]), "set-sketches")
    lists = cut_lineage(listed_values(sets, k, similarity), "lists")
    sizes = lists.groupBy("value").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("id", "n")).alias("center")).where("members > 1")
    sizes = cut_lineage(sizes, "list-sizes")
    texts = docs.select("doc_id", "text").join(sets.select("id").distinct(), F.col("doc_id") == F.col("id"), "left_semi").select(F.col("doc_id").alias("id"), "text").dropDuplicates(["id"])
    links = _verified(first_pairs(lists, sizes, similarity), sets, texts, k, width, similarity)
    copies = member.where("doc_id != id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    components = cut_lineage(connected_components(links), "components")
    more = cut_lineage(residual_links(lists, sizes, texts, components, width, similarity), "links")
    # What the links have joined hangs together already.
    joined = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = cut_lineage(connected_components(joined.unionByName(more).unionByName(copies)), "components")
    out = rows.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame, k: int, width: int, similarity: int) -> DataFrame:
    likely = cut_lineage(estimated(pairs, sets, k, similarity), "pairs")
    ids = likely.select(F.col("a").alias("id")).unionAll(likely.select(F.col("b").alias("id"))).distinct()
    held = cut_lineage(texts.join(ids, "id", "left_semi"), "pair-texts")
    return cut_lineage(confirmed(likely, held, width, similarity), "links")


def keep_representatives(docs: DataFrame, k: int = K, width: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """The documents without those that link to one of a smaller id; rows that share an id are all kept or all dropped."""
    dropped = near_duplicates(docs, k, width, similarity).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(cut_lineage(dropped, "dropped"), "doc_id", "left_anti").select(*docs.columns)
