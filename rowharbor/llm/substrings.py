"""Removal of byte strings of a given width that start at more than one place of the corpus.

Every window of ``width`` bytes holds one anchor: the gram of ``GRAM`` bytes with the smallest hash in it, the leftmost of equals.
Equal windows have equal anchors at equal offsets, so windows can be compared anchor by anchor:

* Neighbouring windows with one anchor form a run. Runs whose anchor no other run has hold no repeated window.
* Runs with the same anchor and the same bytes cover all their bytes; no text is moved for them.
* Of the other runs with a shared anchor, one of each content is a member of the anchor's group. The bytes on both sides of the
  anchor, with the anchor as one symbol, are joined to a text whose suffixes are sorted by Lyndon grouping; windows
  that share ``width`` bytes stand side by side in that order.
* A group of more than ``GROUP`` members is divided by what its windows must share, the bytes next to the anchor on the left or on
  the right, and where a part is still larger, by whole windows, so that no group is gathered in one task.

Hashes of two bases decide the equality of contents; bytes decide the equality of windows within a group.

Defined cases: a NULL text is the empty text; texts shorter than ``width`` are left as they are; windows do not cross texts;
repeated rows, and rows that share id and text, are texts of their own that repeat each other; NULL ids are kept; what is left of a text
need not be whole characters; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowharbor.llm.arrow_tasks import map_rows, rows_of
from rowharbor.llm.lyndon import suffix_array
from rowharbor.session import cut_lineage

WIDTH = 200
GRAM = 100
GROUP = 1024
#: Window starts that are handled at once in a long text.
STRETCH = 1 << 20

BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, np.uint64(b))
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Rolling:
    """Hashes of any stretch of ``data``, equal for equal bytes wherever they stand."""

    def __init__(self, data: np.ndarray, base: int):
        up, self.down = _powers(base, 1 << max(12, int(len(data) + 1).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xE9846AF9B1A615D1)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all stretches of ``width`` values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, values.max(), values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, 1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def runs_of(data: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, content hash and place of each run of windows. A place is anchor << 16 | bytes before it << 8 | further windows."""
    keys, contents, places = [], [], []
    for start in range(0, max(0, len(data) - width + 1), STRETCH):
        part = data[start : start + STRETCH + width - 1].astype(np.uint64)
        first, second = (Rolling(part, b) for b in BASES)
        n = len(part) - gram + 1
        grams = first.of(slice(0, n), slice(gram, gram + n))
        ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        anchor = (sliding_minimum(ranked, width - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        stop = np.concatenate([begin[1:], [len(anchor)]])
        at = anchor[begin]
        keys.append(grams[at])
        contents.append(second.of(begin, stop - 1 + width) + (stop - begin).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + (at - begin).astype(np.uint64))
        places.append((at + start) << 16 | (at - begin) << 8 | (stop - 1 - begin))
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(keys).view(np.int64), np.concatenate(contents).view(np.int64), np.concatenate(places)


def _begin(place: Column) -> Column:
    return F.shiftright(place, 16) - F.shiftright(place, 8).bitwiseAND(F.lit(255))


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def text_runs(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """``doc_id, text_key, n_bytes, sha, keys, contents, places`` of every text."""

    def task(rows):
        for doc_id, key, n, sha, text in rows:
            yield doc_id, key, n, sha, *runs_of(np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8), width, gram)

    longs = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_bytes", pa.int64()), ("sha", pa.string()), ("keys", longs), ("contents", longs), ("places", longs)])
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", text_key().alias("text_key"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha"), text.alias("text"))
    ddl = "doc_id long, text_key long, n_bytes long, sha string, keys array<long>, contents array<long>, places array<long>"
    return map_rows(found, ["doc_id", "text_key", "n_bytes", "sha", "text"], ddl, schema, task)


def repeated_windows(members: list[tuple[bytes, bytes, bytes]], reach: int) -> list[list[int]]:
    """Per member, how many bytes lie before the anchor in each of its windows that another member has too.

    A member is its bytes before the anchor, the anchor and the bytes after it; a window takes ``reach`` bytes besides the anchor.
    Bytes farther from the anchor than any other member agrees to are in no such window and are left out.
    """
    left_shared = longest_shared([left[::-1] for left, _, _ in members])
    right_shared = longest_shared([right for _, _, right in members])
    out: list[list[int]] = [[] for _ in members]
    able = [i for i, (x, y) in enumerate(zip(left_shared, right_shared, strict=True)) if x + y >= reach]
    if len(able) > 1:
        near = [(members[i][0][len(members[i][0]) - left_shared[i] :], b"", members[i][2][: right_shared[i]]) for i in able]
        for i, found in zip(able, _windows_in_order(near, reach), strict=True):
            out[i] = found
    return out


def longest_shared(values: list[bytes]) -> list[int]:
    """For each value, the longest start that it has in common with another one."""
    order = sorted(range(len(values)), key=values.__getitem__)
    out = [0] * len(values)
    for i, j in zip(order, order[1:]):
        a, b = values[i], values[j]
        n = min(len(a), len(b))
        differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
        same = n - (differ.bit_length() + 7) // 8
        out[i], out[j] = max(out[i], same), max(out[j], same)
    return out


def _windows_in_order(members: list[tuple[bytes, bytes, bytes]], reach: int) -> list[list[int]]:
    """The windows of :func:`repeated_windows` from the order of all suffixes of the members."""
    core = 256 + len(members)
    text: list[int] = []
    owner: list[int] = []
    before: list[int] = []
    for number, (left, _, right) in enumerate(members):
        shift = len(members)
        text += [b + shift for b in left] + [core] + [b + shift for b in right] + [len(members) - 1 - number]
        size = len(left) + len(right) + 2
        owner += [number] * size
        before += range(len(left), len(left) - size, -1)
    lengths = [(len(left), len(right)) for left, _, right in members]
    order = [i for i in suffix_array(text) if 0 <= before[i] <= reach and reach - before[i] <= lengths[owner[i]][1]]
    out: list[list[int]] = [[] for _ in members]
    if len(order) < 2:
        return out
    symbols = np.array(text, np.int32)
    at = np.array(order)
    same = np.ones(len(at) - 1, bool)
    for k in range(reach + 1):
        same[same] = symbols[at[1:][same] + k] == symbols[at[:-1][same] + k]
    repeated = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    for i in at[repeated].tolist():
        out[owner[i]].append(before[i])
    return out


def _members(groups: DataFrame, texts: DataFrame, docs: DataFrame, width: int, gram: int) -> DataFrame:
    """``key, row_id, place, repeats, left, core, right`` of the distinct contents of anchors with more than one."""
    sizes = groups.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = groups.join(cut_lineage(sizes, "group-sizes"), "key")
    wanted = members.groupBy("row_id").agg(F.collect_list(F.struct("key", "place", "copies", "members")).alias("wanted"))
    named = cut_lineage(wanted.join(texts.select("row_id", "doc_id", "text_key"), "row_id"), "wanted")
    source = docs.select(F.col("doc_id").alias("d"), text_key().alias("k"), "text")
    both = named.join(source, named["doc_id"].eqNullSafe(F.col("d")) & (named["text_key"] == F.col("k"))).select("row_id", "wanted", "text")

    def task(rows):
        for row_id, wanted, text in rows:
            data = text.encode("utf-8", "surrogatepass")
            for w in wanted:
                at, left, more = w["place"] >> 16, w["place"] >> 8 & 255, w["place"] & 255
                begin = at - left
                yield w["key"], w["members"], row_id, w["place"], w["copies"], data[begin:at], data[at : at + gram], data[at + gram : begin + more + width]

    schema = pa.schema([("key", pa.int64()), ("members", pa.int64()), ("row_id", pa.int64()), ("place", pa.int64()), ("copies", pa.int64()), ("left", pa.binary()), ("core", pa.binary()), ("right", pa.binary())])
    ddl = "key long, members long, row_id long, place long, copies long, left binary, core binary, right binary"
    found = map_rows(both, ["row_id", "wanted", "text"], ddl, schema, task)
    # Repeated rows hold the same bytes; one of them serves.
    return cut_lineage(found.dropDuplicates(["key", "row_id", "place"]), "members")


def _grouped(members: DataFrame, by: list[str], reach: int, width: int, lowest: int, highest: int) -> DataFrame:
    """``row_id, start, end`` of what windows with ``lowest`` to ``highest`` bytes before the anchor cover, group by group."""
    columns = [*by, "row_id", "place", "copies", "left", "core", "right"]

    def run(batches):
        rows = rows_of(batches, columns)
        out: list[tuple[int, int, int]] = []
        for _, group in groupby(rows, lambda r: r[: len(by)]):
            found = [r[len(by) :] for r in group]
            for (row_id, place, copies, *_), windows in zip(found, repeated_windows([r[3:] for r in found], reach), strict=True):
                if copies == 1:
                    out += [(row_id, (place >> 16) - x, (place >> 16) - x + width) for x in windows if lowest <= x <= highest]
            if len(out) > 4096:
                yield _spans(out)
                out = []
        if out:
            yield _spans(out)

    return members.select(*columns).repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "row_id long, start long, end long")


def _spans(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["row_id", "start", "end"])


def group_spans(members: DataFrame, width: int, gram: int) -> DataFrame:
    """Spans covered by windows that members of one anchor share."""
    reach = width - gram
    half = reach // 2
    plain = _grouped(members.where(F.col("members") <= GROUP), ["key"], reach, width, 0, reach)
    large = members.where(F.col("members") > GROUP)
    # A window has at least half its reach on one side; the two sides are divided apart.
    sides = large.select(
        "*",
        F.explode(
            F.array(
                F.when(F.length("left") >= half, F.struct(F.lit(True).alias("on_left"), F.xxhash64(F.substring("left", -half, half)).alias("near"))),
                F.when(F.length("right") >= reach - half, F.struct(F.lit(False).alias("on_left"), F.xxhash64(F.substring("right", 1, reach - half)).alias("near"))),
            )
        ).alias("s"),
    ).where("s is not null")
    sides = cut_lineage(sides.select("*", "s.on_left", "s.near").drop("s", "members"), "sides")
    by = ["key", "on_left", "near"]
    counts = cut_lineage(sides.groupBy(*by).agg(F.count(F.lit(1)).alias("part")).where("part > 1"), "side-sizes")
    sized = sides.join(counts, by)
    small = sized.where(F.col("part") <= GROUP)
    left = _grouped(small.where("on_left"), by, reach, width, half, reach)
    right = _grouped(small.where("not on_left"), by, reach, width, 0, reach - half)
    return plain.unionByName(left).unionByName(right).unionByName(_window_spans(sized.where(F.col("part") > GROUP), width, gram))


def _window_spans(members: DataFrame, width: int, gram: int) -> DataFrame:
    """Spans of the windows of very large parts, each window a group of its own."""
    reach = width - gram
    half = reach // 2
    low = F.greatest(F.when(F.col("on_left"), half).otherwise(0), reach - F.length("right"))
    high = F.least(F.when(F.col("on_left"), reach).otherwise(reach - half), F.length("left"))
    windows = members.where(low <= high).select("key", "row_id", "place", "copies", "left", "right", F.explode(F.sequence(low, high)).alias("x"))
    # The bytes of the window beside the anchor; the anchor itself is the key.
    content = F.sha2(F.concat(F.expr("substring(left, length(left) - x + 1, x)"), F.lit(b"\x00"), F.expr(f"substring(right, 1, {reach} - x)")), 256)
    windows = windows.select("key", "x", content.alias("content"), "row_id", "place", "copies")
    counts = windows.groupBy("key", "x", "content").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = windows.where("copies = 1").join(cut_lineage(counts, "window-sizes"), ["key", "x", "content"])
    start = F.shiftright("place", 16) - F.col("x")
    return shared.select("row_id", start.alias("start"), (start + width).alias("end"))


def covered(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """``doc_id, text_key, starts, ends``: the spans of each text, joined where they overlap or touch."""
    # Spans follow from the bytes of a text alone, so rows with equal id and text share them.
    named = spans.distinct().join(texts.select("row_id", "doc_id", "text_key"), "row_id")
    raw = named.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "end")).alias("raw"))
    raw = raw.select("doc_id", "text_key", F.col("raw.start").alias("s"), F.col("raw.end").alias("e"))

    def task(rows):
        for doc_id, key, start, end in rows:
            start, end = np.array(start), np.array(end)
            order = np.argsort(start, kind="stable")
            start, reach = start[order], np.maximum.accumulate(end[order])
            new = np.concatenate([[True], start[1:] > reach[:-1]])
            yield doc_id, key, start[new], np.concatenate([reach[:-1][new[1:]], reach[-1:]])

    longs = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("starts", longs), ("ends", longs)])
    return map_rows(raw, ["doc_id", "text_key", "s", "e"], "doc_id long, text_key long, starts array<long>, ends array<long>", schema, task)


def remove_repeated(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, starts, ends, kept_sha256`` per row: the spans removed, and the digest of what is left."""
    texts = cut_lineage(text_runs(docs, width, gram).withColumn("row_id", F.monotonically_increasing_id()), "text-runs")
    runs = texts.select("row_id", F.explode(F.arrays_zip("keys", "contents", "places")).alias("r"))
    runs = runs.select("row_id", F.col("r.keys").alias("key"), F.col("r.contents").alias("content"), F.col("r.places").alias("place"))
    anchors = texts.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    keyed = cut_lineage(runs.join(cut_lineage(anchors, "anchors"), "key"), "shared-runs")
    groups = keyed.groupBy("key", "content").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("row_id", "place")).alias("f"))
    groups = cut_lineage(groups.select("key", "content", "copies", "f.row_id", "f.place"), "contents")
    copied = keyed.join(groups.where("copies > 1").select("key", "content"), ["key", "content"])
    begin = _begin(F.col("place"))
    whole = copied.select("row_id", begin.alias("start"), (begin + F.col("place").bitwiseAND(F.lit(255)) + width).alias("end"))
    partly = group_spans(_members(groups, texts, docs, width, gram), width, gram)
    spans = cut_lineage(whole.unionByName(partly), "spans")
    covers = covered(spans, texts).select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "starts", "ends")
    covers = cut_lineage(covers, "covers")
    counted = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda n, x: n + x)
    rows = texts.select("doc_id", "text_key", "n_bytes", "sha")
    found = rows.join(covers, rows["doc_id"].eqNullSafe(F.col("d")) & (rows["text_key"] == F.col("k")), "left")
    found = found.withColumn("n_removed", F.coalesce(F.when(F.col("starts").isNotNull(), counted), F.lit(0).cast("bigint")))
    partial = (F.col("n_removed") > 0) & (F.col("n_removed") < F.col("n_bytes"))
    out = ["doc_id", "n_bytes", "n_removed", "starts", "ends"]
    plain = found.where(~partial).select(*out, F.when(F.col("n_removed") == 0, F.col("sha")).otherwise(F.sha2(F.lit(""), 256)).alias("kept_sha256"))
    cuts = cut_lineage(found.where(partial).dropDuplicates(["doc_id", "text_key"]).select("d", "k", "n_bytes", "n_removed", "starts", "ends"), "cuts")
    source = docs.select("doc_id", text_key().alias("text_key"), "text")
    both = source.join(cuts, source["doc_id"].eqNullSafe(cuts["d"]) & (source["text_key"] == cuts["k"]))

    def cut(found):
        for doc_id, n, removed, starts, ends, text in found:
            data = text.encode("utf-8", "surrogatepass")
            digest = hashlib.sha256()
            for a, b in zip([0, *ends], [*starts, n], strict=True):
                digest.update(data[a:b])
            yield doc_id, n, removed, starts, ends, digest.hexdigest()

    longs = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("starts", longs), ("ends", longs), ("kept_sha256", pa.string())])
    ddl = "doc_id long, n_bytes long, n_removed long, starts array<long>, ends array<long>, kept_sha256 string"
    return plain.unionByName(map_rows(both, [*out, "text"], ddl, schema, cut))
