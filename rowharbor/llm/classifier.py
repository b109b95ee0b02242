"""A byte-level convolutional network in numpy that scores the quality of whole texts.

Bytes have learned vectors; learned filters of six bytes run over every position. The strongest answer of each filter is
taken per chunk of 512 bytes, chunks overlap by a quarter, and the means and maxima over all chunks of a document are combined into
one probability. For scoring, the filters become three tables over byte pairs, so that a position costs
three lookups whatever the width of the byte vectors is.

The network is fitted on the driver to at most ``per_class`` labelled documents of each class and ``TRAIN_CHUNKS`` chunks of each,
spread evenly over the document: the only sample taken. Every document is scored whole.

Defined cases: a NULL or empty text scores like a text without any pattern (all filters at zero); texts shorter
than a filter are padded with zero bytes; NULL ids are kept; repeated rows get equal scores; a document labelled twice counts once,
with its lowest label; labels other than 0 and 1 are passed over; without labels of both classes every score is 0.5. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowharbor.llm.arrow_tasks import SLICE_ROWS, map_rows

WIDTH, VECTOR, FILTERS = 6, 8, 16
BLOCK = 128
#: Blocks of a chunk, and blocks from one chunk to the next.
CHUNK_BLOCKS, STEP_BLOCKS = 4, 3
CHUNK = BLOCK * CHUNK_BLOCKS
TRAIN_CHUNKS = 8
#: Labelled documents of each class that are learned from, at most.
PER_CLASS = 1000
#: Share of the training steps of a document that see a short piece of it only.
SHORT_SHARE = 0.35
#: Positions whose filter answers are held at once.
SPAN = BLOCK * 64


@dataclass(frozen=True)
class Network:
    pairs: np.ndarray  # (WIDTH // 2, 65536, FILTERS): answers to two neighbouring bytes
    bias: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (2 * FILTERS,): of chunk means, then of chunk maxima
    offset: float

    def score(self, text: str | None) -> float:
        data = (text or "").encode("utf-8", "surrogatepass")
        if not data:
            return float(_sigmoid(np.float64(self.offset)))
        pooled = np.maximum(chunk_maxima(self._block_maxima(data)) + self.bias, 0)
        features = np.concatenate([pooled.mean(0), pooled.max(0)])
        return float(_sigmoid(np.float64(features @ self.weights + self.offset)))

    def _block_maxima(self, data: bytes) -> np.ndarray:
        raw = np.frombuffer(data + bytes(max(0, WIDTH - len(data)) + 1), np.uint8)
        pair = raw[:-1].astype(np.uint16) << 8 | raw[1:]
        n = max(1, len(data) - WIDTH + 1)
        out = []
        for start in range(0, n, SPAN):
            size = min(SPAN, n - start)
            answers = self.pairs[0].take(pair[start : start + size], 0)
            for k in range(1, WIDTH // 2):
                answers += self.pairs[k].take(pair[start + 2 * k : start + 2 * k + size], 0)
            full = size // BLOCK * BLOCK
            out.append(answers[:full].reshape(-1, BLOCK, FILTERS).max(1))
            if size > full:
                out.append(answers[full:].max(0, keepdims=True))
        return np.concatenate(out)


def chunk_maxima(blocks: np.ndarray) -> np.ndarray:
    """Maxima of overlapping chunks; the last chunk may be shorter, and every block is in one."""
    chunks = max(1, -(-(len(blocks) - CHUNK_BLOCKS) // STEP_BLOCKS) + 1)
    starts = np.arange(chunks) * STEP_BLOCKS
    return np.stack([blocks[np.minimum(starts + k, len(blocks) - 1)] for k in range(CHUNK_BLOCKS)]).max(0)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def constant_network() -> Network:
    return Network(np.zeros((WIDTH // 2, 1 << 16, FILTERS), np.float32), np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS), 0.0)


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> list[tuple[int, list[bytes]]]:
    """Label and chunks of at most ``per_class`` documents of each class outside the held-out third."""
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    order = F.xxhash64("doc_id")
    chosen = known.where("quality = 0").orderBy(order, "doc_id").limit(per_class)
    chosen = chosen.unionAll(known.where("quality = 1").orderBy(order, "doc_id").limit(per_class))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # At most 2 * per_class rows of two numbers each.
    found = texts.join(F.broadcast(chosen), "doc_id")
    last = F.greatest(F.length("text") - CHUNK, F.lit(0))
    start = lambda i: (i * last / (TRAIN_CHUNKS - 1)).cast("int") + 1
    parts = F.transform(F.sequence(F.lit(0), F.lit(TRAIN_CHUNKS - 1)), lambda i: F.substring(F.col("text"), start(i), F.lit(CHUNK)))
    rows = found.select("doc_id", "quality", F.array_distinct(parts).alias("parts")).dropDuplicates(["doc_id"]).collect()
    return [(r.quality, [p.encode("utf-8", "surrogatepass")[:CHUNK] for p in r.parts]) for r in sorted(rows, key=lambda r: r.doc_id)]


def fit(sample: list[tuple[int, list[bytes]]], epochs: int = 16, batch: int = 48, rate: float = 0.01, seed: int = 7) -> Network:
    """Fit by Adam on the balanced cross-entropy; the gradient flows through the strongest position of each filter."""
    sample = [(y, [p for p in parts if p]) for y, parts in sample]
    sample = [(y, parts) for y, parts in sample if parts]
    classes = {y for y, _ in sample}
    if classes != {0, 1}:
        return constant_network()
    rng = np.random.default_rng(seed)
    p = {
        "bytes": rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
        "filters": rng.normal(0, 0.3, (WIDTH, VECTOR, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "weights": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        "offset": np.zeros(1, np.float32),
    }
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    positive = sum(y for y, _ in sample) / len(sample)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(sample))
        for first in range(0, len(order), batch):
            part = [(sample[i][0], _cropped(sample[i][1], rng)) for i in order[first : first + batch]]
            step += 1
            for name, g in _gradient(p, part, positive).items():
                m, v = moment[name]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
    first, second = (np.einsum("bv,kvf->kbf", p["bytes"], p["filters"][i::2]) for i in (0, 1))
    pairs = (first[:, :, None, :] + second[:, None, :, :]).reshape(WIDTH // 2, 1 << 16, FILTERS)
    return Network(np.ascontiguousarray(pairs, np.float32), p["bias"], p["weights"].astype(np.float64), float(p["offset"][0]))


def _cropped(parts: list[bytes], rng: np.random.Generator) -> list[bytes]:
    """Now and then a short piece instead of the whole document, so that short texts are known too."""
    if rng.random() > SHORT_SHARE:
        return parts
    part = parts[rng.integers(len(parts))]
    size = int(rng.integers(8, 160))
    start = int(rng.integers(max(1, len(part) - size + 1)))
    return [part[start : start + size]]


def _gradient(p: dict[str, np.ndarray], part: list[tuple[int, list[bytes]]], positive: float) -> dict[str, np.ndarray]:
    owner = np.repeat(np.arange(len(part)), [len(x) for _, x in part])
    chunks = [c for _, x in part for c in x]
    raw = np.zeros((len(chunks), CHUNK), np.uint8)
    for i, c in enumerate(chunks):
        raw[i, : len(c)] = np.frombuffer(c, np.uint8)
    ends = np.array([max(1, len(c) - WIDTH + 1) for c in chunks])
    vectors = p["bytes"].take(raw, 0)
    places = CHUNK - WIDTH + 1
    answers = vectors[:, :places].reshape(-1, VECTOR) @ p["filters"][0]
    for k in range(1, WIDTH):
        answers += vectors[:, k : k + places].reshape(-1, VECTOR) @ p["filters"][k]
    answers = answers.reshape(len(chunks), places, FILTERS)
    for i in np.flatnonzero(ends < places):
        answers[i, ends[i] :] = -np.inf
    best = answers.argmax(1)
    top = np.take_along_axis(answers, best[:, None], 1)[:, 0] + p["bias"]
    pooled = np.maximum(top, 0)
    counts = np.bincount(owner)
    bounds = np.concatenate([[0], np.cumsum(counts)[:-1]])
    mean = np.add.reduceat(pooled, bounds, 0) / counts[:, None]
    high = np.maximum.reduceat(pooled, bounds, 0)
    label = np.array([y for y, _ in part], np.float32)
    score = _sigmoid(np.concatenate([mean, high], 1) @ p["weights"] + p["offset"])
    balance = np.where(label == 1, 0.5 / positive, 0.5 / (1 - positive))
    error = ((score - label) * balance / len(part)).astype(np.float32)
    features = np.concatenate([mean, high], 1)
    to_mean, to_high = error[:, None] * p["weights"][:FILTERS], error[:, None] * p["weights"][FILTERS:]
    is_high = pooled == high[owner]
    share = is_high / np.maximum(np.add.reduceat(is_high.astype(np.float32), bounds, 0), 1)[owner]
    back = (to_mean / counts[:, None])[owner] + to_high[owner] * share
    back = (back * (top > 0)).astype(np.float32)
    filters, byte_rows = np.empty_like(p["filters"]), np.zeros_like(p["bytes"])
    rows = np.arange(len(chunks))[:, None]
    for k in range(WIDTH):
        at = raw[rows, best + k]
        filters[k] = np.einsum("cf,cfv->vf", back, p["bytes"].take(at, 0))
        np.add.at(byte_rows, at, back[:, :, None] * p["filters"][k].T[None])
    return {
        "bytes": byte_rows,
        "filters": filters + 1e-4 * p["filters"],
        "bias": back.sum(0),
        "weights": features.T @ error + 1e-3 * p["weights"],
        "offset": error.sum(keepdims=True),
    }


def held_out(doc_id):
    """The third of the ids that no label is learned from."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def score_documents(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id, score`` of every whole text; no shuffle."""
    # A few MB of tables, whatever the documents are.
    held = docs.sparkSession.sparkContext.broadcast(network)

    def task(rows):
        net = held.value
        for doc_id, text in rows:
            yield doc_id, net.score(text)

    return map_rows(docs, ["doc_id", "text"], "doc_id long, score double", pa.schema([("doc_id", pa.int64()), ("score", pa.float64())]), task)


def keep_quality(docs: DataFrame, labels: DataFrame, least: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """The documents, with all their columns, whose score is ``least`` or more; no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(fit(training_sample(docs, labels, per_class)))

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                yield batch.filter(pa.array([held.value.score(t) >= least for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, from a network fitted to ``labels``."""
    network = fit(training_sample(docs, labels, per_class))
    return score_documents(docs, network).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
