"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosines, connected components.

Equal vectors are one from then on, with the number of their rows. Each distinct vector falls into one bucket per table, by the
signs of its products with random hyperplanes. The number of bits follows from the number of distinct vectors (about ``PER_BUCKET`` per
bucket if they were spread evenly) and the number of tables from the bits, so that a pair at the threshold meets in
some table with probability ``RECALL`` at any size of the input. All pairs of a bucket are compared in double precision; a bucket of more
than ``BLOCK`` vectors is compared block by block in separate tasks. A task does not emit pairs: it counts the links of each vector that
no earlier table has found, and names the smallest vector that the vector's links reach within the blocks.

Defined cases: NULL vectors, vectors of zeros and vectors with NULL or non-finite components link with nothing; vectors of different
lengths do not link; a row without an id links with nothing and is kept; rows that share an id are rows of one vector only if the
vectors are equal; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rowharbor.llm.arrow_tasks import map_rows
from rowharbor.llm.components import connected_components, reached
from rowharbor.session import cut_lineage

COSINE = 0.9
RECALL = 0.985
PER_BUCKET = 256
BLOCK = 512
SEED = 20


def plan_tables(vectors: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Bits per table, and tables, for so many distinct vectors."""
    bits = max(4, math.ceil(math.log2(max(1, vectors) / PER_BUCKET)))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


@lru_cache(maxsize=8)
def hyperplanes(length: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, length]).normal(size=(length, tables * bits))


def usable(vector) -> bool:
    return vector is not None and None not in vector and len(vector) > 0 and bool(np.isfinite(v := np.asarray(vector, float)).all()) and bool(v.any())


def distinct_vectors(rows: DataFrame, column: str) -> DataFrame:
    """``vec_id, vec_key, vector``: the components as bytes of doubles; key and bytes are NULL where a vector links with nothing."""

    def task(found):
        for vec_id, vector in found:
            if vec_id is None or not usable(vector):
                yield vec_id, None, None
            else:
                data = (np.asarray(vector, "<f8") + 0.0).tobytes()
                yield vec_id, xxhash.xxh3_128_digest(data), data

    schema = pa.schema([("vec_id", pa.int64()), ("vec_key", pa.binary()), ("vector", pa.binary())])
    return map_rows(rows, ["vec_id", column], "vec_id long, vec_key binary, vector binary", schema, task)


def signatures(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """``id, weight, vector, length, signs``: one sign code per table."""
    powers = 1 << np.arange(bits, dtype=np.int64)

    def run(batches):
        for pdf in batches:
            codes = []
            for data in pdf["vector"]:
                v = np.frombuffer(data, "<f8")
                codes.append(((v @ hyperplanes(len(v), bits, tables)).reshape(tables, bits) > 0) @ powers)
            yield pd.DataFrame({"id": pdf["id"], "weight": pdf["weight"], "vector": pdf["vector"], "length": [len(d) // 8 for d in pdf["vector"]], "signs": codes})

    return classes.mapInPandas(run, "id long, weight long, vector binary, length int, signs array<long>")


def block_links(signed: DataFrame, cosine: float) -> DataFrame:
    """``id, n_links, reached`` per vector and block: links no earlier table has found, and the smallest vector they reach."""
    entries = signed.select("id", "weight", "vector", "length", "signs", F.posexplode("signs").alias("tab", "code"))
    bucket = ["length", "tab", "code"]
    sizes = entries.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = cut_lineage(sizes.select(*bucket, F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "buckets")
    placed = entries.join(sizes, bucket).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        table, low, high = int(pdf["tab"].iloc[0]), pdf["low"].iloc[0], pdf["high"].iloc[0]
        ids, weight = pdf["id"].to_numpy(), pdf["weight"].to_numpy(float)
        v = np.frombuffer(b"".join(pdf["vector"]), "<f8").reshape(len(pdf), -1)
        # Each vector is scaled by its largest component first, so that squares neither overflow nor vanish.
        v = v / np.abs(v).max(1, keepdims=True)
        v = v / np.sqrt((v * v).sum(1, keepdims=True))
        links = v @ v.T >= cosine
        np.fill_diagonal(links, False)
        if low != high:
            first = pdf["own"].to_numpy() == low
            links &= first[:, None] != first[None]
        i, j = np.nonzero(links)
        signs = np.stack(pdf["signs"].to_numpy())
        new = ~(signs[i, :table] == signs[j, :table]).any(1)
        count = np.bincount(i[new], weight[j[new]], len(ids)).astype(np.int64)
        label = reached(links, ids)
        some = links.any(1)
        return pd.DataFrame({"id": ids[some], "n_links": count[some], "reached": label[some]})

    return placed.groupBy(*bucket, "low", "high").applyInPandas(compare, "id long, n_links long, reached long")


def near_duplicate_vectors(rows: DataFrame, column: str = "embedding", cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row."""
    known = cut_lineage(distinct_vectors(rows, column), "vectors")
    good = known.where(F.col("vec_key").isNotNull())
    groups = cut_lineage(good.groupBy("vec_key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight")), "classes")
    bits, tables = plan_tables(groups.count(), cosine, recall)
    classes = good.join(groups, "vec_key").where("vec_id = id").dropDuplicates(["vec_key"]).select("id", "weight", "vector")
    found = cut_lineage(block_links(signatures(classes, bits, tables), cosine), "block-links")
    counts = cut_lineage(found.groupBy("id").agg(F.sum("n_links").alias("linked")), "counts")
    components = cut_lineage(connected_components(found.select(F.col("id").alias("a"), F.col("reached").alias("b"))), "components")
    classes_out = groups.join(counts, "id", "left").join(components, F.col("id") == F.col("node"), "left")
    classes_out = classes_out.select("vec_key", (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = good.select("vec_id", "vec_key").join(cut_lineage(classes_out, "class-results"), "vec_key").select("vec_id", "n_links", "component_id")
    bare = known.where(F.col("vec_key").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(bare).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
