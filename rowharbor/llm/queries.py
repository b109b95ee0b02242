"""The registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rowharbor.llm import bpe, classifier, codes, embeddings, licenses, lines, merkle, minhash, oracle_sql, outliers, packing, passages, secrets, substrings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Components by the smallest id reached, from ``nodes`` (id, ...) and ``links`` (a, b).
REACHED_SQL = """both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT id, id AS other FROM nodes UNION SELECT r.id, l.b FROM reached r JOIN both_ways l ON r.other = l.a),
smallest AS (SELECT id, MIN(other) AS component_id FROM reached GROUP BY id)"""

ORACLES["op3_hyperplane_cosine"] = f"""WITH RECURSIVE nodes AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (SELECT x.id AS a, y.id AS b FROM nodes x JOIN nodes y ON x.id < y.id WHERE LIST_COSINE_SIMILARITY(x.v, y.v) >= 0.9),
{REACHED_SQL}
SELECT s.id AS vec_id, (SELECT COUNT(*) FROM both_ways l WHERE l.a = s.id) AS n_links, component_id, s.id = component_id AS kept FROM smallest s"""

ORACLES["op10_bottom_k_minhash"] = f"""WITH RECURSIVE worded AS (SELECT doc_id, REGEXP_EXTRACT_ALL(
  TRANSLATE(COALESCE(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
nodes AS (SELECT doc_id AS id, CASE WHEN LEN(w) = 0 THEN [] WHEN LEN(w) < 5 THEN [ARRAY_TO_STRING(w, ' ')]
  ELSE LIST_DISTINCT([ARRAY_TO_STRING(w[i:i + 4], ' ') FOR i IN RANGE(1, LEN(w) - 3)]) END AS s FROM worded),
items AS (SELECT id, UNNEST(s) AS x FROM nodes),
pairs AS (SELECT x.id AS a, y.id AS b, COUNT(*) AS n FROM items x JOIN items y ON x.x = y.x AND x.id < y.id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN nodes x ON x.id = a JOIN nodes y ON y.id = b WHERE 100 * n >= 75 * (LEN(x.s) + LEN(y.s) - n)),
{REACHED_SQL}
SELECT n.id AS doc_id, LEN(n.s) AS n_shingles, component_id, n.id = component_id AS kept FROM nodes n JOIN smallest USING (id)"""

ORACLES["op11_count_min_passages"] = oracle_sql.PASSAGES
ORACLES["op12_merkle_manifest"] = oracle_sql.MANIFEST
ORACLES["op13_active_entry_codes"] = oracle_sql.CODES


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the bytes they decode to, as counts and digests."""
    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)
    decoded = bpe.decode_documents(encoded, vocabulary, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text, with how many of their values are live-looking or widely copied."""
    found = secrets.scan_documents(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(kind) for kind in secrets.BASE_KINDS],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
        "n_live",
        "n_widespread",
    )


@query
def op4_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, and whether it is kept among those of its language and source."""
    return outliers.judge_documents(table(spark, sf_dir, "documents"))


@query
def op5_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text from a byte-level convolutional network."""
    return classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every token of every document stands in sequences of 1024."""
    return pack(table(spark, sf_dir, "documents"))


def pack(docs: DataFrame) -> DataFrame:
    vocabulary = bpe.read_vocabulary(docs.sparkSession, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    added = bpe.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack_documents(docs, vocabulary, public_tokenizers.PATTERN, added=added)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op8_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in every text, after suppression of detections inside surer ones."""
    return licenses.detect_licenses(table(spark, sf_dir, "documents")).drop("detections")


@query
def op10_bottom_k_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near-duplicates of every document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_hyperplane_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors with a cosine of 0.9 or more."""
    return embeddings.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query
def op9_lyndon_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without the strings of 200 bytes that start at two places or more."""
    found = substrings.remove_repeated(table(spark, sf_dir, "documents"))
    spans = F.coalesce(F.size("starts"), F.lit(0))
    return found.select("doc_id", "n_bytes", "n_removed", F.greatest(spans, F.lit(0)).cast("long").alias("n_spans"), "kept_sha256")


@query
def op7_segment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every document that go, as lines within two edits stand in more than six documents."""
    return lines.repeated_lines(table(spark, sf_dir, "documents")).drop("row_id")


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; half of them are audited with their line feeds taken out."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(docs, MANIFEST_FIELDS, [text if c == "text" else F.col(c) for c in MANIFEST_FIELDS])
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root", "verified"
    )


@query
def op11_count_min_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without the windows of 50 words that stand in a document of a smaller id."""
    found = passages.remove_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_active_entry_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every vector, its error and that of its label."""
    coded, books = codes.vector_codes(table(spark, sf_dir, "embeddings"))
    found = codes.with_label_errors(coded)
    return found.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(codes.books_digest(books)).alias("codebooks_sha256"))
