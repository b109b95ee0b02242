"""Scan for secrets by regular expressions, and the frequency of each candidate value in the whole corpus.

Every text is scanned once by SQL expressions; a cheap test per kind comes before the scan for places. The
digests of the candidate values are then counted by distinct repositories and owners: a value that several owners hold is a widely
copied example, one that few hold is a credential that may be live. Only digests, counts and places are written, never the values.

A value may stand in any share of the documents. Equal digests are reduced per owner and repository before they are
counted, and the counts are written as a table before they are joined back, so that both sides of the join are
plain exchanges whose hot partitions adaptive execution splits.

Defined cases: a NULL text is the empty text; documents without candidates have empty lists; NULL ids are kept, and a NULL
owner or repository is one of its own; repeated rows are scanned as often as they stand and are one repository; an empty table gives
no rows. ``scan_documents`` carries no column but those it lists; ``redact_documents`` returns all columns of its input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rowharbor.llm.native_text import spans_of
from rowharbor.session import cut_lineage

#: The base kinds, in their order.
BASE_KINDS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}",
}
_PEM_MARK = r"[A-Z ]{0,30}PRIVATE KEY-----"
#: What may stand between the parts of a key: blanks, escaped line breaks, quotes and marks of quoted or commented lines.
_PEM_GAP = r"""(?:\\+[nrt]|[\s"'`,>#*|\\])*+"""
#: Well-known forms of keys; they follow the base kinds in order. A private key reaches to its END line; where that is cut off, over
#: the header fields and the runs of base64 that follow the BEGIN line.
MORE_KINDS = {
    "github": r"\bgh[oprsu]_[A-Za-z0-9]{36,}",
    "google": r"\bAIza[0-9A-Za-z_-]{35,}",
    "jwt": r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "pem": f"-----BEGIN {_PEM_MARK}"
    + f"(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END {_PEM_MARK}"
    + rf"|(?:{_PEM_GAP}(?:(?:Proc-Type|DEK-Info): ?[^\s\\]++|[A-Za-z0-9+/]{{20,}}+={{0,2}}+))*+(?:{_PEM_GAP}[A-Za-z0-9+/]++(?:={{1,2}}+|(?=\s*+\z)))?+)",
    "slack": r"\bxox[abeoprs]-[0-9A-Za-z-]{10,}",
    "stripe": r"\b[rs]k_live_[0-9A-Za-z]{16,}",
}
KINDS = BASE_KINDS | MORE_KINDS
#: The value of an assignment: its second group.
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ASSIGN_LENGTH = 6
#: What is not part of a key's value: the same key counts as one, however its lines are broken, indented or quoted.
PEM_LAYOUT = r"\\+[nrt]?|[^A-Za-z0-9+/=\\]+"
#: A cheap test for each kind, on the text or (first) on the text in lower case.
HINTS = {
    "assign": ["passw", "secret", "token", "apikey", "api_key"],
    "access": ["AKIA"],
    "github": ["gho_", "ghp_", "ghr_", "ghs_", "ghu_"],
    "google": ["AIza"],
    "jwt": ["eyJ"],
    "pem": ["PRIVATE KEY-----"],
    "slack": ["xox"],
    "stripe": ["k_live_"],
}
#: A value held by at least so many owners is a widely copied example.
WIDESPREAD_OWNERS = 3

SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string,digest:string>"


def _hint(kind: str, text: Column) -> Column:
    if kind == "hex":
        return text.rlike(r"[0-9a-f]{24}")
    if kind == "assign":
        lowered = F.lower(text)
        return reduce(Column.__or__, [lowered.contains(h) for h in HINTS[kind]])
    return reduce(Column.__or__, [text.contains(h) for h in HINTS[kind]])


def _spans(kind: str, rank: int, text: Column) -> Column:
    if kind == "assign":
        value = lambda s: F.regexp_extract(s["value"], ASSIGN_VALUE, 1)
    elif kind == "pem":
        value = lambda s: F.regexp_replace(s["value"], PEM_LAYOUT, "")
    else:
        value = lambda s: s["value"]
    found = spans_of(text, KINDS[kind])
    if kind == "assign":
        found = F.filter(found, lambda s: F.length(value(s)) >= ASSIGN_LENGTH)

    def span(s: Column) -> Column:
        digest = F.sha2(value(s), 256).alias("digest")
        return F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), digest)

    return F.when(_hint(kind, text), F.transform(found, span)).otherwise(F.array().cast(f"array<{SPAN}>"))


def secret_spans(text: Column) -> Column:
    """``array<struct<start, rank, end, kind, digest>>`` of all kinds, by start and then by kind."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*[_spans(k, i, text) for i, k in enumerate(KINDS)]))


def scan_documents(docs: DataFrame, repository: str = "doc_id", owner: str = "source", widespread: int = WIDESPREAD_OWNERS) -> DataFrame:
    """``doc_id, repository, owner, spans, n_live, n_widespread, live`` per document; ``live`` lists the digests judged live."""
    found = cut_lineage(
        docs.select(
            "doc_id",
            F.col(repository).alias("repository"),
            F.col(owner).alias("owner"),
            secret_spans(F.col("text")).alias("spans"),
            F.monotonically_increasing_id().alias("row_id"),
        ),
        "secrets",
    )
    with_any = found.where(F.size("spans") > 0)
    values = with_any.select("row_id", "repository", "owner", F.explode(F.array_distinct(F.transform("spans", lambda s: s["digest"]))).alias("digest"))
    frequency = cut_lineage(value_frequency(values), "frequency")
    judged = values.join(frequency, "digest").select("row_id", "digest", (F.col("n_owners") >= widespread).alias("common"))
    per_row = judged.groupBy("row_id").agg(
        F.count_if(~F.col("common")).alias("n_live"),
        F.count_if("common").alias("n_widespread"),
        F.sort_array(F.collect_list(F.when(~F.col("common"), F.col("digest")))).alias("live"),
    )
    held = with_any.join(per_row, "row_id").drop("row_id")
    none = F.lit(0).cast("bigint")
    bare = found.where(F.size("spans") == 0).drop("row_id").withColumns({"n_live": none, "n_widespread": none, "live": F.array().cast("array<string>")})
    return held.unionByName(bare)


def value_frequency(values: DataFrame) -> DataFrame:
    """``digest, n_repositories, n_owners`` over the whole corpus, from rows of repository, owner and digest."""
    held = values.groupBy("digest", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    by_owner = held.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("n_repositories"))
    return by_owner.groupBy("digest").agg(F.sum("n_repositories").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners"))


def span_text(spans: Column) -> Column:
    """The spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact_documents(docs: DataFrame, repository: str = "doc_id", owner: str = "source", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every value judged live replaced by ``mark``; widely copied examples stay.

    The values are counted in a first scan. A digest is live or not for all documents alike, so the live ones
    are joined to the documents that hold a candidate; ``n_chars`` follows the text where the input has it.
    """
    columns = docs.columns
    spans = F.when(F.col("text").isNull(), F.array().cast(f"array<{SPAN}>")).otherwise(secret_spans(F.col("text")))
    packed = docs.select(F.struct(*columns).alias("doc"), spans.alias("spans"), F.monotonically_increasing_id().alias("row_id"))
    found = cut_lineage(packed, "secrets")
    with_any = found.where(F.size("spans") > 0)
    values = with_any.select(
        "row_id",
        F.col(f"doc.{repository}").alias("repository"),
        F.col(f"doc.{owner}").alias("owner"),
        F.explode(F.array_distinct(F.transform("spans", lambda s: s["digest"]))).alias("digest"),
    )
    frequency = cut_lineage(value_frequency(values), "frequency")
    live = values.join(frequency, "digest").where(F.col("n_owners") < WIDESPREAD_OWNERS).groupBy("row_id").agg(F.collect_set("digest").alias("live"))
    marked = with_any.join(live, "row_id", "left").withColumn(
        "clean", F.when(F.col("live").isNull(), F.col("doc.text")).otherwise(_replaced(F.col("doc.text"), F.filter("spans", lambda s: F.array_contains("live", s["digest"])), mark))
    )
    parts = marked.select("doc", "clean").unionByName(found.where(F.size("spans") == 0).select("doc", F.col("doc.text").alias("clean")))
    out = {c: F.col(f"doc.{c}") for c in columns} | {"text": F.col("clean")}
    if "n_chars" in columns:
        changed = ~F.col("clean").eqNullSafe(F.col("doc.text"))
        out["n_chars"] = F.when(changed, F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
    return parts.select(*[c.alias(n) for n, c in out.items()])


def _replaced(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with the spans, in order of their starts, replaced by ``mark``; overlapping spans become one mark."""

    def step(state: Column, s: Column) -> Column:
        gap = F.when(s["start"] >= state["at"], F.concat(F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], s["end"]).cast("int").alias("at"), F.concat(state["out"], gap).alias("out"))

    spans = F.transform(spans, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end")))
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))),
    )
