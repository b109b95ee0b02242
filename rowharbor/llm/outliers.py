"""Rejection of documents whose statistics are multivariate outliers among those of their language and source.

Each document gives a vector of transformed statistics. Per group, a minimum-covariance-determinant estimate is found
by concentration steps over all rows of the group: distances under the present centre and covariance, the ``SUPPORT``
share of nearest rows, their mean and covariance, and again. Two starts are followed, coordinate-wise medians with their median
deviations and medians with the ordinary covariance; the smaller determinant wins. The estimate is scaled to the median
distance of a normal sample, refitted on the rows within the 97.5 % quantile, and documents beyond ``CUTOFF`` are rejected.

Only sums, counts and quantiles of rounded values leave the tasks, so a group may hold any share of the rows. Quantiles
are exact for values rounded to ``DIGITS`` decimals, which bounds what a quantile has to hold.

Groups of fewer than ``MIN_ROWS`` documents are judged with the other small groups of their language, and where that
is not enough, with the small groups of all languages; if that pool is too small too, it rejects nothing.

Defined cases: a NULL text has no words; documents without 50 words, or more than half of whose words are in
repeated windows, fail the base rule, are not kept and take no part in the estimates; NULL language or source is a
value of its own; NULL ids are kept; repeated rows count as often as they stand; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowharbor.llm.arrow_tasks import map_rows
from rowharbor.session import cut_lineage

SUPPORT = 0.75
STEPS = 4
MIN_ROWS = 60
DIGITS = 2
SALTS = 32
CUTOFF = 0.999999
BASE_WORDS = 50
SYMBOLS = b"#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"

STATS_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string())]
    + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")]
)
STATS_DDL = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"

#: Least spread of each statistic. It stands for differences that say nothing of quality, and keeps constant statistics invertible.
FLOORS = {"z_words": 0.3, "z_word_length": 0.06, "z_symbols": 0.35, "z_dup_lines": 0.16, "z_repeats": 0.12}
NAMES = list(FLOORS)
P = len(NAMES)


def text_statistics(text: str | None) -> tuple[int, int, int, int, int, int]:
    """Words, code points in words, symbols, lines with a word, repeats of such lines, words in repeated windows of three."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return n, chars, symbols, len(lines), len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words within windows of three words that are found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    kinds = len(number)
    _, pairs = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)
    _, window, counts = np.unique(pairs[:-1] * kinds + ids[2:], return_inverse=True, return_counts=True)
    repeated = counts[window] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= repeated
    return int(inside.sum())


def document_statistics(docs: DataFrame) -> DataFrame:
    """Counts of every whole text; no shuffle."""

    def task(rows):
        for doc_id, lang, source, text in rows:
            yield doc_id, lang, source, *text_statistics(text)

    return map_rows(docs, ["doc_id", "lang", "source", "text"], STATS_DDL, STATS_SCHEMA, task)


def transformed() -> list[Column]:
    """The statistic vector, on scales on which clean text is close to normal."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    values = (
        F.log(words.cast("double")),
        F.log(chars / words),
        F.log1p(200 * F.col("n_symbols") / chars),
        F.asin(F.sqrt(F.col("n_dup_lines") / lines)),
        F.asin(F.sqrt(F.col("n_repeat_words") / words)),
    )
    return [v.alias(n) for v, n in zip(values, NAMES, strict=True)]


def chi_square_quantile(share: float, k: int) -> float:
    """The value below which a chi-square variable of ``k`` degrees falls with probability ``share``."""

    def below(x: float) -> float:
        a, x = k / 2, x / 2
        term = total = 1 / a
        i = a
        while term > 1e-17 * total:
            i += 1
            term *= x / i
            total += term
        return total * math.exp(a * math.log(x) - x - math.lgamma(a))

    low, high = 1e-9, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return low


def assign_groups(stats: DataFrame) -> DataFrame:
    """``group_key`` of each row: language and source, or a pool of small groups; NULL where even that is small."""
    own = F.to_json(F.struct("lang", "source"))
    by_lang = F.to_json(F.struct("lang"))
    judged = stats.where(~F.col("base_failed"))
    sizes = judged.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")).withColumns({"own_key": own, "lang_key": by_lang})
    sizes = cut_lineage(sizes, "groups")  # one row per language and source
    small = sizes.where(F.col("n") < MIN_ROWS)
    of_lang = small.groupBy("lang_key").agg(F.sum("n").alias("n_lang"))
    rest = of_lang.where(F.col("n_lang") < MIN_ROWS).agg(F.coalesce(F.sum("n_lang"), F.lit(0)).alias("n_rest"))
    key = (
        F.when(F.col("n") >= MIN_ROWS, F.col("own_key"))
        .when(F.col("n_lang") >= MIN_ROWS, F.concat(F.lit("small "), F.col("lang_key")))
        .when(F.col("n_rest") >= MIN_ROWS, F.lit("small"))
    )
    # ``rest`` is a single row.
    keys = sizes.join(of_lang, "lang_key", "left").join(F.broadcast(rest)).select("own_key", key.alias("group_key"))
    return stats.withColumn("own_key", own).join(keys, "own_key", "left").drop("own_key")


def _distance() -> Column:
    """Squared Mahalanobis distance under the joined ``center`` and ``precision``."""
    off = [F.col(n) - F.col("center")[i] for i, n in enumerate(NAMES)]
    terms = [(1 if i == j else 2) * F.col("precision")[i * P + j] * off[i] * off[j] for i in range(P) for j in range(i, P)]
    return reduce(Column.__add__, terms)


def _log_distance() -> Column:
    return F.round(F.log(F.greatest(F.col("d2"), F.lit(1e-6))), DIGITS)


def _beside(rows: DataFrame, per_group: DataFrame) -> DataFrame:
    """Every row with what is known of its group; a group is spread over ``SALTS`` parts, so that sums are formed in many tasks."""
    spread = per_group.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(spread, ["group_key", "salt"])


def _moments(df: DataFrame, keys: list[str]) -> DataFrame:
    means = [F.avg(n) for n in NAMES]
    products = [F.covar_pop(a, b) for i, a in enumerate(NAMES) for b in NAMES[i:]]
    return df.groupBy(*keys).agg(F.array(*means).alias("center"), F.array(*products).alias("upper"))


def _fitted(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Precision and log determinant of each covariance, one row per group and start."""
    floors = np.diag(np.square(list(FLOORS.values())))

    def invert(batches):
        for pdf in batches:
            center, precision, logdet = [], [], []
            for c, u in zip(pdf["center"], pdf["upper"], strict=True):
                cov = np.zeros((P, P))
                cov[np.triu_indices(P)] = np.asarray(u, float)
                cov = cov + np.triu(cov, 1).T + floors
                center.append([float(f"{x:.12g}") for x in c])
                precision.append([float(f"{x:.12g}") for x in np.linalg.inv(cov).ravel()])
                logdet.append(float(f"{np.linalg.slogdet(cov)[1]:.12g}"))
            yield pd.DataFrame({k: pdf[k] for k in keys} | {"center": center, "precision": precision, "logdet": logdet})

    kinds = "group_key string" + (", start int" if "start" in keys else "")
    return cut_lineage(moments.mapInPandas(invert, f"{kinds}, center array<double>, precision array<double>, logdet double"), "estimates")


def mcd_estimates(rows: DataFrame) -> DataFrame:
    """``group_key, center, precision, scale`` from ``rows`` of group keys, salts and vectors: one row per group."""
    medians = rows.groupBy("group_key").agg(*[F.percentile(F.round(n, DIGITS + 1), 0.5).alias(f"m_{n}") for n in NAMES])
    spread = [F.percentile(F.round(F.abs(F.col(n) - F.col(f"m_{n}")), DIGITS + 1), 0.5).alias(f"s_{n}") for n in NAMES]
    robust = _beside(rows, cut_lineage(medians, "medians")).groupBy("group_key", *[f"m_{n}" for n in NAMES]).agg(*spread)
    center = F.array(*[F.col(f"m_{n}") for n in NAMES])
    squares = F.array(*[F.pow(1.4826 * F.col(f"s_{a}"), 2) if a == b else F.lit(0.0) for i, a in enumerate(NAMES) for b in NAMES[i:]])
    plain = _moments(rows, ["group_key"]).select("group_key", "upper")
    starts = robust.select("group_key", F.lit(0).alias("start"), center.alias("center"), squares.alias("upper")).unionByName(
        robust.select("group_key", center.alias("center")).join(plain, "group_key").withColumn("start", F.lit(1))
    )
    keys = ["group_key", "start"]
    estimate = _fitted(starts, keys)
    for _ in range(STEPS):
        near = _beside(rows, estimate).withColumn("d2", _distance())
        bound = near.groupBy(*keys).agg(F.percentile(_log_distance(), SUPPORT).alias("bound"))
        bounded = cut_lineage(estimate.join(bound, keys), "bounds")
        inner = _beside(rows, bounded).withColumn("d2", _distance()).where(_log_distance() <= F.col("bound"))
        estimate = _fitted(_moments(inner, keys), keys)
    best = estimate.groupBy("group_key").agg(F.min_by(F.struct("center", "precision"), F.struct("logdet", "start")).alias("e"))
    best = cut_lineage(best.select("group_key", "e.center", "e.precision"), "estimates")
    best = cut_lineage(best.join(_scales(rows, best), "group_key"), "estimates")
    refit = _beside(rows, best).withColumn("d2", _distance() * F.col("scale")).where(F.col("d2") <= chi_square_quantile(0.975, P))
    final = _fitted(_moments(refit, ["group_key"]), ["group_key"])
    return cut_lineage(final.join(_scales(rows, final), "group_key").select("group_key", "center", "precision", "scale"), "estimates")


def _scales(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """The factor that brings the median distance of a group to that of a normal sample; never above 1."""
    middle = F.exp(F.percentile(_log_distance(), 0.5))
    d2 = _beside(rows, estimate).withColumn("d2", _distance())
    return d2.groupBy("group_key").agg(F.least(F.lit(chi_square_quantile(0.5, P)) / middle, F.lit(1.0)).alias("scale"))


def judge_documents(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: its counts, ``base_failed``, its distance (NULL if not judged) and ``kept``."""
    failed = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = cut_lineage(document_statistics(docs).withColumn("base_failed", failed), "statistics")
    keyed = cut_lineage(assign_groups(stats.select("*", *transformed())), "vectors")
    keyed = keyed.withColumn("salt", F.pmod(F.xxhash64("doc_id", *NAMES), F.lit(SALTS)).cast("int"))
    judged = keyed.where(~F.col("base_failed") & F.col("group_key").isNotNull()).select("group_key", "salt", *NAMES)
    estimates = mcd_estimates(judged)
    spread = estimates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = keyed.join(spread, ["group_key", "salt"], "left").withColumn("distance", F.when(~F.col("base_failed"), _distance() * F.col("scale")))
    outlier = F.coalesce(F.col("distance") > chi_square_quantile(cutoff, P), F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", (~F.col("base_failed") & ~outlier).alias("kept"))
