"""Lines and markup as sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowharbor.functions.text import strip

#: Markers of the log lines worth keeping, and the text for an absent metric.
LOG_MARKERS = ("[DEBUG]", "Rows:", "Count")
UNKNOWN = "Unknown"

_TITLE = r"(?is)<title[^>]*>\s*(.*?)\s*</title>"
_LINK = r"(?i)<a\s[^>]*href"
_CELL = r"(?is)<td[^>]*>\s*(.*?)\s*</td>"


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Lines of text files as column ``value``; the encoding covers files from other systems."""
    if encoding.upper() in ("UTF-8", "UTF8"):
        return spark.read.text(path)
    return spark.read.csv(path, sep="\n", quote="", encoding=encoding, schema="value string", multiLine=True)


def split_lines(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per line of a text column."""
    return df.select(*keep, F.explode(F.split(F.col(text), "\r\n|\r|\n")).alias("value"))


def filter_lines(lines: DataFrame, markers: Sequence[str] = LOG_MARKERS, column: str = "value") -> DataFrame:
    """Lines that contain any marker, trimmed."""
    wanted = reduce(or_, [F.contains(F.col(column), F.lit(m)) for m in markers])
    return lines.where(wanted).withColumn(column, strip(F.col(column)))


def html_metric(html: Column, label: str, value: str = r"[^<\n]+") -> Column:
    """Text after ``label:`` in a page, skipping the tags in between; ``Unknown`` when absent."""
    pattern = rf"{label}:(?:\s|<[^>]*>)*({value})"
    found = F.regexp_extract(html, pattern, 1)
    return F.when(found != "", strip(found)).otherwise(F.lit(UNKNOWN))


def html_cells(html: Column) -> Column:
    """Texts of all table cells of a page."""
    return F.regexp_extract_all(html, F.lit(_CELL), F.lit(1))


def extract_html_metrics(pages: DataFrame, html: str, keep: Sequence[str] = ()) -> DataFrame:
    """Title (``Unknown`` when absent), number of links and of table cells of each page."""
    page = F.col(html)
    title = F.regexp_extract(page, _TITLE, 1)
    return pages.select(
        *keep,
        F.when(title != "", title).otherwise(F.lit(UNKNOWN)).alias("title"),
        F.regexp_count(page, F.lit(_LINK)).cast("bigint").alias("n_links"),
        F.size(html_cells(page)).cast("bigint").alias("n_cells"),
    )


def report_rows(pages: DataFrame, html: str, tables: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Counts of the named tables as a load report lists them, one row per page and table found."""
    found = pages.select(
        *keep,
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(t).alias("table"),
                        F.regexp_extract_all(
                            F.col(html),
                            F.lit(rf"<td>{t}</td>\s*((?:<td[^>]*>\d+</td>\s*){{5}}<td[^>]*>[^<]*</td>)"),
                            F.lit(1),
                        ).alias("_rows"),
                    )
                    for t in tables
                ]
            )
        ).alias("_t"),
    ).where(F.size("_t._rows") > 0)
    cells = F.regexp_extract_all(F.col("_t._rows")[0], F.lit(r"<td[^>]*>([^<]*)</td>"), F.lit(1))
    names = ("read_rows", "loaded", "rejected", "inserted", "updated")
    return found.withColumn("_c", cells).select(
        *keep,
        F.col("_t.table").alias("table"),
        *[F.col("_c")[i].try_cast("bigint").alias(n) for i, n in enumerate(names)],
        strip(F.col("_c")[5]).alias("status"),
    )
