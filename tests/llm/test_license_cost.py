"""The license scan is cheap where no license is named."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from rowharbor.llm import licenses


@pytest.mark.parametrize("text", ["", " ", "\n", "--", "a", " a", "a\n", "x  y\tz", "é ß", "日本 語", "A-b_c.d", "1 2 3", "\x7f", "under the MIT license", " ", None])
def test_words_are_counted_without_matches(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = licenses.detect_licenses(docs)
    words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    row = found.first()
    assert row.n_words == len(words)
    assert (row.n_base, row.first_word, row.last_word) == ((1, 0, 0) if "MIT" in (text or "") else (0, None, None))


def test_one_search_tells_texts_without_keywords(spark):
    keywords = sorted({k for f in licenses.rule_table() for k in f["keywords"]})
    texts = [(f" {k} ",) for k in keywords] + [(f" x {k}s ",) for k in keywords]
    found = spark.createDataFrame(texts, "words string").select(F.regexp_like("words", F.lit(licenses.keyword_pattern())).alias("y"))
    assert all(r.y for r in found.collect())
    assert not any(re.search(licenses.keyword_pattern(), f" x{k} ") for k in keywords if " " not in k)
    plan = licenses.detect_licenses(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(") + plan.lower().count("contains(words") < 20
    assert "regexp_count" not in plan and licenses.NOT_WORD.replace("[", "[^", 1) not in plan
