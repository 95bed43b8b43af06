"""Extra columns named like a result or a helper column, in any case."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import decontaminate, html_extract, quality, suffix_dedup, toxicity

PROSE = "The quick brown fox jumps over the lazy dog, and then it rests for a while. "


def with_extra(docs, *names):
    return docs.select("*", *(F.lit(i).alias(n) for i, n in enumerate(names)))


@pytest.fixture(scope="module")
def docs(make_docs):
    return make_docs([PROSE, None, "", PROSE * 9])


def test_toxicity(docs):
    model = toxicity.Model(np.zeros(0, np.uint32), np.zeros(0), -5.0, -5.0)
    out = toxicity.score(with_extra(docs, "Toxicity", "OFFENDING", "Score"), model)
    assert "Score" in out.columns and out.where("toxicity < 0.5").count() == 4


def test_quality(docs):
    width = len(quality.features(b""))
    model = quality.Model(np.zeros(width), np.ones(width), [np.zeros(0)] * width, np.zeros(2 * width), 0.0)
    assert quality.score(with_extra(docs, "QUALITY_SCORE", "Rank"), model).where("quality_score = 0.5").count() == 4


def test_html(llm):
    pages = llm.createDataFrame([(1, "u", f"<p>{PROSE * 3}</p>")], "page_id long, url string, html string")
    out = html_extract.extract(with_extra(pages, "TEXT", "Path"))
    assert out.columns == ["page_id", "url", "Path", "text"] and out.first().text.startswith("The quick")


def test_repeats(docs):
    out = suffix_dedup.remove_repeats(with_extra(docs, "RID", "_Text", "At", "Kept", "n"))
    assert "n" in out.columns and out.where("octet_length(kept) = 0").count() == 3  # null, empty, and the text that repeats throughout


def test_leaks_keep_all_columns(llm, docs):
    items = llm.createDataFrame([(7, PROSE)], "item_id long, text string")
    out = decontaminate.without_leaks(with_extra(docs, "_rid", "_RID_", "Key"), items)
    assert out.columns == [*docs.columns, "_rid", "_RID_", "Key"]
    assert sorted((r.text or "") for r in out.collect()) == ["", ""]
