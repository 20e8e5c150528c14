"""Each stage of the pipeline against a plain version on its own input."""

from __future__ import annotations

import brute
import public_tokenizers
import pytest
import sentencepiece as library
from brute import ordered

import corpus_pipeline
from fillscope.scale import cut_lineage


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Input and output rows of each stage."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        out = cut_lineage(stage(spark, docs, folder))
        found.append((name, docs, out))
        docs = out
    return found


def _pairs(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_columns_stay(stages):
    assert [n for n, _, _ in stages] == [n for n, _ in corpus_pipeline.STAGES] and len(stages) == 5
    assert all(out.columns == docs.columns for _, docs, out in stages[:-1])


def test_toxicity(stages):
    _, docs, out = stages[0]
    kept = set(_pairs(out))
    assert kept <= set(_pairs(docs)) and len(kept) >= 0.9 * docs.count()


def test_lines(stages):
    _, docs, out = stages[1]
    expected = brute.line_dedup(_pairs(docs))
    assert ordered(_pairs(out)) == ordered((d, t) for d, _, _, t in expected)
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_near_duplicates(stages):
    _, docs, out = stages[2]
    expected = {d for d, _, c in brute.near_duplicates(_pairs(docs)) if d == c}
    assert ordered(_pairs(out)) == ordered(p for p in _pairs(docs) if p[0] in expected)


def test_contamination(stages, spark, folder):
    _, docs, out = stages[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = {d for d, _, where, _ in brute.contamination(_pairs(docs), items) if where}
    assert ordered(_pairs(out)) == ordered(p for p in _pairs(docs) if p[0] not in hit)
    assert hit


def test_tokens(stages):
    _, docs, out = stages[4]
    other = library.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.MODEL))
    expected = [(d, len(i), i, other.decode(i)) for d, t in _pairs(docs) for i in [other.encode(t)]]
    assert ordered(out.collect()) == ordered(expected)


COPY = " ".join(f"copy{i}" for i in range(60))
# (id, text) and whether the row stays.
GROUPS = [
    ((1, COPY), True),
    ((None, COPY + " more"), False),
    ((None, "an unrelated text without an id that nothing else resembles"), True),
    ((None, None), True),
    ((None, ""), True),
    ((2, COPY + " other"), False),
    ((2, "a clean text under an id used twice, which must not be lost"), True),
    ((3, "a row that is in the table twice, of which one must stay"), True),
    ((3, "a row that is in the table twice, of which one must stay"), False),
    ((None, "copies which have no id at all, of which one must stay too"), True),
    ((None, "copies which have no id at all, of which one must stay too"), False),
]


@pytest.mark.parametrize("stored", [False, True])
def test_near_duplicates_are_told_apart_by_row(spark, folder, stored):
    docs = spark.createDataFrame([r for r, _ in GROUPS], "doc_id long, text string").repartition(3)
    out = corpus_pipeline.drop_near_duplicates(spark, cut_lineage(docs) if stored else docs, folder)
    assert ordered(_pairs(out)) == ordered(r for r, stays in GROUPS if stays)


def test_all_stages_on_awkward_documents(spark, folder):
    docs = cut_lineage(brute.edge_documents(spark))
    for name, stage in corpus_pipeline.STAGES:
        out = cut_lineage(stage(spark, docs, folder))
        if stage is corpus_pipeline.drop_near_duplicates:
            groups = brute.near_duplicates([(i, t) for i, (_, t) in enumerate(_pairs(docs))])
            wordless = sum(n == 0 for _, n, _ in groups)
            assert out.count() == wordless + len({c for _, n, c in groups if n})
        elif stage is not corpus_pipeline.drop_toxic and stage is not corpus_pipeline.drop_contaminated:
            assert out.count() == docs.count(), name
        docs = out


def test_columns_of_any_name_stay(spark, folder):
    names = ("_found", "_row", "_toxicity", "_gone_doc", "found", "found_0", "set", "n_lines")
    docs = spark.createDataFrame([(i, f"text {i} of its own", *[f"{n}{i}" for n in names]) for i in range(5)], f"doc_id long, text string, {', '.join(n + ' string' for n in names)}")
    docs = cut_lineage(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and ordered(out.collect()) == ordered(docs.collect()), name
