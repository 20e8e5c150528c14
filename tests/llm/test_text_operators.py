"""Rules and edge cases of the operators on texts, against plain versions."""

from __future__ import annotations

import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece as library
from brute import ordered
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fillscope.llm import decontaminate, jaccard, language, licenses, lines, quality, sentencepiece, sharding, text, toxicity

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coder():
    return sentencepiece.Encoder(open(MODEL, "rb").read()), library.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def edge(spark):
    return brute.edge_documents(spark).repartition(3).cache()


@pytest.fixture(scope="module")
def pairs():
    return [r[:2] for r in brute.rows()]


# Words


@pytest.mark.parametrize("table", [text.ALNUM, text.NON_SPACE])
def test_word_hashes_depend_on_the_word_only(table):
    values = [t or "" for t in brute.TEXTS] + ["aa a aa", "a", "b a"]
    batch = pa.record_batch([pa.array(brute.TEXTS + ["aa a aa", "a", "b a"])], names=["text"])
    names: dict = {}
    for first, stop, data, offsets in text.text_slices(batch, limit=50):
        hashes, places = text.hashed_words(data, offsets, table)
        for row in range(first, stop):
            words = text.split_words(values[row], table)
            own = hashes[places[row - first] : places[row - first + 1]].tolist()
            assert len(words) == len(own)
            for word, name in zip(words, own):
                assert names.setdefault(word, name) == name
    assert len(set(names.values())) == len(names)


def test_lower_case_changes_ascii_only(spark, edge):
    found = edge.select("text", text.ascii_lower(F.col("text")).alias("x")).collect()
    assert all(r.x == (r.text if r.text is None else brute.ascii_lower(r.text)) for r in found)


# SentencePiece


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text_is_encoded_like_the_library(coder, value):
    own, other = coder
    ids = other.encode(value)
    assert own.encode(value) == ids
    assert own.encode_text(value) == (",".join(map(str, ids)), len(ids), other.decode(ids))
    assert own.decode(ids) == other.decode(ids)


def test_awkward_texts_are_encoded_like_the_library(coder):
    own, other = coder
    draw = random.Random(5)
    parts = [" ", "▁", "a", "the", "\n", "é", "中", "🤦🏼", "\x00", "  ", "ing", "0x", "<s>", "\r", "       ", "{", "});", "."]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 20))) for _ in range(2000)]
    texts += [" " * n + x for n in (1, 7, 15, 16, 17, 33, 1000) for x in ("", "x", "\n")] + ["a" * 5000, "=" * 3000, "ab" * 4000]
    for value in texts:
        assert own.encode(value) == other.encode(value), value[:50]


def test_encoded_documents(coder, edge):
    other = coder[1]
    found = sentencepiece.encode_documents(edge, MODEL).collect()
    expected = [(d, other.encode(t or ""), other.decode(other.encode(t or ""))) for d, t in (r[:2] for r in brute.rows())]
    assert ordered(found) == ordered(expected)
    digests = sentencepiece.encode_digests(edge, MODEL).collect()
    assert ordered(digests) == ordered((d, len(i), brute.sha(",".join(map(str, i))), brute.sha(x)) for d, i, x in expected)


# Lines


def test_line_dedup(edge, pairs):
    found = lines.dedup_lines(edge).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert ordered(found) == ordered(brute.line_dedup(pairs))
    assert any(r.n_dropped for r in found)


def test_bitmaps_of_long_documents(spark):
    same = [f"line number {i} that is long enough for the rule to apply" for i in range(200)]
    docs = [(d, "\n".join(same[: 150 + d] + [f"own {d}"])) for d in range(6)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = lines.dedup_lines(frame).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert ordered(found) == ordered(brute.line_dedup(docs))
    bitmap = lines.dropped_lines(frame).where("doc_id = 0").first()
    assert len(bitmap.dropped) == 3 and bitmap.n_dropped == 150


# Licenses


def test_base_phrases_and_own_labels(spark, edge, pairs):
    found = licenses.license_spans(edge).collect()
    assert sorted((repr(r.doc_id), r.n_words) for r in found) == sorted((repr(d), len(brute.alnum_words(t))) for d, t in pairs)
    seven = next(r for r in found if r.doc_id == 7)
    assert [(s.label, s.first) for s in seven.spans] == [("mit", 0), ("mit", 2), ("apache", 4), ("gpl", 7)]
    eight = next(r for r in found if r.doc_id == 8)
    # One word more than the template: two neighbouring diagonals, one span.
    assert [(s.label, s.first, s.last) for s in eight.spans] == [("mit-text", 0, 13)]
    assert 0.8 <= eight.spans[0].coverage < 1
    assert all(not r.spans for r in found if r.doc_id not in (7, 8))


def test_templates_must_have_two_words(spark, edge):
    with pytest.raises(ValueError):
        licenses.license_spans(edge, [licenses.Template("x", "word")])


# Near duplicates


def test_jaccard_join(edge, pairs):
    found = jaccard.near_duplicates(edge).collect()
    assert ordered(found) == ordered(brute.near_duplicates(pairs))


def test_chains_of_near_copies(spark):
    draw = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    docs, current = [], list(base)
    for d in range(60):
        docs.append((d, " ".join(current)))
        current[draw.randrange(len(current))] = f"n{d}"
    docs += [(100 + d, " ".join(f"v{draw.randrange(40)}" for _ in range(draw.randint(1, 60)))) for d in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for percent in (75, 60):
        found = jaccard.near_duplicates(frame, percent=percent).collect()
        assert ordered(found) == ordered(brute.near_duplicates(docs, percent))


def _family(draw, copies: int, far: int, size: int = 120) -> list[tuple]:
    """Copies of one text with few edits, and others with so many that most link with none."""
    base = [f"w{i}" for i in range(size)]
    docs = []
    for d in range(copies + far):
        words = list(base)
        for _ in range(draw.randint(0, 4) if d < copies else draw.randint(4, 12)):
            at, kind = draw.randrange(len(words)), draw.randrange(3)
            words[at : at + (kind > 0)] = [] if kind == 2 else [draw.choice(["x", "y", f"n{draw.random()}"])]
        docs.append((d, " ".join(words)))
    return docs


@pytest.mark.parametrize("percent", [75, 60, 90])
def test_families_of_near_copies(spark, monkeypatch, percent):
    monkeypatch.setattr(jaccard, "CROWD", 4)
    draw = random.Random(percent)
    docs = _family(draw, 60, 60)
    # Another family nearby, and one of short texts whose sets are mostly small differences.
    docs += [(200 + d, t.replace("w1", "v1")) for d, t in _family(draw, 25, 25)]
    docs += [(300 + d, t) for d, t in _family(draw, 20, 20, 14)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = jaccard.near_duplicates(frame, percent=percent).collect()
    assert ordered(found) == ordered(brute.near_duplicates(docs, percent))


def test_sets_around_a_large_group_do_not_meet_it_pair_by_pair(spark, monkeypatch):
    met = []
    for name in ("_met_by_shingle", "_met_by_difference"):
        def counted(*args, plain=getattr(jaccard, name)):
            rows = plain(*args)
            met.append(rows.count())
            return rows
        monkeypatch.setattr(jaccard, name, counted)
    docs = _family(random.Random(4), 300, 200)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = jaccard.near_duplicates(frame).collect()
    expected = brute.near_duplicates(docs)
    assert ordered(found) == ordered(expected)
    apart = len({c for _, _, c in expected})
    assert apart > 60
    # Shingle by shingle they were 337,045.
    assert len(met) == 2 and sum(met) < 40 * len(docs), (met, apart)


# Decontamination

ITEMS = [
    (1, " ".join(f"Wort{i}" for i in range(5, 30))),
    (2, "two-words"),
    (3, "mit license"),
    (4, None),
    (5, "!!"),
    (None, "one"),
    (6, "word the same word the same word the same word the same word the"),
    (11, "two words"),
]


@pytest.mark.parametrize("limit", [decontaminate.PASS_WORDS, 20])
def test_decontamination(spark, edge, pairs, limit):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.search(edge, items, pass_words=limit).select("doc_id", "found").collect()
    own = [
        (r.doc_id, r.found.n_words, {p for s in r.found.spans for p in range(s.begin, s.end)}, list(r.found["items"]))
        for r in found
    ]
    assert ordered(own) == ordered(brute.contamination(pairs, ITEMS))
    assert all(a.end < b.begin for r in found for a, b in zip(r.found.spans, r.found.spans[1:]))


@pytest.mark.parametrize("limit", [decontaminate.PASS_WORDS, 20])
def test_decontamination_beside_columns_of_its_own_names(spark, limit):
    docs = spark.createDataFrame([(1, "one two", "kept", 5)], "doc_id long, text string, found string, found_0 int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    row = decontaminate.search(docs, items, pass_words=limit).first()
    assert row.found_0 == 5 and row.found.n_words == 2 and [(s.begin, s.end) for s in row.found.spans] == [(0, 1)] and row.found["items"] == []
    other = decontaminate.search(docs, items, pass_words=limit, name="hits").first()
    assert other.found == "kept" and other.hits.n_words == 2


def test_shift_table_skips():
    table = decontaminate.Patterns(4, {tuple(b"a b c d".split()): [0]})
    assert table.shift == {(b"a", b"b"): 2, (b"b", b"c"): 1, (b"c", b"d"): 0} and table.far == 3
    assert list(table.find(b"x a b c d a b c d d".split())) == [(1, [0]), (5, [0])]


# Toxicity


def _labels(spark, found):
    return spark.createDataFrame(found, "doc_id long, toxic int, doc string")


def test_toxicity_of_awkward_documents(spark, edge):
    labels = _labels(spark, [(i, i % 2, "x") for i in range(20)] + [(None, 1, "x"), (3, None, "x"), (4, 7, "x"), (4, 0, "x")])
    model = toxicity.fit(edge, labels, F.lit(True))
    found = toxicity.score(edge, model, name="score").collect()
    assert len(found) == len(brute.rows()) and all(0 <= r.score <= 1 for r in found)
    nothing = toxicity.score(edge, toxicity.fit(edge, labels.limit(0), F.lit(True)), name="score")
    assert nothing.where("score > 0.001").count() == 0


def test_toxic_words_and_their_forms_are_found(spark):
    draw = random.Random(3)
    plain = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("n", "r", "st")]
    bad = ["zlukk" + e for e in ("an", "er", "ist", "o", "unde")]

    def sample(toxic: bool, words: list[str]) -> str:
        return " ".join(draw.choice(words) if toxic and draw.random() < 0.08 else draw.choice(plain) for _ in range(80))

    docs = [(i, sample(i % 4 == 0, bad[:3]), int(i % 4 == 0)) for i in range(400)]
    fresh = [(1000 + i, sample(i % 2 == 0, bad[3:]), int(i % 2 == 0)) for i in range(100)]
    train = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    model = toxicity.fit(train.select("doc_id", "text"), train.select("doc_id", "toxic"), F.lit(True))
    found = toxicity.score(spark.createDataFrame(fresh, "doc_id long, text string, toxic int"), model).collect()
    right = np.mean([(r.toxicity >= 0.5) == bool(r.toxic) for r in found])
    assert right >= 0.9


# Language


@pytest.mark.parametrize("case", ["no toxic row in the fold", "toxic rows in the fold alone", "toxic rows late in the fold"])
def test_few_toxic_labels_are_learned(spark, monkeypatch, case):
    monkeypatch.setattr(toxicity, "CALIBRATION_ROWS", 8)
    draw = random.Random(6)
    plain = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(50)]
    numbers = spark.range(4000).select("id", (F.pmod(F.xxhash64("id"), F.lit(toxicity.CALIBRATION_FOLDS)) == 0).alias("fold"))
    numbers = numbers.orderBy(F.xxhash64("id"), "id").collect()
    inside, outside = [r.id for r in numbers if r.fold], [r.id for r in numbers if not r.fold]
    toxic = {"no toxic row in the fold": outside[:6], "toxic rows in the fold alone": inside[:4], "toxic rows late in the fold": inside[100:103] + outside[:6]}[case]

    def words(kind: str) -> str:
        return " ".join([draw.choice(plain) for _ in range(40)] + [kind] * 6)

    ids = [*inside[:100], *outside[:100], *toxic]
    docs = [(i, words("zyxwvut" if i in toxic else "abcabc"), int(i in toxic)) for i in dict.fromkeys(ids)]
    train = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    model = toxicity.fit(train.select("doc_id", "text"), train.select("doc_id", "toxic"), F.lit(True))
    fresh = [(i, words("zyxwvut" if i < 20 else "abcabc")) for i in range(40)]
    found = {r.doc_id: r.toxicity for r in toxicity.score(spark.createDataFrame(fresh, "doc_id long, text string"), model).collect()}
    assert min(found[i] for i in range(20)) > max(found[i] for i in range(20, 40)) + 0.1


def test_language_of_awkward_documents(spark, edge):
    model = language.fit(edge, F.lit(True))
    assert model.languages == ["xx"]
    found = language.predict(edge, model).select("text", "language").collect()
    for r in found:
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.language.lang == "xx") == letter and 0 <= r.language.score <= 1
    none = language.predict(edge, language.fit(edge.limit(0), F.lit(True))).select("language.*").distinct().collect()
    assert {(r.lang, r.rejected) for r in none} == {("und", True)}


def test_language_held_out(spark, folder):
    docs = spark.read.parquet(f"{folder.replace('0.001', '0.01')}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = language.predict(docs.where(held), language.fit(docs, ~held)).where("lang is not null").collect()
    assert np.mean([r.lang == r.language.lang for r in found]) >= 0.97


# Quality


def test_quality_labels(spark, folder, edge):
    path = folder.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    known = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", F.col("quality").alias("good"))
    found = quality.score(docs, quality.fit(docs)).join(known, "doc_id").collect()
    assert np.mean([(r.quality.score >= 0.5) == bool(r.good) for r in found]) >= 0.88
    awkward = quality.score(edge, quality.fit(edge)).select("quality.*").collect()
    assert len(awkward) == len(brute.rows()) and all(0 <= r.score <= 1 for r in awkward)


def test_expectation_maximisation_finds_accuracies():
    draw = np.random.default_rng(1)
    good = draw.random(20_000) < 0.8
    votes = np.zeros((len(good), len(quality.HEURISTICS)), int)
    for i in range(votes.shape[1]):
        right = draw.random(len(good)) < (0.9 if i else 0.75)
        votes[:, i] = np.where(draw.random(len(good)) < 0.3, quality.ABSTAIN, np.where(right == good, quality.GOOD, quality.BAD))
    number = (votes * 3 ** np.arange(votes.shape[1])[::-1]).sum(1)
    labels = quality.expectation_maximisation(np.bincount(number, minlength=quality.PATTERNS))
    assert abs(labels.good - 0.8) < 0.02
    assert np.mean((labels.posterior[number] >= 0.5) == good) > 0.97


# Sharding


@pytest.mark.parametrize("limit", [500, 5000, 1 << 20])
def test_shards_fit(edge, limit):
    found = sharding.assign_shards(edge, limit).collect()
    assert len(found) == len(brute.rows())
    shards: dict = {}
    for r in found:
        shards.setdefault(r.shard, []).append(r)
    sums: dict = {}
    for name, members in shards.items():
        total = sum(r.n_bytes for r in members)
        assert {r.shard_bytes for r in members} == {total} and len(name) == members[0].shard_depth
        assert members[0].fits == (total <= limit)
        assert total <= limit or len({(r.doc_id, r.n_bytes) for r in members}) == 1
        for k in range(len(name)):
            sums[name[:k]] = sums.get(name[:k], 0) + total
    assert all(total > limit for total in sums.values())


def test_written_shards(spark, edge, tmp_path):
    sharding.write_shards(edge, str(tmp_path / "shards"), 5000)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert ordered(back.select(edge.columns).collect()) == ordered(edge.collect())
    assert back.select("shard").distinct().count() > 5


# Empty tables


def test_empty_tables(spark):
    docs = brute.empty_documents(spark)
    items = spark.createDataFrame([], "item_id long, text string")
    labels = _labels(spark, [])
    assert lines.dedup_lines(docs).count() == 0
    assert licenses.license_spans(docs).count() == 0
    assert sentencepiece.encode_documents(docs, MODEL).count() == 0
    assert jaccard.near_duplicates(docs).count() == 0
    assert decontaminate.search(docs, items).count() == 0
    assert sharding.assign_shards(docs).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, labels, F.lit(True))).count() == 0
    assert language.predict(docs, language.fit(docs, F.lit(True))).count() == 0
    assert quality.score(docs, quality.fit(docs)).count() == 0


def test_nothing_to_search_for(spark, edge):
    found = decontaminate.search(edge, spark.createDataFrame([], "item_id long, text string"))
    assert found.where("size(found.spans) > 0").count() == 0
