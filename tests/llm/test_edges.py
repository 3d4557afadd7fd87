"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from spendlake.llm import (  # noqa: E402
    byte_bpe,
    html_text,
    importance,
    minhash,
    ngram_join,
    packing,
    prefix_forest,
    quality_rules,
    secrets,
    token_counts,
    url_filter,
)

LONG = "many different words in one long line " * 3000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, row_ int, key_ int, stats_ int"
LABELS = "doc_id long, quality int, toxic int"
WORD, BYTE, RANKS = (
    public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken")
)


def _row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), "x", 1, 2, 3)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [_row(1, None), _row(2, ""), _row(3, LONG), _row(3, LONG), _row(None, "a b"), _row(None, None, None, None)]
    rows += [_row(4, "Only a few words \U0001f600 é"), _row(5, "   \n\t ")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (None, 1, None), (4, 0, None), (4, None, 1)], LABELS)


DOC_OPERATORS = {
    "pack": lambda d, _: packing.pack(d, WORD),
    "secrets": lambda d, _: secrets.secret_scan(d),
    "dedup": lambda d, _: minhash.near_duplicates(d),
    "ngrams": lambda d, _: ngram_join.ngram_links(d),
    "counts": lambda d, _: token_counts.token_counts(d, BYTE),
    "rules": lambda d, _: quality_rules.quality_rules(d),
    "classifier": importance.quality_classifier,
    "bpe": lambda d, _: byte_bpe.encode_documents(d, RANKS),
}


@pytest.mark.parametrize("name", DOC_OPERATORS)
def test_every_row_has_a_result(docs, labels, name):
    found = DOC_OPERATORS[name](docs, labels).collect()
    ids = Counter(row.doc_id for row in (found if name != "pack" else [r for r in found if r.piece == 0]))
    assert ids == Counter([1, 2, 3, 3, None, None, 4, 5])


@pytest.mark.parametrize("name", DOC_OPERATORS)
def test_empty_table_gives_no_rows(docs, labels, name):
    assert DOC_OPERATORS[name](docs.limit(0), labels.limit(0)).collect() == []


@pytest.mark.parametrize("number", range(4))
def test_filtering_stages_keep_the_columns(spark, docs, labels, tmp_path, number):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stage = corpus_pipeline.STAGES[number][1]
    made = stage(spark, docs, str(tmp_path))
    assert made.dtypes == docs.dtypes
    made.collect()
    empty = stage(spark, docs.limit(0), str(tmp_path))
    assert empty.dtypes == docs.dtypes and empty.collect() == []


def test_masking_leaves_rows_without_secrets_alone(spark, docs):
    made = secrets.mask_secrets(docs)
    assert Counter(map(tuple, made.collect())) == Counter(map(tuple, docs.collect()))
    secret = spark.createDataFrame([_row(1, 'x password = "abcdefghijkl0123" y')], DOCS)
    assert secrets.mask_secrets(secret).first().text == 'x [SECRET]" y'


def test_near_copies_stay_once(spark):
    base = " ".join(f"w{i}" for i in range(400))
    near = base.replace("w200", "other")
    rows = [_row(7, base), _row(8, base.upper()), _row(9, near), _row(9, near), _row(None, base), _row(10, "w1 w2")]
    rows += [_row(11, None), _row(12, "")]
    docs = spark.createDataFrame(rows, DOCS)
    found = {(r.doc_id, r.class_id) for r in minhash.near_duplicates(docs).filter("doc_id is not null").collect()}
    first = min(c for d, c in found if d == 7)
    assert {(d, c) for d, c in found if d in (7, 8, 9)} == {(7, first), (8, first), (9, first)}
    assert {(d, c) for d, c in found if d > 9} == {(10, 10), (11, 11), (12, 12)}
    kept = [r.doc_id for r in minhash.keep_first(docs).collect()]
    assert len(kept) == 4 and {10, 11, 12} <= set(kept)


def test_embeddings(spark):
    schema = "vec_id long, embedding array<float>, label int, score int, rank int"
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0])]
    rows += [(6, [None, 1.0]), (None, [1.0, 1.0]), (100, [2.0, 0.0]), (200, None), (7, [1.0]), (1, [1.0, 0.0])]
    table = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], schema)
    found = prefix_forest.nearest_neighbours(table).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == [
        (0, 1, 1, 0.0),
        (0, 2, 1, 0.0),
        (0, 3, 100, 1.0),
        (0, 4, 2, 2**0.5),
        (100, 1, 0, 1.0),
        (100, 2, 1, 1.0),
        (100, 3, 1, 1.0),
        (100, 4, 2, 5**0.5),
    ]
    assert prefix_forest.nearest_neighbours(table.limit(0)).collect() == []


def test_unusable_vectors_are_not_sampled(spark, monkeypatch):
    monkeypatch.setattr(prefix_forest, "SAMPLE_ROWS", 2)
    schema = "vec_id long, embedding array<float>"
    hashed = spark.range(400).select("id", F.xxhash64("id").alias("hash")).orderBy("hash").collect()
    order = [r.id for r in hashed]
    bad = [[0.0, 0.0], [float("nan"), 1.0], [None, 1.0], [], None, [float("inf"), 1.0]]
    rows = [(i, bad[n % 6]) for n, i in enumerate(order[:60])] + [(order[0], [0.0, 0.0])] * 50
    good = [(i, [float(i), 1.0]) for i in order[60:]] + [(order[60], [float(order[60]), 1.0])] * 9
    found = prefix_forest.nearest_neighbours(spark.createDataFrame(rows + good, schema)).collect()
    asked = Counter(r.query_id for r in found)
    assert asked and set(asked) == {i for i, _ in good if i % 100 == 0} and set(asked.values()) == {10}
    assert prefix_forest.nearest_neighbours(spark.createDataFrame(rows, schema)).collect() == []


def test_neighbours_do_not_follow_the_length_of_batches(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").coalesce(1)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old, found = spark.conf.get(setting), []
    for rows in ("10000", "33"):
        spark.conf.set(setting, rows)
        found.append(sorted(map(tuple, prefix_forest.nearest_neighbours(table).collect())))
    spark.conf.set(setting, old)
    assert found[0] == found[1]


def test_pages(spark):
    schema = "page_id long, url string, html string, text int, host int, label int"
    page = "<article><h1>A title</h1><p>Some text &amp; more of it that goes on.</p></article>"
    rows = [(1, None, None), (2, "", ""), (3, "x://Foo.Org/ES/?a#b", page * 500), (None, "http://A.COM", page)]
    rows += [(4, "http://a.example.org/en/12", "<p>no end <b"), (4, "http://a.example.org/en/12", "<p>no end <b")]
    table = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], schema)
    texts = html_text.html_text(table).collect()
    assert Counter(r.page_id for r in texts) == Counter([1, 2, 3, None, 4, 4])
    assert all(r.n_chars == len(r.text) for r in texts)
    assert {r.text for r in texts if r.page_id in (1, 2)} == {""}
    judged = url_filter.url_filter(table)
    found = {(r.page_id, r.host, r.path, r.rule) for r in judged.collect()}
    assert found == {
        (1, "", "", None),
        (2, "", "", None),
        (3, "foo.org", "/ES/", "org/"),
        (None, "a.com", "", None),
        (4, "a.example.org", "/en/12", "example.org/en/1"),
    }
    assert judged.count() == 6 and judged.filter("verdict is null").count() == 0
    assert html_text.html_text(table.limit(0)).collect() == []
    assert url_filter.url_filter(table.limit(0)).collect() == []


@pytest.mark.parametrize("copies", [1, 60])
def test_url_sample_has_both_verdicts(spark, monkeypatch, copies):
    monkeypatch.setattr(url_filter, "MAX_TRAINING_ROWS", 40)
    ends = [f"https://a{i}.{end}" for i in range(100) for end in ("org/x", "com/de/x")]
    hashed = spark.createDataFrame([(u,) for u in ends], "url string").withColumn("hash", F.xxhash64("url"))
    ordered = [r.url for r in hashed.orderBy("hash").collect()]
    if copies == 1:  # the least hashes are all of one verdict
        first = [u for u in ordered if "org" in u][:40]
        urls = first + [u for u in ordered[ordered.index(first[-1]) + 1 :] if "com" in u]
        assert any("com" in u for u in urls)
    else:  # one URL is more than the sample
        urls = ordered[:1] * copies + ordered[1:]
    rows = [(i, u) for i, u in enumerate([*urls, "http://b.net/q"])]
    found = url_filter.url_filter(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert len(found) == len(rows) and all(r.p_block is not None for r in found)


def test_kth_largest_with_ties(spark):
    values = [5, -7, 5, 5, 2**40, -(2**40), 0, None]
    table = spark.createDataFrame([(v,) for v in values], "v long")
    ordered = sorted((v for v in values if v is not None), reverse=True)
    assert [importance.kth_largest(table, "v", k) for k in range(1, 8)] == ordered
    assert importance.kth_largest(table, "v", 8) is None


def test_gumbel_noise_is_fixed(docs):
    drawn = docs.select(importance.gumbel().alias("g")).filter(F.col("g").isNotNull())
    assert sorted(r.g for r in drawn.collect()) == sorted(r.g for r in drawn.collect())
    assert drawn.count() == 8
