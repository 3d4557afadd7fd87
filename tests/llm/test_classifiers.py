"""The quality classifier and the URL filter on whole tables, against plain Python."""

from __future__ import annotations

import math
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from spendlake.llm import importance, minhash  # noqa: E402
from spendlake.llm.queries import QUERIES  # noqa: E402
from spendlake.llm.texthash import Texts, mix, windows  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def _word_hash(word, known={}):  # noqa: B006
    if word not in known:
        texts = Texts(pa.array([word]))
        starts, ends, _ = texts.words()
        known[word] = texts.hash_slices(starts, ends)[0]
    return known[word]


def _buckets(text):
    """Bucket of every unigram and bigram, word by word."""
    words = [np.array([_word_hash(w)]) for w in text.lower().split()]
    found = [int(mix(w)[0]) >> 48 for w in words]
    return found + [int(windows(np.concatenate(pair), 2)[0]) >> 48 for pair in zip(words, words[1:], strict=False)]


@pytest.fixture(scope="module")
def plain_draw(spark):
    """doc_id -> (log weight, features, score) and the size of the draw, from dictionaries of counts."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    noise = {r.doc_id: r.g for r in docs.select("doc_id", importance.gumbel().alias("g")).collect()}
    taught = {r.target_id: r.taught for r in importance.target_ids(labels).collect()}
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic}
    assert set(taught) == good
    buckets = {r.doc_id: _buckets(r.text or "") for r in docs.collect()}
    raw, target = Counter(), Counter()
    for doc_id, own in buckets.items():
        raw.update(own)
        if taught.get(doc_id):
            target.update(own)
    raw_total, total = sum(raw.values()), sum(target.values())
    mixed = importance.SMOOTH_SHARE * total + importance.SMOOTH_FEATURES
    ratio = {b: math.log((target[b] + mixed * n / raw_total) / (total + mixed) / (n / raw_total)) for b, n in raw.items()}
    found, means = {}, {}
    for doc_id, own in buckets.items():
        weight = sum(ratio[b] for b in own)
        if own:
            means[doc_id] = weight / (len(own) + importance.NEUTRAL_FEATURES)
        score = (means[doc_id] * importance.PSEUDO_LENGTH + noise[doc_id]) * 2**20 if own else None
        found[doc_id] = (weight, len(own), score)
    unseen = [means[d] for d, t in taught.items() if not t and d in means]
    margin = importance.MARGIN / max(1.0, len(unseen) * importance.TARGET_LOSS) ** 0.5
    lowest = float(np.percentile(unseen, importance.TARGET_LOSS * 100)) - margin
    return found, sum(mean >= lowest for mean in means.values())


def test_weights_and_draw_equal_plain_counts(spark, plain_draw):
    wanted, size = plain_draw
    rows = {r.doc_id: r for r in QUERIES["op8_quality_classifier"](spark, FOLDER).collect()}
    assert set(rows) == set(wanted)
    for doc_id, (weight, features, score) in wanted.items():
        row = rows[doc_id]
        assert row.n_features == features and row.log_weight == pytest.approx(weight, rel=1e-4, abs=1e-3)
        assert (row.score is None) == (score is None)
        if score is not None:
            assert row.score / 2**20 == pytest.approx(score / 2**20, rel=1e-4, abs=1e-3)
    first = sorted((d for d in wanted if wanted[d][2] is not None), key=lambda d: -rows[d].score)[:size]
    cut = rows[first[-1]].score
    assert {d for d, r in rows.items() if r.drawn} == {d for d, r in rows.items() if r.score is not None and r.score >= cut}
    assert 0 < size < len(wanted)


def test_the_stage_keeps_what_is_drawn(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    drawn = {r.doc_id for r in QUERIES["op8_quality_classifier"](spark, FOLDER).filter("drawn").collect()}
    kept = corpus_pipeline.drawn_text(spark, docs, FOLDER)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == drawn


# Rules and verdicts as the contract writes them: the host's end, the path's beginning.
_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def _judged(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in _RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_every_page_has_its_host_path_rule_and_verdict(spark, folder):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()}
    rows = QUERIES["op9_url_filter"](spark, folder).collect()
    assert Counter(r.page_id for r in rows) == Counter(list(urls))
    ruled = 0
    for row in rows:
        host, path, rule, verdict = _judged(urls[row.page_id])
        assert (row.host, row.path, row.rule) == (host, path, rule)
        if verdict:
            ruled += 1
            assert row.verdict == verdict
        else:
            assert row.p_block is not None and row.verdict == ("block" if row.p_block >= 0.5 else "allow")
    assert 0 < ruled < len(rows)


DOCS = "doc_id long, text string, source string"


def test_one_doc_id_with_several_texts_keeps_them_all(spark):
    first, second = (" ".join(f"{letter}{i}" for i in range(60)) for letter in "ab")
    rows = [(1, first, "x"), (1, second, "y"), (2, first, "z"), (3, second + " end", "w"), (4, "c d", "v")]
    docs = spark.createDataFrame(rows, DOCS)
    kept = minhash.keep_first(docs).collect()
    assert len(kept) == 3 and (4, "c d", "v") in set(map(tuple, kept))
    texts = {r.text for r in kept}
    assert first in texts and (second in texts or second + " end" in texts)
    classes = {(r.doc_id, r.class_id) for r in minhash.near_duplicates(docs).collect()}
    assert {c for d, c in classes if d == 2} <= {c for d, c in classes if d == 1}
    assert len({c for _, c in classes}) == 3


def test_which_of_repeated_rows_stays_does_not_follow_their_order(spark):
    rows = [(7, "some words that repeat here", f"s{i}") for i in range(40)]
    found = set()
    for seed in (1, 2, 3):
        docs = spark.createDataFrame(rows, DOCS).repartition(5).orderBy(F.rand(seed))
        (kept,) = minhash.keep_first(docs).collect()
        found.add(kept.source)
    assert len(found) == 1
