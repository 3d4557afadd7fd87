from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from functools import reduce

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spendlake.functions.text import joined_phrases, tokens
from spendlake.operators.classify import classify_names
from spendlake.operators import search
from spendlake.operators.search import SCALE, SearchOptions, keyword_match
from spendlake.operators.skew import heavy_keys, spread_join

KEYWORD = (
    "consume_keyword_id bigint, consume_keyword string, keyword_weight int, consume_keyword_type_id bigint, "
    "consume_keyword_type string"
)


def keywords(spark, *items):
    """``(id, text, weight)``; the category is named after the id."""
    return spark.createDataFrame([(i, text, weight, i, f"type {i}") for i, text, weight in items], KEYWORD)


def names(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "spent_name string")


def brute_force(name_list, keyword_list, hits):
    """Every name against every keyword."""
    documents = {key: Counter(text.split()) for key, text, _ in keyword_list}
    n = len(documents)
    mean = sum(sum(d.values()) for d in documents.values()) / n
    df = Counter(token for d in documents.values() for token in d)
    weight = defaultdict(int)
    for key, document in documents.items():
        length = sum(document.values())
        for token, tf in document.items():
            idf = math.log(1 + (n - df[token] + 0.5) / (df[token] + 0.5))
            weight[key, token] = round(SCALE * idf * (tf * 2.2) / (tf + 1.2 * (1 - 0.75 + 0.75 * length / mean)))
    found = set()
    for name in name_list:
        wanted = Counter(name.split())
        scores = [(-sum(times * weight[key, t] for t, times in wanted.items() if t in documents[key]), key)
                  for key in documents if wanted.keys() & documents[key].keys()]
        for rank, (score, key) in enumerate(sorted(scores)[:hits], start=1):
            found.add((name, key, -score, rank))
    return found


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "options",
    [
        SearchOptions(hits=3),
        SearchOptions(hits=3, posting_limit=4),
        SearchOptions(hits=2, posting_limit=1),
        SearchOptions(hits=4, posting_limit=10),
    ],
)
def test_common_tokens_do_not_change_the_hits(spark, seed, options):
    dice = random.Random(seed)
    vocabulary = ["the", "of"] * 8 + ["a", "b", "c", "d"] * 3 + [f"w{i}" for i in range(20)]
    text = lambda longest: " ".join(dice.choice(vocabulary) for _ in range(dice.randint(1, longest)))
    keyword_list = [(i, text(6), 1) for i in range(60)]
    name_list = sorted({text(8) for _ in range(40)})
    found = keyword_match(names(spark, *name_list), keywords(spark, *keyword_list), options)
    columns = ("spent_name", "keyword_id", "score", "hit_rank")
    assert set(rows(found, *columns)) == brute_force(name_list, keyword_list, options.hits)


@pytest.mark.parametrize("shared", ["the the", "a b c d e f g h i"])
def test_candidates_do_not_pair_all_names_with_all_keywords(spark, shared):
    options = SearchOptions(hits=3, posting_limit=5)
    name_frame = spark.range(100).select(F.concat(F.lit(f"{shared} n"), F.col("id")).alias("spent_name"))
    keyword_frame = spark.range(500).select(
        F.col("id").alias("consume_keyword_id"), F.concat(F.lit(f"{shared} k"), F.col("id")).alias("consume_keyword")
    )
    wanted, postings = search.name_tokens(name_frame, options), search.keyword_postings(keyword_frame, options)
    assert search._candidates(wanted, postings, options).count() == 100 * 3


def test_profiles_that_differ_do_not_meet_all_keywords(spark):
    options = SearchOptions(posting_limit=50)
    texts = [f"pay s{a} s{b}" for a in range(20) for b in range(a)]
    name_frame = names(spark, *texts)
    keyword_frame = spark.range(2000).select(
        F.col("id").alias("consume_keyword_id"),
        F.concat(F.lit("pay s"), F.col("id") % 20, F.lit(" u"), F.col("id")).alias("consume_keyword"),
    )
    wanted, postings = search.name_tokens(name_frame, options), search.keyword_postings(keyword_frame, options)
    common = postings.filter(F.col("df") > options.posting_limit)
    item = F.struct("token", "times")
    profiles = wanted.groupBy("spent_name").agg(F.array_sort(F.collect_list(item)).alias("profile")).select("profile")
    classes = search._classes(common, options.hits)
    held = classes.select("class", F.explode("weights").alias("item")).select("class", "item.*")
    asked = profiles.select("profile", F.explode("profile").alias("item")).select("profile", "item.*")
    reached = search._reached(asked, held, classes, options.hits)
    met = search._searched(asked, held, reached).join(held, ["token", "weight"])
    # Of 2,000 keywords that share a token with every name each name meets two classes.
    assert classes.count() == 20 and met.count() == 2 * len(texts)
    found = keyword_match(name_frame, keyword_frame, options)
    keyword_list = [(i, f"pay s{i % 20} u{i}", 1) for i in range(2000)]
    assert set(rows(found, "spent_name", "keyword_id", "score", "hit_rank")) == brute_force(texts, keyword_list, 10)


def verdict(spark, name, *items):
    frame = classify_names(names(spark, name), keywords(spark, *items))
    return rows(frame, "consume_keyword_type_id", "consume_keyword_type", "consume_keyword", "keyword_weight")


def test_name_without_a_shared_token_gets_the_default(spark):
    assert verdict(spark, "zebra", (1, "red bolt", 3)) == [(20, "etc", "zebra", 0)]


def test_weight_zero_leaves_edit_distance_alone(spark):
    assert verdict(spark, "red bolt", (1, "red bolts", 0), (2, "red boltings", 0))[0][0] == 1


def test_among_equal_combined_scores_the_worst_hit_wins(spark):
    # Without weight both are one edit away; the shorter keyword is the better hit.
    frame = classify_names(names(spark, "red bolt"), keywords(spark, (1, "red bolta", 0), (2, "red boltb", 0)))
    assert rows(frame, "consume_keyword_type_id") == [(2,)]


def test_characters_are_counted_not_bytes(spark):
    frame = classify_names(names(spark, "네이버페이"), keywords(spark, (1, "네이버페이 결제", 0)))
    assert rows(frame, "combined_score") == [(3,)]


def test_stop_words_and_synonyms(spark):
    held = keywords(spark, (1, "shop", 1), (2, "the bakery", 1))
    synonyms = spark.createDataFrame([("store", "shop")], "token string, canonical string")
    hits = keyword_match(names(spark, "the store"), held, SearchOptions(stop_words=("the",)), synonyms)
    assert rows(hits, "keyword_id") == [(1,)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_a_plain_join_with_a_hot_key(spark, how):
    facts = spark.range(30_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k")
    )
    other = spark.range(0, 4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    sizes = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    spread = spread_join(facts, other, "k", sizes, "n", F.col("id"), how)
    plain = facts.join(other, "k", how).select("id", "k", "v")
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()
    assert rows(heavy_keys(sizes, "k", "n"), "k") == [(7,)]


def test_no_python_and_no_cartesian_product_in_the_plan(spark):
    options = SearchOptions(posting_limit=1)
    frame = keyword_match(names(spark, "a b", "b c"), keywords(spark, (1, "a b", 1), (2, "b d", 1)), options)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in ("Python", "Cartesian", "NestedLoop") if node in plan]


def test_union_of_names_is_judged_by_name_only(spark):
    held = keywords(spark, (1, "red bolt", 2), (2, "blue ring", 1))
    apart = [classify_names(names(spark, n), held) for n in ("red ring", "blue bolt")]
    together = classify_names(names(spark, "red ring", "blue bolt"), held)
    assert rows(reduce(lambda a, b: a.union(b), apart)) == rows(together)


def test_the_longest_phrase_from_the_left_counts(spark):
    phrases = {"a b": "ab", "a b c": "abc x", "b c": "bc", "c d": "cd", "e": "ee"}
    wanted = {"a b": ["ab"], "a b c": ["abc", "x"], "a b d": ["ab", "d"], "z b c d": ["z", "bc", "d"], "a a b": ["a", "ab"],
              "e a": ["ee", "a"], "": [], "a": ["a"], "a b c d": ["abc", "x", "d"]}
    frame = names(spark, *wanted).withColumn("listed", tokens(F.col("spent_name")))
    found = frame.select("spent_name", joined_phrases(F.col("listed"), phrases).alias("made"))
    assert {row.spent_name: row.made for row in found.collect()} == wanted
    with pytest.raises(ValueError, match="at most"):
        joined_phrases(F.col("listed"), {f"w{i}": "w" for i in range(1001)})


def test_phrases_count_in_names_and_keywords(spark):
    held = keywords(spark, (1, "new york pizza", 1), (2, "york ham", 1))
    options = SearchOptions(phrases={"new york": "nyc", "big apple": "nyc"})
    assert rows(keyword_match(names(spark, "big apple"), held, options), "keyword_id") == [(1,)]
    assert rows(keyword_match(names(spark, "york"), held, options), "keyword_id") == [(2,)]
