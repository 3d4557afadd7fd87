"""Full-text match of spend names against keywords: BM25, best hits per name.

A name and a keyword meet on a shared token. Joining on tokens alone would pair
every name that has a common token with every keyword that has it. So a name's
candidates come from two places, and together they always hold its true best hits:

* *Rare tokens* (in at most ``posting_limit`` keywords): all keywords with the token.
* *Common tokens*: the names' distinct profiles, a profile being a name's common tokens
  with their repeats, each with its best ``hits`` keywords on those tokens. A keyword outside is beaten by
  ``hits`` others, and these score at least as much on the full name, so it cannot be among the best hits.

A profile's best are found without a look at all keywords of its tokens. Keywords with the same common
tokens and weights form a class, of which the ``hits`` least ids suffice. The first classes of
each token give every profile a score that ``hits`` keywords reach. Tokens that cannot bring a keyword there
together, the most common ones, are not searched; of the others only blocks, the classes of one weight,
that can, given the most that the profile's other tokens add.

Scores are fixed-point integers (``SCALE`` per unit), so sums do not depend on
the order of their terms and equal scores are exactly equal.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendlake.fixed import BM25_B, BM25_K1, HITS_PER_NAME
from spendlake.functions.text import joined_phrases, tokens
from spendlake.operators.skew import spread_join
from spendlake.session import stored

SCALE = 1_000_000


@dataclass(frozen=True)
class SearchOptions:
    hits: int = HITS_PER_NAME
    stop_words: Sequence[str] = ()
    posting_limit: int = 100
    # A user dictionary: runs of tokens, joined by spaces, and the tokens that they count as.
    phrases: Mapping[str, str] = field(default_factory=dict)


def _token_counts(
    frame: DataFrame, key: str, text: str, options: SearchOptions, synonyms: DataFrame | None
) -> DataFrame:
    """``(key, length, token, times)``; ``synonyms`` (token, canonical) maps tokens to one spelling, after phrases."""
    listed = frame.select(key, tokens(F.col(text), options.stop_words).alias("listed"))
    listed = listed.select(key, joined_phrases(F.col("listed"), options.phrases).alias("listed"))
    rows = listed.select(key, F.size("listed").alias("length"), F.explode("listed").alias("token"))
    if synonyms is not None:
        rows = rows.join(synonyms.select("token", "canonical"), "token", "left").withColumn(
            "token", F.coalesce("canonical", "token")
        )
    return rows.groupBy(key, "length", "token").agg(F.count(F.lit(1)).alias("times"))


def keyword_postings(
    keywords: DataFrame, options: SearchOptions = SearchOptions(), synonyms: DataFrame | None = None
) -> DataFrame:
    """``(keyword_id, token, weight, df)``: the BM25 share of each token of each keyword.

    Token counts are stored, so the keywords are read once.
    """
    documents = keywords.select(F.col("consume_keyword_id").alias("keyword_id"), "consume_keyword")
    counts = _token_counts(documents, "keyword_id", "consume_keyword", options, synonyms)
    counts = stored(counts, "token-counts")
    size = F.struct(F.count_distinct("keyword_id").alias("n"), F.sum("times").alias("tokens"))
    corpus = counts.agg(size.alias("corpus")).scalar()
    spread = counts.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    known = spread_join(counts, spread, "token", spread, "df", F.col("keyword_id"))
    rarity = F.log(1 + (corpus["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    mean_length = corpus["tokens"] / corpus["n"]
    norm = BM25_K1 * (1 - BM25_B + BM25_B * F.col("length") / mean_length)
    share = rarity * (F.col("times") * (BM25_K1 + 1)) / (F.col("times") + norm)
    return known.select("keyword_id", "token", F.round(share * SCALE).cast("bigint").alias("weight"), "df")


def name_tokens(
    names: DataFrame, options: SearchOptions = SearchOptions(), synonyms: DataFrame | None = None
) -> DataFrame:
    """``(spent_name, token, times)`` of distinct names."""
    return _token_counts(names, "spent_name", "spent_name", options, synonyms).drop("length")


def keyword_match(
    names: DataFrame,
    keywords: DataFrame,
    options: SearchOptions = SearchOptions(),
    synonyms: DataFrame | None = None,
) -> DataFrame:
    """``(spent_name, keyword_id, score, hit_rank)``: at most ``hits`` keywords per name, best first.

    ``names`` holds distinct ``spent_name``. Its tokens and the postings are stored here, so each text
    is read once. Equal scores rank by keyword id.
    """
    wanted = stored(name_tokens(names, options, synonyms), "wanted")
    postings = stored(keyword_postings(keywords, options, synonyms), "postings")
    scored = _score_candidates(_candidates(wanted, postings, options), wanted, postings)
    order = W.partitionBy("spent_name").orderBy(F.desc("score"), "keyword_id")
    return scored.withColumn("hit_rank", F.row_number().over(order)).filter(F.col("hit_rank") <= options.hits)


def _rare_matches(wanted: DataFrame, postings: DataFrame, options: SearchOptions) -> DataFrame:
    """Each wanted token with every keyword that has it, for tokens in at most ``posting_limit`` keywords.

    So each wanted row meets a bounded number of keywords, and a token that most names share is spread.
    """
    rare = postings.filter(F.col("df") <= options.posting_limit).select("token", "keyword_id", "weight")
    return spread_join(wanted, rare, "token", _token_sizes(wanted), "rows", F.col("spent_name"))


def _token_sizes(wanted: DataFrame) -> DataFrame:
    return wanted.groupBy("token").agg(F.count(F.lit(1)).alias("rows"))


def _score(matches: DataFrame) -> DataFrame:
    return matches.groupBy("spent_name", "keyword_id").agg(F.sum(F.col("times") * F.col("weight")).alias("score"))


def _score_candidates(candidates: DataFrame, wanted: DataFrame, postings: DataFrame) -> DataFrame:
    return _score(candidates.join(wanted, "spent_name").join(postings, ["keyword_id", "token"]))


def _candidates(wanted: DataFrame, postings: DataFrame, options: SearchOptions) -> DataFrame:
    """Distinct ``(spent_name, keyword_id)`` that include every name's best hits."""
    spread = postings.groupBy("token").agg(F.first("df").alias("df"))
    common = spread.filter(F.col("df") > options.posting_limit)
    known = spread_join(wanted, common, "token", _token_sizes(wanted), "rows", F.col("spent_name"))
    item = F.struct("token", "times")
    profiled = known.groupBy("spent_name").agg(F.array_sort(F.collect_list(item)).alias("profile"))
    profiled = stored(profiled, "profiles")
    sizes = profiled.groupBy("profile").agg(F.count(F.lit(1)).alias("rows"))
    best = best_per_profile(sizes.select("profile"), postings.filter(F.col("df") > options.posting_limit), options.hits)
    from_common = spread_join(profiled, best, "profile", sizes, "rows", F.col("spent_name"))
    pair = ["spent_name", "keyword_id"]
    return _rare_matches(wanted, postings, options).select(pair).union(from_common.select(pair)).distinct()


def _classes(postings: DataFrame, hits: int) -> DataFrame:
    """(class, weights, ids): keywords with the same tokens and weights, by their least ``hits`` ids; ``class`` is the least."""
    item = F.struct("token", "weight")
    keywords = postings.groupBy("keyword_id").agg(F.array_sort(F.collect_list(item)).alias("weights"))
    place = F.row_number().over(W.partitionBy("weights").orderBy("keyword_id"))
    least = keywords.withColumn("place", place).filter(F.col("place") <= hits)
    ids = F.array_sort(F.collect_list("keyword_id"))
    return least.groupBy("weights").agg(F.min("keyword_id").alias("class"), ids.alias("ids"))


def _class_score(profile: str, weights: str) -> Column:
    """What a class has in common with a profile."""

    def own(item: Column) -> Column:
        met = F.filter(F.col(weights), lambda held: held["token"] == item["token"])
        return F.coalesce(item["times"] * F.get(met, F.lit(0))["weight"], F.lit(0))

    return F.aggregate(F.col(profile), F.lit(0).cast("bigint"), lambda total, item: total + own(item))


def _scored_classes(met: DataFrame, classes: DataFrame) -> DataFrame:
    """(profile, class, ids, score) of distinct pairs (profile, class)."""
    joined = met.select("profile", "class").distinct().join(classes, "class")
    return joined.select("profile", "class", "ids", _class_score("profile", "weights").alias("score"))


def _reached(asked: DataFrame, held: DataFrame, classes: DataFrame, hits: int) -> DataFrame:
    """(profile, reached): a score that ``hits`` keywords reach at least, 0 where so many were not seen."""
    place = F.row_number().over(W.partitionBy("token").orderBy(F.desc("weight"), "class"))
    champions = held.withColumn("place", place).filter(F.col("place") <= hits).select("token", "class")
    champions = stored(champions, "champions")  # so that both sides are shuffled, and a hot token can be split
    scored = _scored_classes(asked.select("profile", "token").join(champions, "token"), classes)
    upto = F.sum(F.size("ids")).over(W.partitionBy("profile").orderBy(F.desc("score"), "class"))
    enough = scored.withColumn("upto", upto).groupBy("profile")
    return enough.agg(F.coalesce(F.max(F.when(F.col("upto") >= hits, F.col("score"))), F.lit(0)).alias("reached"))


def _searched(asked: DataFrame, held: DataFrame, reached: DataFrame) -> DataFrame:
    """(profile, token, weight): the blocks in which a profile's best classes can be."""
    blocks = held.select("token", "weight").distinct()
    most = blocks.groupBy("token").agg(F.max("weight").alias("most"), F.collect_list("weight").alias("blocks"))
    able = asked.join(stored(most, "most-of-token"), "token").withColumn("able", F.col("times") * F.col("most"))
    # Tokens by what they can bring: the first ones, together too weak, are not searched.
    order = W.partitionBy("profile").orderBy("able", "token")
    total = F.sum("able").over(W.partitionBy("profile"))
    ranked = able.withColumns({"together": F.sum("able").over(order), "total": total}).join(reached, "profile")
    essential = ranked.filter(F.col("together") >= F.col("reached"))
    rest = F.col("total") - F.col("able")
    listed = essential.select("profile", "token", "times", "reached", rest.alias("rest"), F.explode("blocks").alias("weight"))
    return listed.filter(F.col("times") * F.col("weight") + F.col("rest") >= F.col("reached")).select("profile", "token", "weight")


def best_per_profile(profiles: DataFrame, postings: DataFrame, hits: int) -> DataFrame:
    """(profile, keyword_id): for each of the distinct profiles its best ``hits`` keywords of ``postings``."""
    classes = stored(_classes(postings, hits), "classes")
    held = classes.select("class", F.explode("weights").alias("item")).select("class", "item.*")
    asked = profiles.select("profile", F.explode("profile").alias("item")).select("profile", "item.*")
    asked = stored(asked, "asked")
    searched = _searched(asked, held, _reached(asked, held, classes, hits))
    scored = _scored_classes(searched.join(held, ["token", "weight"]), classes)
    first = W.partitionBy("profile").orderBy(F.desc("score"), "class")
    near = scored.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= hits)
    keywords = near.select("profile", "score", F.explode("ids").alias("keyword_id"))
    order = W.partitionBy("profile").orderBy(F.desc("score"), "keyword_id")
    ranked = keywords.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= hits)
    return ranked.select("profile", "keyword_id")
