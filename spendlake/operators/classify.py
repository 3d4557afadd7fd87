"""Category of a spend name: best keyword by search score, weight and edit distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.fixed import DEFAULT_TYPE, DEFAULT_TYPE_ID, DEFAULT_WEIGHT
from spendlake.operators.search import SCALE, SearchOptions, keyword_match
from spendlake.operators.skew import spread_join


def classify_names(
    names: DataFrame,
    keywords: DataFrame,
    options: SearchOptions = SearchOptions(),
    synonyms: DataFrame | None = None,
) -> DataFrame:
    """One row per distinct ``spent_name`` with its keyword, category and combined score.

    ``names`` should be a stored table, as for ``keyword_match``.

    Combined score = edit distance minus the whole part of score times weight; the
    lowest wins and among equals the worst-ranked hit. Edit distance is taken on the
    few best hits only. A name without hits gets the default category.
    """
    hits = keyword_match(names, keywords, options, synonyms)
    documents = keywords.withColumnRenamed("consume_keyword_id", "keyword_id")
    weighed = F.expr(f"(score * keyword_weight) div {SCALE}")
    distance = F.levenshtein("consume_keyword", "spent_name").cast("bigint")
    judged = hits.join(documents, "keyword_id").withColumn("combined", distance - weighed)
    verdict = F.struct(
        "consume_keyword_type_id", "consume_keyword_type", "consume_keyword", "keyword_weight", "combined"
    )
    best = judged.groupBy("spent_name").agg(
        F.min_by(verdict, F.struct(F.col("combined"), -F.col("hit_rank"))).alias("verdict")
    )
    return names.join(best, "spent_name", "left").select(
        "spent_name",
        F.coalesce("verdict.consume_keyword_type_id", F.lit(DEFAULT_TYPE_ID).cast("bigint")).alias(
            "consume_keyword_type_id"
        ),
        F.coalesce("verdict.consume_keyword_type", F.lit(DEFAULT_TYPE)).alias("consume_keyword_type"),
        F.coalesce("verdict.consume_keyword", "spent_name").alias("consume_keyword"),
        F.coalesce("verdict.keyword_weight", F.lit(DEFAULT_WEIGHT)).alias("keyword_weight"),
        F.col("verdict.combined").alias("combined_score"),
    )


def reclassify(
    spends: DataFrame, verdicts: DataFrame, names: DataFrame, with_type_name: bool = False
) -> DataFrame:
    """Spends with the category of their name; ``names`` counts the spends (``rows``) per name.

    Verdicts are unique by name, so rows neither vanish nor multiply; a spend without
    a name gets the default category.
    """
    default = {"consume_keyword_type_id": F.lit(DEFAULT_TYPE_ID).cast("bigint")}
    if with_type_name:
        default["consume_keyword_type"] = F.lit(DEFAULT_TYPE)
    kept = [name for name in spends.columns if name not in default]
    found = spread_join(
        spends.select(kept),
        verdicts.select("spent_name", *default),
        "spent_name",
        names,
        "rows",
        F.col("spent_idx"),
        "left",
    )
    return found.withColumns({name: F.coalesce(name, value) for name, value in default.items()}).select(spends.columns)
