"""Quality rules whose thresholds follow the corpus.

Every text is measured; the measures of each language and source go into mergeable
quantile sketches, and the sketches, a source's own blended with its language's, give each language
and source its own fences in place of fixed cutoffs. Sketches are integer histograms with about 1/16 relative width, so that
partial sketches add up to the same counts in whatever order tasks merge them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from spendlake.llm.batches import short_batches
from spendlake.llm.texthash import Texts, pieces, text_of, windows
from spendlake.session import stored

SYMBOLS = b"#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# A source's sketch is blended with that of its whole language, which weighs as much as so many of its texts.
PRIOR_TEXTS = 200

# Fences lie so many interquartile ranges beyond the quartiles, and the slack (in thousandths) beyond that.
FENCE_RANGES = 3
SLACK = {"symbols": 150, "repeats": 350, "dup_lines": 60, "word_length": 2000}
TWO_SIDED = ("word_length",)

STATS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
)


def _repeat_words(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, its words in windows of three that occur twice or more in it."""
    count = len(bounds) - 1
    owner = text_of(bounds)
    grams = windows(hashes, 3)
    first = np.flatnonzero(owner[: len(grams)] == owner[2:]) if len(grams) else np.empty(0, np.int64)
    order = first[np.lexsort((grams[first], owner[first]))]
    same = (grams[order][1:] == grams[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    marked = np.zeros(len(hashes) + 2, bool)
    for place in range(3):
        marked[order[twice] + place] = True
    return np.bincount(owner[marked[: len(hashes)]], minlength=count)


def _dup_lines(texts: Texts) -> np.ndarray:
    starts, ends, owner = texts.lines()
    hashes = texts.hash_slices(starts, ends)
    order = np.lexsort((hashes, owner))
    same = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.bincount(owner[order[1:][same]], minlength=texts.count)


def measure(array: pa.Array) -> pa.StructArray:
    """The five measures of each text of an Arrow array."""
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True
    found: list[np.ndarray] = []
    for start, end in pieces(array):
        texts = Texts(array.slice(start, end - start))
        starts, ends, bounds = texts.words()
        begins_char = (texts.bytes & 0xC0) != 0x80
        chars = texts.totals(begins_char & texts._in_word)
        repeats = _repeat_words(texts.hash_slices(starts, ends), bounds)
        found.append(
            np.stack([np.diff(bounds), chars, texts.totals(is_symbol[texts.bytes]), _dup_lines(texts), repeats])
        )
    table = np.concatenate(found, axis=1) if found else np.zeros((5, 0))
    return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in table], names=STATS.fieldNames())


def stats_of(text: Column | str) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; null text has none of each.

    It is called nondeterministic only so that a filter on the measures is not pushed below it as
    a second call, with a second Python worker in the same task.
    """
    udf = F.arrow_udf(lambda array: measure(array), returnType=STATS).asNondeterministic()
    return udf(text)


def _measures() -> dict[str, Column]:
    per_word = {"symbols": "n_symbols", "repeats": "n_repeat_words", "dup_lines": "n_dup_lines", "word_length": "word_chars"}
    words = F.nullif(F.col("n_words"), F.lit(0))
    return {name: F.floor(F.col(column) * 1000 / words).cast("long") for name, column in per_word.items()}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def bucket(value: Column) -> Column:
    """Number of the sketch cell of a whole number from 0: its leading five bits and how many follow."""
    shift = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    return shift * 64 + F.floor(value / F.pow(F.lit(2.0), shift)).cast("int")


def bucket_floor(cell: Column) -> Column:
    """Smallest value of a cell."""
    return (F.pmod(cell, F.lit(64)) * F.pow(F.lit(2.0), F.floor(cell / 64))).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """Cells and counts per (lang, source, measure); sketches of parts of the corpus add up."""
    table = measured.filter(~base_failed()).select(
        "lang",
        "source",
        F.explode(F.create_map(*[c for n, v in _measures().items() for c in (F.lit(n), v)])).alias("measure", "value"),
    )
    return table.groupBy("lang", "source", "measure", bucket(F.col("value")).alias("cell")).agg(F.count("*").alias("n"))


def _blended(cells: DataFrame) -> DataFrame:
    """Cells per (lang, source, measure): the source's own, and PRIOR_TEXTS spread over its language's as that is.

    Counts are multiplied by the size of the language's sketch, so that they stay whole numbers.
    """
    cells = stored(cells, "quality-cells")  # a few for each source, read three times
    exact = "decimal(18,0)"
    merged = cells.groupBy("lang", "measure", "cell").agg(F.sum("n").alias("n"))
    sizes = merged.groupBy("lang", "measure").agg(F.sum("n").alias("size"))
    language = merged.select(F.col("lang").alias("of_lang"), F.col("measure").alias("of"), "cell", F.col("n").alias("prior"))
    groups = cells.select("lang", "source", "measure").distinct()
    spread = groups.join(language, groups.lang.eqNullSafe(language.of_lang) & (groups.measure == language.of))
    prior = spread.select("lang", "source", "measure", "cell", (F.col("prior").cast(exact) * PRIOR_TEXTS).alias("n"))
    total = sizes.select(F.col("lang").alias("of_lang"), F.col("measure").alias("of"), "size")
    sized = cells.join(total, cells.lang.eqNullSafe(total.of_lang) & (cells.measure == total.of))
    own = sized.select("lang", "source", "measure", "cell", (F.col("n").cast(exact) * F.col("size").cast(exact)).alias("n"))
    both = own.unionByName(prior)
    return both.groupBy("lang", "source", "measure", "cell").agg(F.sum("n").alias("n"))


def _quartiles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """First and third quartile of each sketch, read off its cells."""
    whole = Window.partitionBy(*keys)
    ranked = cells.withColumn("upto", F.sum("n").over(whole.orderBy("cell"))).withColumn("size", F.sum("n").over(whole))
    value = bucket_floor(F.col("cell"))
    return ranked.groupBy(*keys).agg(
        F.min(F.when(F.col("upto") * 4 >= F.col("size"), value)).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("size") * 3, value)).alias("q3"),
    )


def fences(cells: DataFrame) -> DataFrame:
    """Lowest and highest accepted value per (lang, source), as columns low_* and high_*."""
    quartiles = _quartiles(_blended(cells), ["lang", "source", "measure"])
    first, third = F.col("q1"), F.col("q3")
    slack = F.element_at(F.create_map(*[F.lit(x) for item in SLACK.items() for x in item]), F.col("measure"))
    spread = (third - first) * FENCE_RANGES + slack
    limits = quartiles.select("lang", "source", "measure", (first - spread).alias("low"), (third + spread).alias("high"))
    picks = [F.max(F.when(F.col("measure") == n, F.col("high"))).alias(f"high_{n}") for n in SLACK]
    picks += [F.min(F.when(F.col("measure") == n, F.col("low"))).alias(f"low_{n}") for n in TWO_SIDED]
    return limits.groupBy("lang", "source").agg(*picks)


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds base_failed and kept. Rows of a language and source without a fence pass on the base rules alone."""
    of = limits.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    same = measured.lang.eqNullSafe(of.of_lang) & measured.source.eqNullSafe(of.of_source)
    values = _measures()
    inside = F.lit(True)
    for name in SLACK:
        inside = inside & F.coalesce(values[name] <= F.col(f"high_{name}"), F.lit(True))
    for name in TWO_SIDED:
        inside = inside & F.coalesce(values[name] >= F.col(f"low_{name}"), F.lit(True))
    joined = measured.join(of, same, "left").withColumn("base_failed", base_failed())
    keep = list(measured.columns)
    return joined.withColumn("kept", ~F.col("base_failed") & inside).select(*keep, "base_failed", "kept")


def with_stats(docs: DataFrame) -> DataFrame:
    return docs.withColumn("stats_", stats_of("text")).select(
        *[F.col(c) for c in docs.columns], *[F.col("stats_")[n].alias(n) for n in STATS.fieldNames()]
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, source): the measures, base_failed and kept.

    A null or empty text has no words and fails the base rules. Null languages and sources form
    groups of their own. Repeated rows each give a row; other columns are left out. No rows give none.
    """
    short_batches(docs)
    measured = stored(with_stats(docs.select("doc_id", "text", "lang", "source")).drop("text"), "quality-stats")
    limits = fences(sketches(measured))
    return judge(measured, limits).select("doc_id", *STATS.fieldNames(), "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    short_batches(docs)
    cells = sketches(with_stats(docs.select("text", "lang", "source")).drop("text"))
    limits = stored(fences(cells), "quality-fences")
    rows = docs.select(F.struct("*").alias("row_")).withColumn("stats_", stats_of("row_.text"))
    measured = rows.select("row_", "row_.lang", "row_.source", "stats_.*")
    return judge(measured, limits).filter("kept").select("row_.*")
