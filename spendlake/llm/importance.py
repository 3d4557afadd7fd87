"""Quality classifier by importance resampling.

Two generative models over hashed unigrams and bigrams: one of the target (labelled good
text), one of the raw corpus. The log ratio of a document under both is its importance
weight, and Gumbel top-k draws documents without replacement in proportion to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm.batches import short_batches
from spendlake.llm.texthash import Texts, mix, pieces, text_of, windows
from spendlake.session import stored

BUCKETS = 1 << 16

# The target model comes from every other one of at most this many labelled rows, and the size of
# the draw from the others, which the model has not seen.
MAX_TARGET_ROWS = 40_000

# The draw is as large as the number of documents whose mean weight per feature is no lower than
# that of all but this share of the unseen target rows, less the margin. The margin is for a share
# of at most one row; from more rows on it falls as the error of a quantile does.
TARGET_LOSS = 0.002
MARGIN = 0.05

# Means of few features scatter widely, so each has so many features of weight 0 besides its own.
NEUTRAL_FEATURES = 20

# Long and short texts count alike: as so many features of their mean weight.
PSEUDO_LENGTH = 200

# The target model is mixed with so much of the raw one: a share of its features, and so many at least.
SMOOTH_SHARE = 0.02
SMOOTH_FEATURES = 50_000

SEED = 20240611

WEIGHT = T.StructType([T.StructField("log_weight", T.DoubleType()), T.StructField("n_features", T.LongType())])


def _features(array: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Bucket and text of every unigram and bigram of lower-case words."""
    texts = Texts(pc.utf8_lower(array))
    starts, ends, bounds = texts.words()
    words = texts.hash_slices(starts, ends)
    owner = text_of(bounds)
    pairs = windows(words, 2)
    whole = owner[: len(pairs)] == owner[1 : len(pairs) + 1]
    hashes = np.concatenate([mix(words), pairs[whole]])
    return (hashes >> np.uint64(48)).astype(np.int64), np.concatenate([owner, owner[: len(pairs)][whole]]), texts.count


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature counts of a task: (bucket, raw, target)."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        texts, flags = batch.column(0), np.asarray(batch.column(1).to_numpy(zero_copy_only=False), dtype=bool)
        for start, end in pieces(texts):
            buckets, owners, _ = _features(texts.slice(start, end - start))
            raw += np.bincount(buckets, minlength=BUCKETS)
            target += np.bincount(buckets[flags[start:end][owners]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    arrays = [pa.array(x) for x in (used, raw[used], target[used])]
    yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "raw", "target"])


def target_ids(labels: DataFrame) -> DataFrame:
    """doc_id of labelled good, not toxic rows, those of least hash, at most MAX_TARGET_ROWS; half of them for the model."""
    good = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    chosen = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TARGET_ROWS)
    return chosen.select(F.col("doc_id").alias("target_id"), (F.xxhash64("doc_id", F.lit(SEED)) % 2 == 0).alias("taught"))


def log_ratios(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Per bucket the log ratio of the target model to the raw one; counts over all rows of ``docs``."""
    flags = F.broadcast(ids.filter("taught"))  # MAX_TARGET_ROWS at most
    flagged = docs.join(flags, F.col("doc_id") == F.col("target_id"), "left")
    parts = flagged.select("text", F.col("target_id").isNotNull().alias("target")).mapInArrow(
        _counted, "bucket long, raw long, target long"
    )
    rows = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)  # BUCKETS rows at most
    for row in rows:
        raw[row.bucket], target[row.bucket] = row.raw, row.target
    if not target.any():
        return np.zeros(BUCKETS)
    # The raw model smooths the target's, so that a feature is rare in it rather than impossible.
    share, total = raw / raw.sum(), target.sum()
    mixed = SMOOTH_SHARE * total + SMOOTH_FEATURES
    smoothed = (target + mixed * share) / (total + mixed)
    return np.where(raw > 0, np.log(np.maximum(smoothed, 1e-300) / np.where(raw > 0, share, 1.0)), 0.0)


def weigh(text: Column | str, ratios: np.ndarray) -> Column:
    """Struct of log_weight and n_features; a text without words weighs 0."""
    table = ratios.astype(np.float32)

    def apply(array: pa.Array) -> pa.Array:
        sums, counts = [], []
        for start, end in pieces(array):
            buckets, owners, count = _features(array.slice(start, end - start))
            sums.append(np.bincount(owners, table[buckets], minlength=count))
            counts.append(np.bincount(owners, minlength=count))
        columns = [np.concatenate(x) if x else np.empty(0) for x in (sums, counts)]
        return pa.StructArray.from_arrays(
            [pa.array(columns[0], pa.float64()), pa.array(columns[1].astype(np.int64))], WEIGHT.fieldNames()
        )

    return F.arrow_udf(apply, returnType=WEIGHT)(text)


def gumbel() -> Column:
    """Standard Gumbel noise from a hash of doc_id, the same in every run."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.coalesce("doc_id", F.lit(-1))), 12)
    return -F.log(-F.log((bits + 0.5) / float(1 << 52)))


def _mean(log_weight: Column, n_features: Column) -> Column:
    """Mean weight per feature, drawn to 0 where there are few; null without features."""
    return F.when(n_features > 0, log_weight / (n_features + NEUTRAL_FEATURES))


def _score(weight: Column) -> Column:
    """Perturbed log weight in whole units of 2**-20, so that its order is exact; null without features."""
    tempered = _mean(weight["log_weight"], weight["n_features"]) * PSEUDO_LENGTH
    return F.round((tempered + gumbel()) * float(1 << 20)).cast("long")


def kth_largest(table: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a long column, null if there are fewer values.

    Counts the values by their leading 16 bits, then those of the cell that holds the k-th by the
    next 16, and so on: four passes with at most 65,536 counts each, whatever the table's size.
    """
    within = table.filter(F.col(column).isNotNull()).select(column)
    cell, before = None, None
    for shift in (48, 32, 16, 0):
        if cell is not None:
            within = within.filter(F.shiftright(column, before) == cell)
        counts = within.groupBy(F.shiftright(column, shift).alias("cell")).agg(F.count("*").alias("n")).collect()
        cell, before = None, shift
        for row in sorted(counts, reverse=True):
            if k <= row.n:
                cell = row.cell
                break
            k -= row.n
        if cell is None:
            return None
    return cell


class Draw:
    """The models of a corpus and the score that the last drawn document reaches."""

    def __init__(self, docs: DataFrame, labels: DataFrame):
        short_batches(docs)
        ids = stored(target_ids(labels), "targets")
        self.ratios = log_ratios(docs.select("doc_id", "text"), ids)
        flags = F.broadcast(ids.filter("not taught").drop("taught"))  # MAX_TARGET_ROWS at most
        weighed = docs.select("doc_id", weigh("text", self.ratios).alias("weight"))
        scored = weighed.select("doc_id", "weight.*", _score(F.col("weight")).alias("score"))
        joined = scored.join(flags, F.col("doc_id") == F.col("target_id"), "left")
        self.scores = stored(joined.withColumn("unseen", F.col("target_id").isNotNull()).drop("target_id"), "scores")
        mean = _mean(F.col("log_weight"), F.col("n_features"))
        unseen = self.scores.filter("unseen").agg(F.percentile(mean, F.lit(TARGET_LOSS)), F.count(mean))
        lowest, rows = unseen.first()
        margin = MARGIN / max(1.0, rows * TARGET_LOSS) ** 0.5
        alike = F.lit(True) if lowest is None else mean >= lowest - margin
        self.size = self.scores.filter(mean.isNotNull() & alike).count()
        self.cut = kth_largest(self.scores, "score", self.size) if self.size else None

    def drawn(self, score: Column) -> Column:
        return F.lit(False) if self.cut is None else F.coalesce(score >= self.cut, F.lit(False))


def quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): log_weight, n_features, score and whether it is drawn.

    ``labels`` (doc_id, quality, toxic) names the target: good and not toxic. Toxic rows are only left out
    of it; long ones are mostly drawn all the same. The raw model counts all rows. Rows that tie with the last one drawn are drawn too; copies of a row share their noise and
    so their fate. A null or empty text has no features, no score and is never drawn. Without target
    rows all weights are 0 and every text with words is drawn. Other columns are left out.
    """
    draw = Draw(docs, labels)
    return draw.scores.select("doc_id", "log_weight", "n_features", "score", draw.drawn(F.col("score")).alias("drawn"))


def keep_drawn(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns."""
    draw = Draw(docs, labels)
    rows = docs.select(F.struct("*").alias("row_"))
    weighed = rows.select("row_", "row_.doc_id", weigh("row_.text", draw.ratios).alias("weight_"))
    return weighed.filter(draw.drawn(_score(F.col("weight_")))).select("row_.*")
