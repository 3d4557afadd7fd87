"""Approximate nearest neighbours by a forest of hash prefixes.

A tree gives a vector a long hash string: its nearest of 32 anchors, then, of what is left of it,
the nearest of 8, and so on. The rows of the index lie in segments; for every tree a segment holds
a sorted array of its strings. A query descends in all trees to its longest matching prefixes,
which are ranges of the sorted arrays, and then ascends in all of them at once, symbol by symbol,
until the ranges hold enough candidates. Those are compared by their exact distance.

The index holds every row; only the anchors come from a bounded sample. Segments and blocks of
queries meet pair by pair, and each pair keeps its nearest few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendlake.session import stored

TREES = 18
FIRST_BITS = 5
NEXT_BITS = 3
DEPTH = 10

# The anchors are fitted on at most so many rows, those of least hash.
SAMPLE_ROWS = 4096
SEED = 7

# A search ascends until the ranges of all trees together hold this share of a segment's rows.
CANDIDATE_SHARE = 0.4

NEAREST = 10
QUERY_EVERY = 100

SEGMENT_ROWS = 4096
# A segment is sent to a task once for each block of so many queries.
_QUERY_BITS = 13
QUERY_ROWS = 1 << _QUERY_BITS

_BITS = [0, *(FIRST_BITS + NEXT_BITS * level for level in range(DEPTH))]


def _nearest(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    return np.argmin((anchors**2).sum(1) - 2 * (rows @ anchors.T), axis=1)


def _anchors(rows: np.ndarray, count: int, random: np.random.Generator) -> np.ndarray:
    """Centres of ``count`` cells of the rows, after a few rounds of k-means."""
    centres = rows[random.choice(len(rows), count, replace=len(rows) < count)]
    for _ in range(6):
        cell = _nearest(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, rows)
        sizes = np.bincount(cell, minlength=count)[:, None]
        centres = np.where(sizes > 0, sums / np.maximum(sizes, 1), centres)
    return centres


class Forest:
    """The anchors of every level of every tree."""

    def __init__(self, sample: np.ndarray):
        self.trees: list[list[np.ndarray]] = []
        for tree in range(TREES):
            random = np.random.default_rng([SEED, tree])
            rest, levels = sample, []
            for level in range(DEPTH):
                anchors = _anchors(rest, 1 << (NEXT_BITS if level else FIRST_BITS), random)
                rest = rest - anchors[_nearest(rest, anchors)]
                levels.append(anchors.astype(np.float32))
            self.trees.append(levels)

    def strings(self, rows: np.ndarray) -> np.ndarray:
        """Hash string of each row in each tree, as whole numbers whose leading bits are the first symbols."""
        found = np.zeros((len(self.trees), len(rows)), np.int64)
        for tree, levels in enumerate(self.trees):
            rest = rows.astype(np.float32)
            for level, anchors in enumerate(levels):
                symbol = _nearest(rest, anchors)
                found[tree] = (found[tree] << (NEXT_BITS if level else FIRST_BITS)) | symbol
                rest = rest - anchors[symbol]
        return found


class Segment:
    """Some rows of the index with a sorted array of hash strings for each tree."""

    def __init__(self, forest: Forest, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        strings = forest.strings(rows)
        self.orders = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.orders, axis=1)

    def ranges(self, strings: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query the range of the longest prefixes, of one length in all trees, that hold ``wanted`` rows."""
        low = np.zeros(strings.shape, np.int64)
        high = np.full(strings.shape, len(self.ids), np.int64)
        todo = np.ones(strings.shape[1], bool)
        for bits in reversed(_BITS[1:]):
            shift = _BITS[-1] - bits
            for tree, own in enumerate(self.sorted):
                prefix = strings[tree, todo] >> shift
                low[tree, todo] = np.searchsorted(own, prefix << shift)
                high[tree, todo] = np.searchsorted(own, (prefix + 1) << shift)
            todo &= (high - low).sum(axis=0) < wanted
            if not todo.any():
                return low, high
        low[:, todo], high[:, todo] = 0, len(self.ids)  # up to the roots: every row
        return low, high

    def nearest(self, forest: Forest, query_ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query its number and the ids and distances of its nearest candidates; not its own id."""
        low, high = self.ranges(forest.strings(queries), max(NEAREST, int(CANDIDATE_SHARE * len(self.ids))))
        for number, query in enumerate(queries):
            chosen = np.zeros(len(self.ids), bool)
            for order, start, end in zip(self.orders, low[:, number], high[:, number], strict=True):
                chosen[order[start:end]] = True
            other = self.ids != query_ids[number]
            at = np.flatnonzero(chosen & other)
            if len(at) < NEAREST:  # the ranges overlap: up to the roots after all
                at = np.flatnonzero(other)
            gap = self.rows[at] - query
            distance = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            if len(at) > NEAREST:
                close = distance <= np.partition(distance, NEAREST - 1)[NEAREST - 1]
                at, distance = at[close], distance[close]
            best = np.lexsort((self.ids[at], distance))[:NEAREST]
            yield number, self.ids[at[best]], distance[best]


def _vectors(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and rows of a batch (id, vector) that take part: of the given length, finite, not zero."""
    ids, vectors = batch.column(0), batch.column(1)
    lengths = np.diff(np.asarray(vectors.offsets))
    right = (lengths == size) & np.asarray(vectors.is_valid()) & np.asarray(ids.is_valid())
    picked = vectors.filter(pa.array(right))
    rows = np.asarray(picked.flatten().cast(pa.float64()).fill_null(np.nan)).reshape(-1, max(size, 1))
    kept = np.isfinite(rows).all(axis=1) & (rows != 0).any(axis=1)
    return np.asarray(ids.filter(pa.array(right)), dtype=np.int64)[kept], rows[kept]


def _packed(table: DataFrame, size: int, rows_each: int) -> DataFrame:
    """Blocks of rows as (block, ids, vectors) with the numbers as bytes; all but a partition's last hold ``rows_each``."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, rows = np.empty(0, np.int64), np.empty((0, max(size, 1)))

        def made(count: int) -> pa.RecordBatch:
            values = [[block], [ids[:count].tobytes()], [rows[:count].tobytes()]]
            kinds = (pa.int64(), pa.binary(), pa.binary())
            columns = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["block", "ids", "vectors"])

        for batch in batches:  # of whatever length the session has them
            more_ids, more = _vectors(batch, size)
            ids, rows = np.concatenate([ids, more_ids]), np.concatenate([rows, more])
            while len(ids) >= rows_each:
                yield made(rows_each)
                ids, rows, block = ids[rows_each:], rows[rows_each:], block + 1
        if len(ids):
            yield made(len(ids))

    return table.mapInArrow(apply, "block long, ids binary, vectors binary")


def _sample(table: DataFrame) -> np.ndarray:
    """Vectors of the SAMPLE_ROWS ids of least hash, one for each, that take part; of the most frequent length."""
    whole = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    usable = table.filter(F.col("vec_id").isNotNull() & whole & F.exists("embedding", lambda x: x != 0))
    least = usable.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS)
    least = F.broadcast(stored(least, "sample-ids"))  # SAMPLE_ROWS ids at most
    chosen = usable.join(least, "vec_id").groupBy("vec_id").agg(F.min("embedding").alias("embedding")).collect()
    vectors = [r.embedding for r in sorted(chosen, key=lambda r: r.vec_id)]
    lengths = [len(v) for v in vectors]
    size = max(sorted(set(lengths)), key=lengths.count) if lengths else 0
    return np.array([v for v in vectors if len(v) == size], float).reshape(-1, max(size, 1))


def nearest_neighbours(table: DataFrame, every: int = QUERY_EVERY) -> DataFrame:
    """The nearest rows of each row of ``table`` (vec_id, embedding) whose id is divisible by ``every``.

    Columns query_id, rank (from 1), vec_id, score: the Euclidean distance in double precision, ties to the
    smaller vec_id. Candidates are all rows but those with the query's own id. Rows without an id, and vectors
    that are null, zero, of another length than most of the sample or hold null or non-finite components
    take no part, in the sample neither. A repeated row counts each time it occurs, as a candidate and as a query. Other columns are left
    out. No rows give none.
    """
    table = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>"))
    sample = _sample(table)
    if not len(sample):
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, forest = sample.shape[1], Forest(sample)

    queries = table.filter(F.col("vec_id") % every == 0)
    chunks = queries.repartition(max(1, -(-queries.count() // QUERY_ROWS)))
    chunks = _packed(chunks, size, QUERY_ROWS).withColumnsRenamed({"block": "chunk", "ids": "query_ids", "vectors": "queries"})
    chunks = stored(chunks, "query-blocks")
    segments = stored(_packed(table, size, SEGMENT_ROWS), "segments")
    numbers = chunks.agg(F.array_sort(F.collect_list("chunk"))).first()[0]  # one for each QUERY_ROWS queries
    pairs = segments.select("block").withColumn("chunk", F.explode(F.lit(numbers).cast("array<long>")))
    met = pairs.join(chunks, "chunk").join(segments, "block").select("block", "chunk", "query_ids", "queries", "ids", "vectors")

    def search(pair: pa.Table) -> pa.Table:
        chunk, *raw = (pair.column(i)[0].as_py() for i in range(1, 6))
        query_ids, ids = (np.frombuffer(raw[i], np.int64) for i in (0, 2))
        asked, rows = (np.frombuffer(raw[i], np.float64).reshape(-1, size) for i in (1, 3))
        columns: tuple[list, ...] = ([], [], [], [])
        for number, found, distances in Segment(forest, ids, rows).nearest(forest, query_ids, asked):
            columns[0].append(np.full(len(found), (chunk << _QUERY_BITS) + number))
            columns[1].append(np.full(len(found), query_ids[number]))
            columns[2].append(found)
            columns[3].append(distances)
        arrays = [pa.array(np.concatenate(c)) for c in columns]
        return pa.Table.from_arrays(arrays, names=["query_row", "query_id", "vec_id", "score"])

    # A group is one segment and one block of queries, so tasks hold one pair at a time.
    found = met.groupBy("block", "chunk").applyInArrow(
        search, "query_row long, query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_row").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEAREST)
    return ranked.select("query_id", "rank", "vec_id", "score")
