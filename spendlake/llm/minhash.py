"""Near-duplicate classes by DartMinHash.

A document is a weighted set: its shingles of five words (lower case), each as heavy as it
is frequent. The plane of weight and rank of a shingle holds darts, a Poisson process that
hashes fix once and for all; a document catches those below its weight. The caught dart of
least rank in each coordinate is the signature, and two documents agree in a coordinate with
the probability of their weighted Jaccard similarity. Signatures meet in bands; what meets
is compared by its shingles.
"""

from __future__ import annotations

import functools
import math
import operator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm.batches import short_batches
from spendlake.llm.components import component_roots, near_labels
from spendlake.llm.texthash import Texts, mix, pieces, text_of, windows
from spendlake.session import stored

SHINGLE_WORDS = 5
SIMILARITY = 0.8

# A pair of similarity 0.8 misses all bands with probability (1 - 0.8**6)**32, about 6e-5.
BANDS = 32
BAND_ROWS = 6
COORDINATES = BANDS * BAND_ROWS

# Nodes that stay contested get one-bit signatures of so many coordinates. Pairs at 0.8 differ in
# 205 of them on average, with a deviation of 13.6; more than 4.5 deviations are no link.
FINE_COORDINATES = 2048
MAX_DIFFERENT_BITS = 266
FIRST_LOOK_BITS = 256
MAX_FIRST_BITS = 48

_STEP = np.uint64(0x9E3779B97F4A7C15)
_ID = np.uint64(0xD6E8FEB86659FD93)

SKETCH = T.StructType(
    [
        T.StructField("key_high", T.LongType()),
        T.StructField("key_low", T.LongType()),
        T.StructField("weight", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of every shingle, in page order; and the hash of all words of each text, twice.

    A text of fewer than five words, but at least one, is a single shingle.
    """
    starts, ends, bounds = texts.words()
    words = texts.hash_slices(starts, ends)
    owner = text_of(bounds)
    counts = np.diff(bounds)
    grams = windows(words, SHINGLE_WORDS)
    whole = owner[: len(grams)] == owner[SHINGLE_WORDS - 1 :]
    ordinal = (np.arange(len(words)) - bounds[owner]).astype(np.uint64)
    keys = []
    for seed in (0, 1):  # two hashes of the words that have nothing in common
        own = texts.hash_slices(starts, ends, seed) if seed else words
        placed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(own + mix(ordinal + _salt(seed + 1))))])
        keys.append(mix(placed[bounds[1:]] - placed[bounds[:-1]] + counts.astype(np.uint64)))
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
    values = np.concatenate([grams[whole], keys[0][short]])
    owners = np.concatenate([owner[: len(grams)][whole], short])
    return values, owners, keys[0], keys[1]


def _uniform(bits: np.ndarray) -> np.ndarray:
    """Numbers above 0 and up to 1 from 64 random bits each."""
    return ((bits >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def signatures(
    values: np.ndarray, weights: np.ndarray, owners: np.ndarray, count: int, coordinates: int = COORDINATES
) -> np.ndarray:
    """DartMinHash of ``count`` weighted sets: per set and coordinate the id of its dart of least rank.

    ``values`` are the elements' hashes. Weights are cut into regions of doubling width, and a
    region's darts come in order of rank, as the arrivals of a Poisson process with that width as
    its rate. A set looks at ranks up to a bound that should fill all coordinates; if one stays
    empty, the bound is doubled. Sets without elements keep zeros.
    """
    result = np.zeros((count, coordinates), np.uint64)
    total = np.bincount(owners, weights, minlength=count)
    with np.errstate(divide="ignore"):
        reach = coordinates * (math.log(coordinates) + 2) / total
    todo = total > 0
    while todo.any():
        best = _throw(values, weights, owners, np.where(todo, reach, 0.0), coordinates)
        done = todo & (best != _NO_DART).all(axis=1)
        result[done] = best[done]
        todo &= ~done
        chosen = todo[owners]
        values, weights, owners = values[chosen], weights[chosen], owners[chosen]
        reach = reach * 2
    return result & _DART_BITS


_NO_DART = np.uint64(2**64 - 1)
_DART_BITS = np.uint64(2**32 - 1)


def _salt(number: int) -> np.uint64:
    return np.uint64(number * int(_STEP) & (2**64 - 1))


def _throw(
    values: np.ndarray, weights: np.ndarray, owners: np.ndarray, reach: np.ndarray, coordinates: int
) -> np.ndarray:
    """Per set and coordinate the dart of least rank: the rank as a float of 32 bits, then 32 bits of its id."""
    best = np.full(len(reach) * coordinates, _NO_DART)
    # Weights are 1 or more, so the first region, of width 1, is caught whole; the wider ones in part.
    _arrivals(mix(values + _salt(1)), 1.0, reach[owners], owners * coordinates, None, best, coordinates)
    level = 1
    while (weights >= 1 << level).any():
        held = np.flatnonzero(weights >= 1 << level)
        seed = mix(values[held] + _salt(level + 1))
        share = (weights[held] - ((1 << level) - 1)) / (1 << level)
        own = owners[held]
        _arrivals(seed, float(1 << level), reach[own], own * coordinates, share, best, coordinates)
        level += 1
    return best.reshape(len(reach), coordinates)


def _arrivals(
    seed: np.ndarray,
    rate: float,
    limit: np.ndarray,
    base: np.ndarray,
    share: np.ndarray | None,
    best: np.ndarray,
    coordinates: int,
) -> None:
    """Throws the darts of regions up to their ranks' limits; of each region only ``share`` of the width counts.

    A region's next darts are thrown together, the more of them the fewer regions are left.
    """
    rank, thrown = np.zeros(len(seed)), 0
    while len(seed):
        many = min(512, max(1, 8192 // len(seed)))
        salts = np.array([_salt(2 * (thrown + i + 1)) for i in range(many)], np.uint64)
        gaps = -np.log(_uniform(mix(seed[:, None] + salts))) / rate
        gaps[:, 0] += rank
        ranks = np.cumsum(gaps, axis=1)
        region, nth = np.nonzero(ranks <= limit[:, None])
        dart = mix(seed[region] ^ (salts[nth] + _STEP))
        at = base[region] + ((dart >> np.uint64(32)) % np.uint64(coordinates)).astype(np.int64)
        order = ranks[region, nth].astype(np.float32).view(np.uint32).astype(np.uint64)
        key = (order << np.uint64(32)) | (dart & _DART_BITS)
        if share is not None:
            hit = _uniform(mix(dart)) <= share[region]
            at, key = at[hit], key[hit]
        np.minimum.at(best, at, key)
        left = np.flatnonzero(ranks[:, -1] <= limit)
        rank, seed, limit, base = ranks[left, -1], seed[left], limit[left], base[left]
        share = None if share is None else share[left]
        thrown += many


def _weighted(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Distinct shingles with their texts and frequencies, and the two keys of the texts."""
    values, owners, *keys = shingles(texts)
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    places = np.flatnonzero(first)
    return values[places], owners[places], np.diff(np.append(places, len(values))), (keys[0], keys[1])


def _listed(parts: list[np.ndarray], rows: int, width: int) -> pa.Array:
    flat = np.concatenate(parts).reshape(-1) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(flat))


def sketch(array: pa.Array) -> pa.StructArray:
    """Key of the word sequence, weight and band keys of each text."""
    columns: list[list[np.ndarray]] = [[], [], []]
    bands = []
    for start, end in pieces(array, row_bytes=1024):
        texts = Texts(pc.utf8_lower(array.slice(start, end - start)))
        values, owners, heavy, keys = _weighted(texts)
        marks = signatures(values, heavy.astype(np.float64), owners, texts.count)
        weight = np.bincount(owners, heavy, minlength=texts.count).astype(np.int64)
        for column, part in zip(columns, (keys[0].view(np.int64), keys[1].view(np.int64), weight), strict=True):
            column.append(part)
        rows = marks.reshape(texts.count, BANDS, BAND_ROWS)
        band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (texts.count, BANDS)).copy()
        for place in range(BAND_ROWS):
            band = mix(band * _STEP + rows[:, :, place])
        bands.append(band.view(np.int64))
    whole = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64)) for c in columns]
    return pa.StructArray.from_arrays([*whole, _listed(bands, len(array), BANDS)], names=SKETCH.fieldNames())


def fine_bits(array: pa.Array) -> pa.Array:
    """One-bit signature of FINE_COORDINATES of each text, as whole numbers of 64 bits."""
    parts = []
    for start, end in pieces(array, row_bytes=8 * FINE_COORDINATES):
        texts = Texts(pc.utf8_lower(array.slice(start, end - start)))
        values, owners, heavy, _ = _weighted(texts)
        marks = signatures(values, heavy.astype(np.float64), owners, texts.count, FINE_COORDINATES)
        parts.append(np.packbits((marks & np.uint64(1)).astype(bool), axis=1).view(np.int64))
    return _listed(parts, len(array), FINE_COORDINATES // 64)


def tokens(array: pa.Array) -> pa.Array:
    """The shingles of each text as distinct numbers: the second of two equal shingles gets another number."""
    flat, sizes = [], []
    for start, end in pieces(array):
        texts = Texts(pc.utf8_lower(array.slice(start, end - start)))
        values, owners, _, _ = shingles(texts)
        order = np.lexsort((values, owners))
        values, owners = values[order], owners[order]
        first = np.ones(len(values), bool)
        first[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
        places = np.flatnonzero(first)
        nth = np.arange(len(values)) - np.repeat(places, np.diff(np.append(places, len(values))))
        flat.append(mix(values + nth.astype(np.uint64) * _STEP).view(np.int64))
        sizes.append(np.bincount(owners, minlength=texts.count))
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1)
    values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int64))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def document_key() -> Column:
    """doc_id; rows without one go by a hash of their text."""
    return F.coalesce("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))))


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the documents with the given keys."""
    return docs.select(document_key().alias("id"), "text").join(ids, "id", "left_semi")


def _close(a: str, b: str) -> Column:
    """Whether two fine signatures differ in few enough bits: a first look at some, then all."""

    def differ(x: Column, y: Column) -> Column:
        return F.bit_count(x.bitwiseXOR(y))

    first = functools.reduce(operator.add, [differ(F.col(a)[i], F.col(b)[i]) for i in range(FIRST_LOOK_BITS // 64)])
    every = F.aggregate(F.zip_with(a, b, differ), F.lit(0), operator.add)
    return (first <= MAX_FIRST_BITS) & (every <= MAX_DIFFERENT_BITS)


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of document keys whose texts are at least 0.8 similar, by all their shingles."""
    pairs = stored(pairs.distinct(), "pairs")
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "wanted")
    udf = F.arrow_udf(lambda array: tokens(array), returnType=T.ArrayType(T.LongType()))
    held = stored(_texts_of(docs, wanted).select("id", udf("text").alias("tokens")), "tokens")
    left = held.withColumnsRenamed({"id": "a", "tokens": "left"})
    right = held.withColumnsRenamed({"id": "b", "tokens": "right"})
    shared = F.size(F.array_intersect("left", "right"))
    similar = shared >= SIMILARITY * (F.size("left") + F.size("right") - shared)
    return pairs.join(left, "a").join(right, "b").filter(similar).select("a", "b")


def _open_buckets(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components, with their root and the one of most nodes as ``main``."""
    placed = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stored(placed.drop("head"), "placed")
    per_root = placed.groupBy("band", "root").agg(F.count("*").alias("n"))
    main = per_root.groupBy("band").agg(F.max_by("root", "n").alias("main"), F.count("*").alias("roots"))
    main = stored(main.filter("roots > 1").select("band", "main"), "main-roots")
    return stored(placed.join(main, "band"), "open")


def classes(docs: DataFrame) -> DataFrame:
    """(id, class_id) of every document key, each once; a class is named by its smallest key.

    Exact copies (equal words) are one node from the start. In every band bucket nodes are
    compared with the smallest one, which joins large groups of copies without listing their
    pairs. Buckets that still hold several components are searched pair by pair, but for pairs
    within one, so no link that the bands find is lost; longer signatures leave few to compare.
    """
    udf = F.arrow_udf(lambda array: sketch(array), returnType=SKETCH)
    made = short_batches(docs).select(document_key().alias("id"), udf("text").alias("sketch"))
    sketched = stored(made.select("id", "sketch.*"), "sketches")
    content = ["key_high", "key_low"]
    texts_ = sketched.filter("weight > 0")
    named = stored(texts_.groupBy(*content).agg(F.min("id").alias("node")), "named")
    members = stored(texts_.select("id", *content).distinct().join(named, content).select("id", "node"), "members")
    nodes = texts_.join(named, content).filter("id = node").dropDuplicates(["node", *content])
    one_id = members.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b")

    banded = stored(nodes.select("node", "weight", F.posexplode("bands").alias("place", "band")), "bands")
    heads = banded.groupBy("band").agg(F.min("node").alias("head"), F.count("*").alias("n")).filter("n > 1")
    heads = stored(heads.select("band", "head"), "heads")
    shared = stored(banded.join(heads, "band"), "buckets")
    stars = shared.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    links = stored(_confirmed(stars, docs).unionByName(one_id.select("a", "b")), "links")
    labels = near_labels(links)
    open_ = _open_buckets(shared, labels)
    contested = stored(open_.select(F.col("node").alias("id")).distinct(), "contested")
    finely = F.arrow_udf(lambda array: fine_bits(array), returnType=T.ArrayType(T.LongType()))
    fine = _texts_of(docs, contested).select("id", finely("text").alias("bits"))
    fine = stored(fine.join(sketched.select("id", "bands"), "id").withColumnRenamed("id", "node"), "fine")
    open_ = stored(open_.join(fine, "node"), "open")
    other = open_.filter("root <> main").drop("main", "place")
    other = other.withColumnsRenamed({c: f"{c}_" for c in ("node", "weight", "bits", "root", "band", "bands")})
    apart = (F.col("root") != F.col("root_")) & ((F.col("root") == F.col("main")) | (F.col("node") < F.col("node_")))
    sizes = F.least("weight", "weight_") >= SIMILARITY * F.greatest("weight", "weight_")
    met = F.arrays_overlap(F.slice("bands", 1, F.col("place")), F.slice("bands_", 1, F.col("place")))
    pairs = open_.join(other, (F.col("band") == F.col("band_")) & apart & sizes & _close("bits", "bits_") & ~met)
    more = _confirmed(pairs.select(F.col("node").alias("a"), F.col("node_").alias("b")), docs)
    roots = component_roots(links.unionByName(more), labels)

    placed_ids = members.join(roots, "node", "left").select("id", F.coalesce("root", "node").alias("class_id"))
    found = placed_ids.groupBy("id").agg(F.min("class_id").alias("class_id"))
    wordless = sketched.filter("weight = 0").select("id", F.col("id").alias("class_id"))
    return stored(found.unionByName(wordless).groupBy("id").agg(F.min("class_id").alias("class_id")), "classes")


# Keys that are hashes lie above this, so that they name no class that has a doc_id.
_HASHED = 1 << 62


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as rows (row_, key_): the doc_id, or a hash of it and the text where an id is null or has several texts."""
    text = F.coalesce("text", F.lit(""))
    hashed = docs.filter("doc_id is not null").select("doc_id", F.xxhash64(text).alias("hash"))
    several = hashed.groupBy("doc_id").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).filter("a <> b")
    several = stored(several.select(F.col("doc_id").alias("of")), "ids-of-several-texts")
    rows = docs.select(F.struct("*").alias("row_"))
    joined = rows.join(several, F.col("row_.doc_id") == F.col("of"), "left")
    own = F.pmod(F.xxhash64("row_.doc_id", F.coalesce("row_.text", F.lit(""))), F.lit(_HASHED)) + _HASHED
    plain = F.col("row_.doc_id").isNotNull() & F.col("of").isNull()
    return joined.select("row_", F.when(plain, F.col("row_.doc_id")).otherwise(own).alias("key_"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, class_id, is_first.

    A class holds exact copies (equal words, letters in either case) and whatever chains of
    similarity 0.8 or more reach; class_id is its smallest doc_id, and is_first marks the rows
    of that document. Texts without a word are in no class but their own. Rows of one doc_id and text
    are one document; a row without doc_id, or whose doc_id has other texts too, goes by a hash of both. No rows
    give none.
    """
    keyed = _keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = classes(keyed.select(F.col("key_").alias("doc_id"), "row_.text"))
    joined = keyed.select("row_.doc_id", "key_").join(found, F.col("key_") == F.col("id"))
    return joined.select("doc_id", "class_id", (F.col("id") == F.col("class_id")).alias("is_first"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each class, with all its columns.

    Of rows with the same doc_id and text it is the one whose columns have the least hash, whatever order they come in.
    """
    keyed = _keyed(docs)
    found = classes(keyed.select(F.col("key_").alias("doc_id"), "row_.text"))
    gone = found.filter("id <> class_id").select(F.col("id").alias("key_"))
    repeated = keyed.groupBy("key_").count().filter("count > 1").select("key_")
    repeated = stored(repeated, "repeated")
    kept = keyed.join(stored(gone, "gone"), "key_", "left_anti")
    once = kept.join(repeated, "key_", "left_anti")
    least = F.min_by("row_", F.xxhash64(F.to_json("row_")))
    first = kept.join(repeated, "key_", "left_semi").groupBy("key_").agg(least.alias("row_"))
    return once.select("row_.*").unionByName(first.select("row_.*"))
