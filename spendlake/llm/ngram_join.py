"""Similarity join of documents on their word n-grams, exact, by prefix filters in several token orders.

A document is the set of its shingles of four words. Of two sets that are similar enough each must hold,
in any order of all tokens, a token of the other among its first few: its prefix. One order alone
leaves candidates that share a prefix token by chance, so several orders are asked:

* In the first order rare tokens come first, as far as frequencies are known: for a share of the tokens,
  chosen by hash, the number of sets that hold them is counted; all others follow by hash. Prefixes in this
  order are the inverted index. A set so need not have all its tokens counted, only more than its prefix.
* Two further orders, by the tokens' hashes backwards and by another hash. Candidates must share prefix tokens in
  both; only what is left is verified on whole sets.

Sets are compared within classes of size (octaves; a set just above a bound is in the class below, too), each with
its own order, so that short sets, which passages fill, can have all their tokens counted.

Equal sets are one node. In each list of the index nodes are first compared with the one that is changed least, which
joins large groups of near copies without listing their pairs; then lists that still hold several components are
searched for pairs of different ones, but for those whose parity signatures say that they differ too much. No link
that joins components is lost.
"""

from __future__ import annotations

import functools
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm.batches import short_batches
from spendlake.llm.components import component_roots, near_labels
from spendlake.llm.texthash import Texts, mix, pieces, text_of, windows
from spendlake.session import drop_stored, stored

SHINGLE_WORDS = 4

# Sets link from 85 / 100 on: 100 * shared >= 85 * all.
PERCENT = 85

# Share of the tokens that are counted, by the binary digits of the set's size; the last one holds from there on.
# A prefix is a sixth of a set, and where more is counted, passages that many sets share move out of it.
COUNTED = {7: 1.0, 8: 0.4, 9: 0.28, 10: 0.19}

# Tokens in whole sets. In the index they are shorter: chance meetings there only add candidates.
_TOKEN_BITS = 63
_INDEX_BITS = 56
# The last digits of a token in the index are its class.
_CLASS_BITS = 5

# Bits of a set's parity signature: each of its tokens turns one. Two sets differ in as many tokens as bits, at least.
PARITY_BITS = 1024

_KEYS = ["key_high", "key_low"]


def probe_length(n):
    """Tokens in the prefix of a set of ``n`` tokens against any set."""
    return n - (PERCENT * n + 99) // 100 + 1


def index_length(n):
    """Tokens in the prefix of a set of ``n`` tokens against sets of its size or more: they must share more."""
    return n - (2 * PERCENT * n + 99 + PERCENT) // (100 + PERCENT) + 1


class _Lowered(Texts):
    def __init__(self, array: pa.Array):
        super().__init__(array)
        upper = (self.bytes >= 65) & (self.bytes <= 90)
        self.bytes = np.where(upper, self.bytes + np.uint8(32), self.bytes)


def shingle_sets(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of some texts, by text and hash, and their texts; and two keys of each text's set."""
    texts = _Lowered(array)
    starts, ends, bounds = texts.words()
    owner, counts = text_of(bounds), np.diff(bounds)
    ordinal = (np.arange(len(starts)) - bounds[owner]).astype(np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
    hashes = []
    for seed in (0, 1):
        words = texts.hash_slices(starts, ends, seed)
        grams = windows(words, SHINGLE_WORDS)
        whole = owner[: len(grams)] == owner[SHINGLE_WORDS - 1 :]
        placed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words + mix(ordinal + np.uint64(1))))])
        sequence = mix(placed[bounds[1:]] - placed[bounds[:-1]] + counts.astype(np.uint64))
        hashes.append(np.concatenate([grams[whole], sequence[short]]))
        owners = np.concatenate([owner[: len(grams)][whole], short])
    order = np.lexsort((hashes[0], owners))
    values, owners = hashes[0][order], owners[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[first], owners[first]
    limits = np.searchsorted(owners, np.arange(texts.count + 1))
    keys = []
    for own in (values, hashes[1][order][first]):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(own + np.uint64(1)))])
        keys.append(mix(sums[limits[1:]] - sums[limits[:-1]]).view(np.int64))
    return values >> np.uint64(64 - _TOKEN_BITS), owners, keys[0], keys[1]


def _digits(n: np.ndarray) -> np.ndarray:
    """Binary digits of whole numbers from 1."""
    return np.frexp(np.maximum(n, 1).astype(np.float64))[1].astype(np.int64)


_SHARES = np.array([COUNTED[min(max(d, min(COUNTED)), max(COUNTED))] for d in range(65)])
_LIMITS = np.array([min(int(share * 2**_TOKEN_BITS), 2**_TOKEN_BITS - 1) for share in _SHARES], np.uint64)

SKETCH = T.StructType(
    [
        T.StructField("key_high", T.LongType()),
        T.StructField("key_low", T.LongType()),
        T.StructField("n", T.LongType()),
        *[T.StructField(f"{name}_counted", T.IntegerType()) for name in ("own", "lower")],
        *[T.StructField(f"{name}_tokens", T.ArrayType(T.LongType())) for name in ("own", "lower")],
        T.StructField("parity", T.ArrayType(T.LongType())),
    ]
)


def _listed(values: np.ndarray, owners: np.ndarray, count: int, kind: type = np.int64) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=count))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind)))


def sketch(array: pa.Array) -> pa.StructArray:
    """Of each text: two keys of its set, the set's size, and the tokens of least hash that its classes need.

    These are all that are counted there, and as many more as the prefix needs; the class is in their last digits.
    """
    parts = [_sketch(array.slice(start, end - start)) for start, end in pieces(array)]
    return pa.concat_arrays(parts) if parts else pa.array([], _arrow_type())


def _arrow_type() -> pa.DataType:
    kinds = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.ArrayType(T.LongType()): pa.list_(pa.int64())}
    return pa.struct([(f.name, kinds[f.dataType]) for f in SKETCH.fields])


def _sketch(array: pa.Array) -> pa.StructArray:
    values, owners, high, low = shingle_sets(array)
    sizes = np.bincount(owners, minlength=len(array)).astype(np.int64)
    place = np.arange(len(values)) - np.searchsorted(owners, np.arange(len(array)))[owners]
    own, least = _digits(sizes), _digits((PERCENT * sizes + 99) // 100)
    counted, tokens = [], []
    for digits, member in ((own, sizes > 0), (least, least < own)):
        inside = member[owners] & (values <= _LIMITS[digits][owners])
        chosen = inside | (member[owners] & (place < probe_length(sizes)[owners]))
        marked = values >> np.uint64(_TOKEN_BITS - _INDEX_BITS + _CLASS_BITS) << np.uint64(_CLASS_BITS)
        marked = marked | (digits.astype(np.uint64)[owners] % np.uint64(1 << _CLASS_BITS))
        counted.append(pa.array(np.bincount(owners[inside], minlength=len(array)).astype(np.int32)))
        tokens.append(_listed(marked[chosen], owners[chosen], len(array)))
    turned = np.bincount(owners * PARITY_BITS + (values % np.uint64(PARITY_BITS)).astype(np.int64), minlength=len(array) * PARITY_BITS)
    bits = np.packbits((turned & 1).astype(bool)).view(np.int64)
    parity = _listed(bits, np.repeat(np.arange(len(array)), PARITY_BITS // 64), len(array))
    columns = [pa.array(high), pa.array(low), pa.array(sizes), *counted, *tokens, parity]
    return pa.StructArray.from_arrays(columns, names=SKETCH.fieldNames())


WHOLE = T.StructType(
    [
        T.StructField("key_high", T.LongType()),
        T.StructField("key_low", T.LongType()),
        T.StructField("tokens", T.ArrayType(T.LongType())),
        *[T.StructField(name, T.ArrayType(T.IntegerType())) for name in ("backward", "scattered")],
    ]
)


def whole_sets(array: pa.Array) -> pa.StructArray:
    """Of each text: the keys of its set, the whole set, and its prefixes in the two further orders."""
    parts = []
    for start, end in pieces(array):
        values, owners, high, low = shingle_sets(array.slice(start, end - start))
        count = end - start
        sizes = np.bincount(owners, minlength=count)
        from_first = np.arange(len(values)) - np.searchsorted(owners, np.arange(count))[owners]
        backward = sizes[owners] - 1 - from_first < probe_length(sizes)[owners]
        order = np.lexsort((mix(values), owners))
        scattered = order[from_first < probe_length(sizes)[owners]]
        lists = [_listed(values, owners, count)]
        for at in (np.flatnonzero(backward), scattered):  # shorter tokens suffice to meet
            lists.append(_listed((values[at] >> np.uint64(_TOKEN_BITS - 32)).astype(np.uint32), owners[at], count, np.int32))
        parts.append(pa.StructArray.from_arrays([pa.array(high), pa.array(low), *lists], names=WHOLE.fieldNames()))
    kinds = [pa.int64()] * 2 + [pa.list_(pa.int64())] + [pa.list_(pa.int32())] * 2
    return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(list(zip(WHOLE.fieldNames(), kinds, strict=True))))


def _index(nodes: DataFrame) -> DataFrame:
    """(token, node, n, place) of every prefix token that two nodes at least have in theirs; place counts from 0."""
    classes = [F.struct(F.col(f"{c}_counted").alias("counted"), F.col(f"{c}_tokens").alias("tokens")) for c in ("own", "lower")]
    placed = nodes.select("node", "n", F.explode(F.array(*classes)).alias("of")).select("node", "n", "of.*").filter("size(tokens) > 0")
    of_class = (F.col("token") % (1 << _CLASS_BITS)).alias("class")
    sizes = placed.select("node", "n", "counted", F.get("tokens", F.lit(0)).alias("token")).select("node", "n", "counted", of_class)
    inside = placed.select("node", F.explode(F.slice("tokens", 1, F.col("counted"))).alias("token"))
    spread = inside.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    held = inside.join(stored(spread, "token-counts"), "token")
    ranked = held.groupBy("node", of_class).agg(F.array_sort(F.collect_list(F.struct("sets", "token"))).alias("ranked"))
    ranked = ranked.join(sizes, ["node", "class"])
    # Tokens of one set only come first, and they are in no list.
    before = F.col("counted") - F.size("ranked")
    taken = F.slice("ranked", 1, F.greatest(F.least(probe_length_of("n"), F.col("counted")) - before, F.lit(0)).cast("int"))
    counted = ranked.select("node", "n", before.alias("before"), F.posexplode(taken).alias("nth", "item"))
    counted = counted.select("item.token", "node", "n", (F.col("before") + F.col("nth")).alias("place"))
    more = F.slice("tokens", F.col("counted") + 1, F.greatest(probe_length_of("n") - F.col("counted"), F.lit(0)).cast("int"))
    others = placed.select("node", "n", "counted", F.posexplode(more).alias("nth", "token"))
    others = others.select("token", "node", "n", (F.col("counted") + F.col("nth")).alias("place"))
    postings = stored(counted.unionByName(others), "postings")
    # A list's head is the set with the fewest rarer tokens: of a family of copies the one that is changed least.
    central = F.min_by("node", F.struct("place", "n", "node")).alias("head")
    lists = postings.groupBy("token").agg(central, F.count(F.lit(1)).alias("nodes")).filter("nodes > 1")
    return stored(postings.join(stored(lists.drop("nodes"), "lists"), "token"), "index")


def probe_length_of(n: str) -> Column:
    return F.col(n) - F.floor((PERCENT * F.col(n) + 99) / 100) + 1


def index_length_of(n: str) -> Column:
    return F.col(n) - F.floor((2 * PERCENT * F.col(n) + 99 + PERCENT) / (100 + PERCENT)) + 1


def _possible(n: str, place: str, other_n: str, other_place: str) -> Column:
    """Whether two sets may be similar enough if the token at these places is the first that they share."""
    left = F.least(F.col(n) - F.col(place), F.col(other_n) - F.col(other_place))
    return left * (100 + PERCENT) >= PERCENT * (F.col(n) + F.col(other_n))


def _differ_little(n: str, parity: str, other_n: str, other_parity: str) -> Column:
    """Whether two sets' parity signatures differ in no more bits than similar sets of their sizes do in tokens."""
    words = range(PARITY_BITS // 64)
    bits = [F.bit_count(F.get(parity, F.lit(i)).bitwiseXOR(F.get(other_parity, F.lit(i)))) for i in words]
    allowed = (100 - PERCENT) * (F.col(n) + F.col(other_n))  # of 100 + PERCENT
    return functools.reduce(operator.add, bits) * (100 + PERCENT) <= allowed


def _verified(pairs: DataFrame, docs: DataFrame, named: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that share prefix tokens in the further orders and are similar on whole sets."""
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stored(named.join(wanted, "node", "left_semi"), "wanted")
    # Called nondeterministic so that no filter on its keys is pushed below the join that picks the texts.
    udf = F.arrow_udf(lambda array: whole_sets(array), returnType=WHOLE).asNondeterministic()
    texts = docs.select(_id().alias("id"), "text").join(wanted.select("id").distinct(), "id", "left_semi")
    made = texts.select(udf("text").alias("whole")).select("whole.*").join(wanted.select("node", *_KEYS), _KEYS)
    held = stored(made.drop(*_KEYS).dropDuplicates(["node"]), "whole-sets")
    orders = ("backward", "scattered")
    left = held.select(F.col("node").alias("a"), *[F.col(c).alias(f"{c}_a") for c in orders])
    right = held.select(F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in orders])
    for order in orders:
        pairs_met = F.arrays_overlap(f"{order}_a", f"{order}_b")
        met = pairs_met if order == orders[0] else met & pairs_met
    filtered = pairs.join(left, "a").join(right, "b").filter(met).select("a", "b")
    left = held.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
    right = held.select(F.col("node").alias("b"), F.col("tokens").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    similar = 100 * shared >= PERCENT * (F.size("left") + F.size("right") - shared)
    return filtered.join(left, "a").join(right, "b").filter(similar).select("a", "b")


def _id() -> Column:
    """doc_id; rows without one go by a hash of their text. It only serves to find texts again."""
    return F.coalesce("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))))


def linked_nodes(nodes: DataFrame, docs: DataFrame, named: DataFrame) -> DataFrame:
    """(node, root) of the nodes that have a link; equal roots mean one component."""
    index = _index(nodes)
    stars = index.filter("node <> head").select("token", F.col("node").alias("a"), "n", "place", F.col("head").alias("b"))
    heads = index.filter("node = head").select("token", F.col("n").alias("n_"), F.col("place").alias("place_"))
    stars = stars.join(heads, "token").filter(_possible("n", "place", "n_", "place_"))
    links = stored(_verified(stars.select("a", "b"), docs, named), "links")
    labels = near_labels(links, rounds=3)
    placed = index.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stored(placed.drop("head"), "placed")
    open_ = placed.groupBy("token").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most")
    open_ = placed.join(stored(open_.select("token"), "open-lists"), "token", "left_semi")
    open_ = stored(open_.join(nodes.select("node", "parity"), "node"), "open")
    drop_stored(nodes)
    small = open_.filter(F.col("place") < index_length_of("n"))
    large = open_.withColumnsRenamed({c: f"{c}_" for c in ("node", "n", "place", "root", "parity")})
    upward = (F.col("n") < F.col("n_")) | ((F.col("n") == F.col("n_")) & (F.col("node") < F.col("node_")))
    apart = (F.col("root") != F.col("root_")) & upward & _possible("n", "place", "n_", "place_")
    pairs = small.join(large, "token").filter(apart & _differ_little("n", "parity", "n_", "parity_"))
    more = _verified(pairs.select(F.col("node").alias("a"), F.col("node_").alias("b")), docs, named)
    return component_roots(links.unionByName(more), labels)


def ngram_links(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Words are runs without white space, A-Z lower-cased; a text's set holds its distinct shingles of four words, or
    all its words as one where they are fewer. Rows link when their sets share 85 % of all that either
    holds; component_id is the least doc_id that links lead to. Null, empty and wordless texts link with
    nothing and have their own. A row without doc_id links like any other, and has a null component where no row
    that it reaches has a doc_id; so have rows of one doc_id with different texts, each by its own. Repeated
    rows each have their row; other columns are left out; no rows give none.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    udf = F.arrow_udf(lambda array: sketch(array), returnType=SKETCH)
    row = F.monotonically_increasing_id().alias("row")
    sketched = short_batches(docs).select("doc_id", _id().alias("id"), row, udf("text").alias("sketch"))
    sketched = stored(sketched.select("doc_id", "id", "row", "sketch.*"), "sketches")
    # Every set once, named by the first row that has it.
    sets = sketched.filter("n > 0").groupBy(*_KEYS).agg(F.min(F.struct("row", "id")).alias("first"), F.min("doc_id").alias("least"))
    named = stored(sets.select(*_KEYS, F.col("first.row").alias("node"), "first.id", "least"), "named")
    lists = [f.name for f in SKETCH.fields[3:]]
    nodes = sketched.join(named.select("node"), F.col("row") == F.col("node"))
    nodes = stored(nodes.select("node", "n", *lists), "nodes")
    rows = stored(sketched.select("doc_id", F.col("n").alias("n_shingles"), *_KEYS), "rows")
    drop_stored(sketched)
    roots = linked_nodes(nodes, docs, named.drop("least"))
    placed = named.join(roots, "node", "left").select(*_KEYS, "least", F.coalesce("root", "node").alias("root"))
    placed = stored(placed, "placed-sets")
    smallest = stored(placed.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    component = stored(placed.join(smallest, "root").select(*_KEYS, "component_id"), "set-components")
    worded = rows.filter("n_shingles > 0").join(component, _KEYS).select("doc_id", "n_shingles", "component_id")
    return worded.unionByName(rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
