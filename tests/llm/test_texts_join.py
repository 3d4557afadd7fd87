"""Conversation repair, the n-gram join and spelling variants, and words that are built to collide."""

from __future__ import annotations

import hashlib
import itertools
import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from spendlake.llm import conversation_repair, minhash, ngram_join, packing, quality_rules, spelling  # noqa: E402
from spendlake.llm.conversation_repair import ACCEPTED, NOTHING, lightest  # noqa: E402
from spendlake.llm.texthash import Texts  # noqa: E402

ROW = st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), st.booleans(), st.booleans())


def _all_repairs(rows):
    """Every (cost, audit) of few rows, by trying all edits, with at most two insertions in a row."""
    found = []

    def go(place, state, cost, audit, inserted):
        if place == len(rows) and state in ACCEPTED:
            found.append((cost, audit))
        following = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        if inserted < 2:
            go(place, following, cost + 3, audit + "I", inserted + 1)
        if place == len(rows):
            return
        initial, must_go, cut = rows[place]
        go(place + 1, state, cost + 4, audit + "D", 0)
        if not must_go:
            kept = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((initial, state))
            if kept is not None:
                go(place + 1, kept, cost + 3 * cut, audit + "K", 0)
            go(place + 1, following, cost + 3 + 3 * cut, audit + "R", 0)

    go(0, NOTHING, 0, "", 0)
    return min(found)


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, max_size=5))
def test_agenda_finds_the_least_of_all_repairs(rows):
    assert list(lightest(rows, {NOTHING: (0, "")}, last=True).values()) == [_all_repairs(rows)]


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, max_size=30), st.integers(1, 7))
def test_blocks_change_nothing(rows, size):
    whole = lightest(rows, {NOTHING: (0, "")}, last=True)
    old, conversation_repair.BLOCK_ROWS = conversation_repair.BLOCK_ROWS, size
    try:
        made = conversation_repair._Conversation(1)
        for initial, must_go, cut in rows:
            made.add(None, initial, 1, must_go, cut, False)
        result = made.result()
    finally:
        conversation_repair.BLOCK_ROWS = old
    ((cost, audit),) = whole.values()
    assert result[-2:] == (cost, audit)


CONVS = "conv_id long, turn long, role string, text string, audit int, edit int, cost int, place int"


def _repaired(spark, rows):
    table = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], CONVS)
    plans = conversation_repair.repairs(table)
    made = conversation_repair.repaired(table, plans)
    texts = defaultdict(list)
    for row in sorted(made.collect(), key=lambda r: r.place):
        texts[row.conv_id].append((row.role, row.text, row.edit))
    hashes = {r.conv_id: r.repaired_sha256 for r in conversation_repair.digests(made).collect()}
    for name, lines in texts.items():
        joined = "\n".join(f"{role}:{text}" for role, text, _ in lines)
        assert hashes[name] == hashlib.sha256(joined.encode()).hexdigest()
    return {r.conv_id: r for r in plans.collect()}, texts


def test_repairs_of_odd_conversations(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, 5, "assistant", "Yes.")]
    rows += [(2, None, None, None), (2, 3, "user", " \t"), (3, 1, "user", "One"), (3, 2, "user", "Two. \n")]
    rows += [(None, 7, "system", "Be."), (None, 2, "", "x!"), (4, 1, "assistant", "b."), (4, 1, "assistant", "a.")]
    rows += [(5, 0, "user", "q" * 200_000 + "?"), (5, 1, "assistant", "A.")]
    plans, texts = _repaired(spark, rows)
    assert set(plans) == {1, 2, 3, 4, 5, None}
    first = plans[1]
    assert (first.gaps, first.duplicate, first.illegal, first.cost, first.audit) == (3, 2, 2, 8, "KKDD")
    assert [t[:2] for t in texts[1]] == [("user", "Hi."), ("assistant", "Yes.")]
    assert (plans[2].gaps, plans[2].blank, plans[2].cost, plans[2].audit) == (0, 2, 8, "DD") and 2 not in texts
    assert (plans[3].truncated, plans[3].illegal, plans[3].cost, plans[3].audit) == (1, 1, 6, "KR")
    last = plans[None]
    assert (last.gaps, last.illegal, last.cost, last.audit) == (4, 1, 6, "RR")
    assert [t[:2] for t in texts[None]] == [("user", "x!"), ("assistant", "Be.")]
    order = sorted(["a.", "b."], key=lambda t: hashlib.sha256(t.encode()).digest())
    assert plans[4].audit == "RK" and [t[:2] for t in texts[4]] == [("user", order[0]), ("assistant", order[1])]
    assert plans[5].audit == "KK" and len(texts[5][0][1]) == 200_001


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", f"Text {c} {t}. So!") for c in range(40) for t in range(8)]
    rows += [(None, 1, None, None), (3, None, "user", "w.")]
    table = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], CONVS)
    wanted = Counter()
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = role or " ", text or " "
        if kind:
            text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
            wanted[conv, turn, "user" if kind == 4 else role, text] += 2 if kind == 3 else 1
    found = Counter(tuple(r) for r in conversation_repair.damaged(table).collect())
    assert found == wanted and any(n == 2 for n in wanted.values())
    every = conversation_repair.repair_damaged(table)
    assert every.count() == 41 and every.filter("repaired_sha256 is null or audit is null").count() == 0
    assert conversation_repair.repair_damaged(table.limit(0)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    left = conversation_repair.repair_damaged(spark.createDataFrame([(gone, 0, "user", "a.", 1, 2, 3, 4)], CONVS)).first()
    assert tuple(left) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_a_long_conversation_in_blocks_equals_a_plain_table(spark):
    chance = random.Random(5)
    rows = [(9, t, chance.choice(["user", "assistant", "system"]), f"t{t % 290}.") for t in range(1500)]
    plans, texts = _repaired(spark, rows)
    seen, block = set(), []
    for _, _, role, text in rows:
        block.append((role[0], (role, text) in seen, False))
        seen.add((role, text))
    ((cost, audit),) = lightest(block, {NOTHING: (0, "")}, last=True).values()
    assert (plans[9].cost, plans[9].audit) == (cost, audit)
    assert len(texts[9]) == len(audit) - audit.count("D")


def _shingles(text):
    for upper, lower in zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", strict=True):
        text = text.replace(upper, lower)
    words = text.split()
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def _brute_components(texts):
    sets = [_shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return sets, [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("seed", range(3))
def test_ngram_join_finds_every_component(spark, seed):
    chance = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for family in range(12):
        size = chance.choice([1, 3, 5, 9, 20, 60, 130, 260, 700])
        base = [f"f{family}w{i}" for i in range(size)] + (passage if family % 3 == 0 else [])
        for _ in range(chance.randint(1, 14)):
            words = list(base)
            for _ in range(chance.randint(0, 1 + len(words) // 60)):
                words[chance.randrange(len(words))] = f"x{chance.randrange(10**6)}"
            if chance.random() < 0.2:
                words = words[: max(1, int(len(words) * chance.uniform(0.8, 1)))]
            texts.append(" ".join(words))
    texts += [f"{' '.join(passage)} only{i} own{i} own{i + 1}" for i in range(25)] + ["", " \t"]
    sets, wanted = _brute_components(texts)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n string")
    found = {r.doc_id: r for r in ngram_join.ngram_links(docs).collect()}
    assert [found[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert [found[i].component_id for i in range(len(texts))] == wanted


def test_ngram_join_of_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, "other words in this row of five"), (3, text.upper()), (None, text), (None, "alone it is here")]
    rows += [(9, None), (8, ""), (7, " \n"), (2, "One two"), (1, "one  TWO"), (5, text), (6, "É"), (4, "é")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, node int, token int")
    found = Counter(tuple(r) for r in ngram_join.ngram_links(docs).collect())
    wanted = [(5, 47, 3), (5, 4, 5), (3, 47, 3), (None, 47, 3), (None, 1, None), (9, 0, 9), (8, 0, 8), (7, 0, 7)]
    wanted += [(2, 1, 1), (1, 1, 1), (5, 47, 3), (6, 1, 6), (4, 1, 4)]
    assert found == Counter(wanted)


@given(st.integers(1, 5000), st.integers(1, 5000))
def test_prefix_lengths_are_what_similarity_asks(n, m):
    small, large = sorted((n, m))
    need = next((o for o in range(small + 1) if 100 * o >= 85 * (n + m - o)), None)
    if need is not None:  # then some shared token is among the first so many of each
        assert small - need + 1 <= ngram_join.index_length(small)
        assert large - need + 1 <= ngram_join.probe_length(large)


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("letters, seed", [("ab", 1), ("abcé", 2), ("abcdefghijÿ", 3)])
def test_near_pairs_are_all_pairs_one_edit_apart(spark, letters, seed):
    chance = random.Random(seed)
    words = {"".join(chance.choice(letters) for _ in range(chance.randint(5, 9))) for _ in range(250)}
    for word in list(words)[:120]:
        at = chance.randrange(len(word))
        words.add(word[:at] + chance.choice(["", chance.choice(letters)]) + word[at + chance.randint(0, 1) :])
    words |= {"a" * n for n in (5, 6, 7, 3000, 3001)}
    words = sorted(w for w in words if len(w) >= 5)
    frame = spark.createDataFrame([(w, i + 3) for i, w in enumerate(words)], "word string, n long")
    found = sorted((r.a, r.b) for r in spelling.near_pairs(frame).collect())
    assert found == sorted((a, b) for a, b in itertools.combinations(words, 2) if _one_edit(a, b))


@given(st.lists(st.integers(0, 9), min_size=3, max_size=12), st.randoms())
def test_pivots_are_the_lightest_disjoint_pair(ranks, chance):
    weight = {r: chance.randint(1, 20) for r in set(ranks)}
    grams = list(enumerate(ranks))
    a, b = spelling.pivots(grams, weight)
    assert b - a >= 2
    pairs = [(i, j) for i in range(len(ranks)) for j in range(i + 2, len(ranks))]
    assert weight[ranks[a]] + weight[ranks[b]] == min(weight[ranks[i]] + weight[ranks[j]] for i, j in pairs)


def test_spelling_of_odd_rows(spark):
    text = "Spelling spelling SPELLING speling speling speling ÉCOLES École école école_école " + "tie1ties ties-tiesx"
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "z" * 100_000 + " x"), (5, "naïve×÷ " * 7)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, word int, n int")
    counts = Counter()
    for doc_id, body in rows:
        run = ""
        for letter in [*(body or ""), " "]:
            if letter.isascii() and letter.isalpha() or "À" <= letter <= "ÿ":
                run += letter.lower() if letter.isascii() else letter
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 97 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
            run = ""
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in counts if _one_edit(w, v)] for w in counts}
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[word] = best if best and counts[best] >= 2 * counts[word] else None
    wanted = set()
    for word in counts:
        root = word
        while forms[root]:
            root = forms[root]
        wanted.add((word, forms[word], root, counts[word], len(near[word]), counts.get(forms[word])))
    assert {tuple(r) for r in spelling.spelling_variants(docs).collect()} == wanted and len(wanted) > 3
    assert spelling.spelling_variants(docs.limit(0)).collect() == []


def test_chains_of_forms_lead_to_the_last(spark):
    words = ["aaaaaaaaa"]
    for at in range(9):
        words.append(words[-1][:at] + "b" + words[-1][at + 1 :])
    forms = spark.createDataFrame(list(zip(words, words[1:], strict=False)), "word string, form string")
    assert {(r.word, r.root) for r in spelling._roots(forms).collect()} == {(w, words[-1]) for w in words[:-1]}


def _twins(steps):
    a, b = "a", "b"
    for _ in range(steps):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("steps", [4, 8, 9, 10, 12])
def test_words_built_alike_have_hashes_of_their_own(steps):
    texts = Texts(pa.array([" ".join(_twins(steps))]))
    starts, ends, _ = texts.words()
    for seed in (0, 1):
        assert len(set(texts.hash_slices(starts, ends, seed).tolist())) == 2
    assert len(texts.distinct(starts, ends)[0]) == 2


def test_equal_hashes_do_not_make_words_equal(monkeypatch):
    monkeypatch.setattr(Texts, "hash_slices", lambda self, starts, ends, seed=0: np.zeros(len(starts), np.uint64))
    words = ["one", "two", "one", "x" * 600, "x" * 599 + "y", "two", "x" * 600]
    texts = Texts(pa.array([" ".join(words)]))
    starts, ends, _ = texts.words()
    first, place = texts.distinct(starts, ends)
    assert [words[first[p]] for p in place] == words


def test_words_built_alike_stay_apart_in_packing_rules_and_copies(spark):
    a, b = _twins(11)
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, a), (2, b), (3, f"{a}\n{b}\n{a} {b} {b} {a} {a}")], "doc_id long, text string")
    tokenizer = Tokenizer.from_file(path)
    for row in packing.pack(docs, path, 1 << 20).collect():
        text = {1: a, 2: b, 3: f"{a}\n{b}\n{a} {b} {b} {a} {a}"}[row.doc_id]
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert (row.length, row.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    both = docs.withColumns({"lang": docs.text.substr(1, 0), "source": docs.text.substr(1, 0)})
    found = {r.doc_id: (r.n_dup_lines, r.n_repeat_words) for r in quality_rules.quality_rules(both).collect()}
    assert found[3] == (0, 0)
    assert {(r.doc_id, r.class_id) for r in minhash.near_duplicates(docs).filter("doc_id < 3").collect()} == {(1, 1), (2, 2)}
