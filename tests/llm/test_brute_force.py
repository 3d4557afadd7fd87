"""Operators beyond SQL, held against plain versions of themselves or the libraries they stand for."""

from __future__ import annotations

import hashlib
import html
import random
import re
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import corpus_pipeline  # noqa: E402
from compare import connect, spark_rows, sql_rows  # noqa: E402
from spendlake.llm import byte_bpe, html_text, minhash, packing, pretokens, secrets, token_counts  # noqa: E402
from spendlake.llm.oracles import ORACLES  # noqa: E402
from spendlake.llm.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
ODD = st.text(st.sampled_from(list("ab'sretvmldLl  \n\t\r\x0b\x1c\u00a0\u20031é!.#<|>日Ⅷ\u0301ΣİÉ")), max_size=40)


def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    columns, found = spark_rows(QUERIES[name](spark, FOLDER))
    wanted_columns, wanted = sql_rows(connect(FOLDER), ORACLES[name])
    assert columns == wanted_columns
    assert found == wanted


# Packing


def test_packing(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = QUERIES["op1_best_fit_packing"](spark, FOLDER).collect()
    texts = documents(spark)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    assert by_doc.keys() == texts.keys()
    total = 0
    for doc_id, own in by_doc.items():
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 0]
        total += len(ids)
        for number, row in enumerate(sorted(own, key=lambda r: r.piece)):
            part = ids[2048 * number : 2048 * (number + 1)]
            assert (row.piece, row.start, row.length) == (number, 2048 * number, len(part))
            assert row.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        assert sum(r.length for r in own) == len(ids)
    for own in by_sequence.values():
        at = 0
        for row in sorted(own, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= 2048
    assert len(by_sequence) <= -(-total // 2048) + 2


@given(st.lists(st.integers(1, 50), max_size=80))
@settings(max_examples=60, deadline=None)
def test_best_fit_decreasing(lengths):
    sequence, offset = packing.best_fit_decreasing(np.array(lengths, np.int64), 50)
    rooms: list[int] = []
    for at in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fitting = [r for r in rooms if r >= lengths[at]]
        room = min(fitting) if fitting else 50
        if fitting:
            rooms.remove(room)
        rooms.append(room - lengths[at])
        assert offset[at] == 50 - room
    assert len(set(sequence.tolist())) == len(rooms)


@given(st.lists(ODD, max_size=8))
@settings(max_examples=150, deadline=None)
def test_word_tokenizer(texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    ids, bounds = packing.word_tokenizer(path).encode_all(pa.array(texts, pa.string()))
    library = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids


# Secrets


def plain_spans(text):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    rules = (("assign", assign, 2, 12, re.I | re.A), ("access", r"AKIA[A-Z0-9]+", 0, 18, 0), ("hex", r"[0-9a-f]+", 0, 16, 0))
    found = []
    for number, (kind, pattern, group, least, flags) in enumerate(rules):
        found += [(m.start(), number, kind, m.end()) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return sorted(found)


def test_secret_scan(spark):
    found = {r.doc_id: r for r in QUERIES["op2_secret_scan"](spark, FOLDER).collect()}
    for doc_id, text in documents(spark).items():
        spans = plain_spans(text)
        row = found[doc_id]
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(s[1] == n for s in spans) for n in range(3)]
        listed = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


SECRET_PARTS = ["password", "PassWd", "api_key", "apikey", "token", '"', "'", " ", "=", ":", "AKIA", "Z9", "0f3a9b2c", "é",
                "abcdefghijkl", "-----BEGIN RSA PRIVATE KEY-----", "ghp_", "a" * 36, "xoxb-", "1234567890", "eyJabcdefgh.", "\n"]


@given(st.lists(st.lists(st.sampled_from(SECRET_PARTS), max_size=12).map("".join), max_size=6))
@settings(max_examples=150, deadline=None)
def test_trigram_candidates_miss_nothing(texts):
    found = secrets.Scanner().scan(pa.array(texts, pa.string()))
    for text, spans in zip(texts, found, strict=True):
        wanted = sorted((a, n, b) for n, rule in enumerate(secrets.RULES) for a, b in rule.spans(text))
        assert spans == wanted
        assert [s for s in spans if s[1] < 3] == [(a, n, b) for a, n, _, b in plain_spans(text)]


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]{16,}") is True
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == ("or", (("and", (b"aki", b"kia")),))
    assert secrets.trigram_query("(abc|x*)def.*ghi") != True  # noqa: E712


# Nearest neighbours


def test_recall_and_distances(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    vectors = {i: np.array(v, float) for i, v in zip(table.vec_id, table.embedding, strict=True)}
    found = defaultdict(list)
    for row in QUERIES["op3_nearest_neighbours"](spark, folder).orderBy("query_id", "rank").collect():
        found[row.query_id].append(row)
    assert found.keys() == {i for i in vectors if i % 100 == 0}
    hits = 0
    for query, rows in found.items():
        exact = sorted((float(np.sqrt(((v - vectors[query]) ** 2).sum())), i) for i, v in vectors.items() if i != query)[:10]
        hits += len({i for _, i in exact} & {r.vec_id for r in rows})
        assert [r.rank for r in rows] == list(range(1, 11))
        assert all(abs(r.score - np.sqrt(((vectors[r.vec_id] - vectors[query]) ** 2).sum())) < 1e-12 for r in rows)
    assert hits >= 0.9 * 10 * len(found)


# Pages


def test_page_text(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    found = {r.page_id: r.text for r in QUERIES["op4_html_text"](spark, FOLDER).collect()}
    right = 0
    for page_id, page in pages.items():
        article = re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", page, re.DOTALL)[1])
        parts = (" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", article))
        right += found[page_id] == " ".join(p for p in parts if p)
    assert right >= 0.95 * len(pages)


def test_blocks():
    page = "<title>t</title><div class='Side-bar'>a<b>b</b> &lt;c<br>d<p>e<p>f</div>g<!-- h --><script>i</script><a href=j>k</a> l <x"
    paths, texts, links = html_text.Blocks().cut(page)
    assert texts == ["ab <c", "d", "e", "f", "gk l <x"] or texts == ["ab <c", "d", "e", "f", "gk l"]
    assert paths[0] == ("div", ".side", ".bar") and paths[2] == ("div", ".side", ".bar", "p") and paths[4] == ()
    assert links[4] > 0


@pytest.mark.parametrize(
    ("markup", "hidden"),
    [
        ("<svg-icon name=x></svg-icon>", ""),
        ("<SELECT-BOX>y</SELECT-BOX>", "y"),
        ("<title-bar></title-bar><template-x></template-x>", ""),
        ("<svg class='>' viewBox=\"0 0 1 1\" />", ""),
        ("<math/><svg\n/>", ""),
        ("<svg><path d='m'/><text>z</text></svg>", ""),
        ("<svg>", ""),
        ("<object data=a><select>", ""),
        ("<script>if (a</b/.test(c)) '</scripts>'</script x>", ""),
    ],
)
def test_text_after_elements_stays(markup, hidden):
    page = f"<p>a</p>{markup}<article><p>whole rest</p></article>"
    texts = html_text.Blocks().cut(page + "<svg></svg>" * markup.endswith("/>"))[1]
    assert texts == [x for x in ("a", hidden, "whole rest") if x]


def test_unclosed_raw_text_hides_the_rest():
    for name in ("script", "style", "textarea", "title", "iframe", "noscript"):
        assert html_text.Blocks().cut(f"<p>a</p><{name} x='/'/>b<p>c</p>")[1] == ["a"]
    assert html_text.Blocks().cut("<p>a</p>" + "<svg>" * 500 + "<p>b</p>")[1] == ["a", "b"]


def test_tables_of_long_pages_get_texts(spark):
    part = "<h2>Heading {0}</h2><p>Paragraph {0} of the text &amp; more of it that goes on for a while.</p>"
    page = f"<body><article>{''.join(part.format(i) for i in range(1500))}</article></body>"
    text = " ".join(f"Heading {i} Paragraph {i} of the text & more of it that goes on for a while." for i in range(1500))
    assert len(page) > html_text.SAMPLE_CHARS
    schema = "page_id long, url string, html string"
    alone = html_text.html_text(spark.createDataFrame([(1, "u", page)], schema)).collect()
    assert [r.text for r in alone] == [text]
    bare = [(i, "u", "<script>no text</script>") for i in range(1000)]
    among = html_text.html_text(spark.createDataFrame([*bare, (None, "u", page)], schema)).filter("n_chars > 0")
    assert [(r.page_id, r.text) for r in among.collect()] == [(None, text)]


def test_training_material_is_bounded():
    blocks = html_text.Blocks()
    assert html_text.material(blocks, "<script>a</script> ") is None
    texts, words = html_text.material(blocks, "x" * 1_000_000 + "".join(f"<p>{i} {'y' * 300}" for i in range(9000)))
    assert len(texts[0]) == html_text.BLOCK_CHARS and len(words[0]) == html_text.WORD_CHARS
    assert sum(map(len, texts)) <= html_text.SAMPLE_CHARS + html_text.BLOCK_CHARS
    assert int(texts[-1].split()[0]) > 8000
    assert html_text.material(blocks, "<p>a b<p>c") == (["a b", "c"], ["a", "b", "c"])


def test_gradients():
    random_ = np.random.default_rng(0)
    model = html_text.BiLstm(random_)
    values = [*model.weights, model.out]
    inputs = random_.normal(size=(5, 3, html_text.INPUT)).astype(np.float32)
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], np.float32)
    labels = random_.integers(0, 2, mask.shape).astype(np.float32)

    def loss():
        chance = 1 / (1 + np.exp(-model.scores(5, 3, lambda a, b: (inputs[a:b], mask[a:b])).astype(float)))
        return -((labels * np.log(chance) + (1 - labels) * np.log(1 - chance)) * mask).sum() / mask.sum()

    for value, slope in zip(values, model.gradients(inputs, mask, labels), strict=True):
        at = np.unravel_index(np.argmax(np.abs(slope)), slope.shape)
        old = value[at]
        value[at] = old + 1e-2
        up = loss()
        value[at] = old - 1e-2
        down = loss()
        value[at] = old
        assert (up - down) / 2e-2 == pytest.approx(slope[at], rel=0.1)


def test_windows_change_no_score(monkeypatch):
    random_ = np.random.default_rng(1)
    model = html_text.BiLstm(random_)
    inputs = random_.normal(size=(50, 1, html_text.INPUT)).astype(np.float32)
    part = lambda a, b: (inputs[a:b], np.ones((b - a, 1), np.float32))
    whole = model.scores(50, 1, part)
    for window in (7, 25, 49):
        monkeypatch.setattr(html_text, "WINDOW_STEPS", window)
        assert np.allclose(model.scores(50, 1, part), whole, atol=1e-5)


def test_one_long_page_among_small_ones_takes_little_memory():
    random_ = np.random.default_rng(2)
    extractor = html_text.Extractor(html_text.BiLstm(random_))
    small = [f"<p>page {i}<p>more of it" for i in range(47)]
    apart = [extractor.texts([page])[0] for page in small]
    long = "".join(f"<p>{i}" for i in range(100_000))
    tracemalloc.start()
    found = extractor.texts([*small[:20], long, *small[20:]])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6
    assert found[:20] + found[21:] == apart and set(found[20].split()) <= set(map(str, range(100_000)))


# Near-duplicates


def shingle_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return Counter([tuple(words)] if len(words) < 5 else zip(*(words[i:] for i in range(5))))


def plain_classes(texts):
    sets = {i: shingle_counts(t) for i, t in texts.items() if t.split()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j:
                shared = (sets[i] & sets[j]).total()
                if shared >= 0.8 * (sets[i].total() + sets[j].total() - shared):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def test_near_duplicate_classes(spark):
    found = {r.doc_id: r.class_id for r in QUERIES["op5_minhash_dedup"](spark, FOLDER).collect()}
    assert found == plain_classes(documents(spark))


def test_signatures_estimate_weighted_similarity():
    random_ = np.random.default_rng(3)
    values = random_.integers(0, 2**63, 60).astype(np.uint64)
    left, right = random_.integers(1, 9, 60), random_.integers(1, 9, 60)
    left[:12], right[48:] = 0, 0
    marks = []
    for weights in (left, right):
        held = weights > 0
        marks.append(minhash.signatures(values[held], weights[held].astype(float), np.zeros(held.sum(), int), 1, 4096)[0])
    exact = np.minimum(left, right).sum() / np.maximum(left, right).sum()
    assert (marks[0] == marks[1]).mean() == pytest.approx(exact, abs=0.04)


# Token counts


def test_token_counts(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r.doc_id: r for r in QUERIES["op6_token_counts"](spark, FOLDER).collect()}
    for doc_id, text in documents(spark).items():
        tokens = len(library.encode(text, add_special_tokens=False).ids)
        row = found[doc_id]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), tokens, tokens > 1024)


def test_prefix_counts_and_truncation():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, counter = Tokenizer.from_file(path), token_counts.counter(path)
    random_ = random.Random(2)
    parts = ["a", "'", "re", "s", "ll", " ", "  ", "\n", "1", "é", "!", "日", " the", "<|endoftext|>", "<|end", "x"]
    for _ in range(200):
        text = "".join(random_.choices(parts, k=random_.randint(0, 12)))
        counts = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counter.prefix_counts(text).tolist() == counts
        assert counter.count_all([text], 4)[0][0] == counts[-1]
        cut = counter.truncate(text, 3)
        assert counts[len(cut)] <= 3 and all(c > 3 for c in counts[len(cut) + 1 :])


# Byte-level BPE


@given(st.lists(ODD, max_size=8))
@settings(max_examples=200, deadline=None)
def test_byte_bpe_and_boundaries(texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    code = byte_bpe.coder(path)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={}
    )
    for text, ids in zip(texts, code.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert code.decode(ids) == text.encode()
        some, offsets = code.encode(text)
        middle = len(some) // 2
        assert code.decode(some[:middle]) == text.encode()[: offsets[middle]]
    words, bounds = pretokens.split(texts)
    assert ["".join(words[a:b]) for a, b in zip(bounds, bounds[1:])] == texts


def test_long_merges_equal_short_ones():
    code = byte_bpe.coder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    random_ = random.Random(4)
    for _ in range(200):
        word = bytes(random_.choices(b"aeinrst", k=random_.randint(2, 48)))
        assert code._merge_long(word) == code._merge_short(word)


# Quality classifier


def test_good_rows_are_drawn_and_bad_ones_are_not(spark):
    folder = "/root/testdata/sf0.1"
    drawn = QUERIES["op8_quality_classifier"](spark, folder).filter("n_features > 0")
    rows = drawn.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good = [r.drawn for r in rows if r.quality == 1 and not r.toxic]
    bad = [r.drawn for r in rows if r.quality == 0 and not r.toxic]
    long_bad = [r.drawn for r in rows if r.quality == 0 and not r.toxic and r.n_features >= 99]
    assert sum(good) >= 0.995 * len(good)
    assert sum(bad) <= 0.05 * len(bad)
    assert sum(long_bad) <= 0.02 * len(long_bad)


# Pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sets, before = [], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, FOLDER)
        rows = {r.doc_id: r for r in after.collect()}
        sets.append(rows)
        before = spark.createDataFrame(list(rows.values()), docs.schema)
    good, drawn, distinct, masked = sets
    judged = {r.doc_id: r.kept for r in QUERIES["op7_quality_rules"](spark, FOLDER).collect()}
    assert good.keys() == {i for i, kept in judged.items() if kept}
    assert drawn.keys() <= good.keys() and len(drawn) >= 0.9 * len(good)
    classes = plain_classes({i: r.text for i, r in drawn.items()})
    assert distinct.keys() == set(classes.values())
    assert masked.keys() == distinct.keys()
    for doc_id, row in masked.items():
        assert not plain_spans(row.text) and row.n_chars == len(row.text)
        assert row.text == distinct[doc_id].text or plain_spans(distinct[doc_id].text)
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in packed} == masked.keys()
