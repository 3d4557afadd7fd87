"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: the text between block tags, with the tags, classes
and ids above it. A bidirectional LSTM in numpy reads, block by block, hashed vectors of the tag
path and of the words, and says of every block whether it belongs to the main text, with the whole
page as context. It is trained here, on sequences that are laid out from the text of a bounded
sample of pages in the manner of many templates.
"""

from __future__ import annotations

import html
import itertools
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm.batches import short_batches
from spendlake.llm.texthash import Texts, pieces

# Training pages: at most so many with a text, those of least hash, and of each blocks of about so many characters,
# in runs that are evenly spread over the page. Longer blocks and words count by their beginning in training.
SAMPLE_PAGES = 192
SAMPLE_CHARS = 100_000
RUN = 8
BLOCK_CHARS = 10_000
SAMPLE_WORDS = 200
WORD_CHARS = 256

# Layouts of each training page, and of all together at least.
LAYOUTS = 6
LEAST_LAYOUTS = 384
LONGEST = 160
EPOCHS = 10
SEED = 5

PATH_SIZE = 96
WORD_SIZE = 32
HIDDEN = 12

# Pages whose blocks are labelled together, as long as their blocks, padded to the longest page, are not more than
# the steps of a window. A longer page is labelled by itself, window by window.
_TOGETHER = 48
WINDOW_STEPS = 8192

EXTRACTED = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

MATERIAL = T.StructType([T.StructField(n, T.ArrayType(T.StringType())) for n in ("texts", "words")])
_MATERIAL_ARROW = pa.struct([(n, pa.list_(pa.string())) for n in MATERIAL.fieldNames()])

# Element kinds of the HTML standard.
_RAW = "script|style|noscript|template|svg|math|iframe|object|textarea|select|title"
_ENDLESS = frozenset("script style noscript iframe textarea title".split())  # unclosed, they hold the rest of the page
_FOREIGN = frozenset(("svg", "math"))  # empty if they end in />
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output picture "
    "progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input audio video canvas".split()
)
_CLOSES = {
    "p": ("p",),
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
_HOLDERS = frozenset("ul ol dl table article section main aside nav header footer div form body td".split())

_MARKUP = re.compile(
    rf"<!--(?:.*?-->|.*)|<({_RAW})(?=[\s/>])(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"|<[/!?]?[a-zA-Z](?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+>|<[/!?]?[a-zA-Z][^<>]*+>",
    re.DOTALL | re.IGNORECASE,
)
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.IGNORECASE) for name in _RAW.split("|")}
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)")
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
_TOKEN = re.compile(r"[a-z]+")


def _raw_end(page: str, name: str, tag: str, at: int, unclosed: set[str]) -> int | None:
    """Where the raw element ends whose opening tag ends at ``at``; None if it is unclosed and hides nothing."""
    if name in _FOREIGN and tag.endswith("/>"):
        return at
    found = None if name in unclosed else _RAW_ENDS[name].search(page, at)
    if found:
        return found.end()
    unclosed.add(name)  # nor is any later one closed
    return len(page) if name in _ENDLESS else None


@dataclass(frozen=True)
class Tag:
    name: str
    closes: bool
    inline: bool
    marks: tuple[str, ...]


class Blocks:
    """Cuts pages into leaf blocks; remembers the tags it has met."""

    def __init__(self):
        self._tags: dict[str, Tag | None] = {}

    def _tag(self, raw: str) -> Tag | None:
        known = self._tags.get(raw, self)
        if known is not self:
            return known
        found = _NAME.match(raw)
        tag = None
        if found:
            name = found[2].lower()
            values = " ".join(m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(raw)).lower()
            marks = (name, *(f".{t}" for t in dict.fromkeys(_TOKEN.findall(values))))
            tag = Tag(name, bool(found[1]), name in _INLINE, marks)
        if len(raw) < 80:
            if len(self._tags) > 20_000:
                self._tags.clear()
            self._tags[raw] = tag
        return tag

    def cut(self, page: str) -> tuple[list[tuple[str, ...]], list[str], list[float]]:
        """Path, text and share of linked characters of every leaf block with a text."""
        paths: list[tuple[str, ...]] = []
        texts: list[str] = []
        links: list[float] = []
        stack: list[Tag] = []
        path: tuple[str, ...] = ()
        parts: list[str] = []
        linked, in_link = 0, False

        def close() -> None:
            nonlocal linked
            if parts:
                text = " ".join(html.unescape("".join(parts)).split())
                if text:
                    paths.append(path)
                    texts.append(text)
                    links.append(min(1.0, linked / len(text)))
                parts.clear()
                linked = 0

        at, unclosed = 0, set()
        while match := _MARKUP.search(page, at):
            start = match.start()
            if start > at:
                parts.append(page[at:start])
                linked += (start - at) * in_link
            at = match.end()
            if match[1]:
                end = _raw_end(page, match[1].lower(), match[0], at, unclosed)
                if end is not None:
                    at = end
                    continue
            if page.startswith(("<!", "<?"), start):
                continue
            tag = self._tag(match[0])
            if tag is None:
                continue
            if tag.inline and tag.name != "br":
                if tag.name == "a":
                    in_link = not tag.closes
                continue
            close()
            if tag.closes:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth].name == tag.name:
                        del stack[depth:]
                        break
                in_link = False
            elif tag.name not in _VOID:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth].name in _CLOSES.get(tag.name, ("p",)):
                        del stack[depth:]
                        break
                    if stack[depth].name in _HOLDERS:
                        break
                stack.append(tag)
            path = tuple(mark for open_ in stack for mark in open_.marks)
        if at < len(page):
            parts.append(page[at:])
            linked += (len(page) - at) * in_link
        close()
        return paths, texts, links


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Hashed counts of the marks of a path, and of the innermost tag with its own marks."""
    vector = np.zeros(PATH_SIZE, np.float32)
    own = max((i for i, mark in enumerate(path) if mark[0] != "."), default=0)
    for i, mark in enumerate(path):
        vector[zlib.crc32(mark.encode()) % PATH_SIZE] = 1
        if i >= own:
            vector[zlib.crc32(f"leaf {mark}".encode()) % PATH_SIZE] = 1
    return vector


def word_vectors(texts: list[str]) -> np.ndarray:
    """Hashed word shares of each text, with its length in words and characters."""
    data = Texts(pa.array(texts, pa.string()))
    starts, ends, bounds = data.words()
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(texts)), counts)
    bucket = (data.hash_slices(starts, ends) >> np.uint64(59)).astype(np.int64)
    table = np.bincount(owner * WORD_SIZE + bucket, minlength=len(texts) * WORD_SIZE).reshape(-1, WORD_SIZE)
    shares = table / np.maximum(counts, 1)[:, None]
    sizes = np.log1p(np.stack([counts, np.diff(data.bounds)], axis=1)) / 5
    return np.concatenate([shares, sizes], axis=1).astype(np.float32)


INPUT = PATH_SIZE + WORD_SIZE + 3


class BiLstm:
    """One layer in each direction and a logistic output per step, with hand-written gradients."""

    def __init__(self, random: np.random.Generator):
        scale = 0.1
        shape = (INPUT + HIDDEN + 1, 4 * HIDDEN)
        self.weights = [random.normal(0, scale, shape).astype(np.float32) for _ in range(2)]
        for weight in self.weights:
            weight[-1, HIDDEN : 2 * HIDDEN] = 1  # remember at first
        self.out = random.normal(0, scale, 2 * HIDDEN + 1).astype(np.float32)

    @staticmethod
    def _run(
        weight: np.ndarray, inputs: np.ndarray, mask: np.ndarray, keep: bool = False, carry: np.ndarray | None = None
    ) -> tuple[np.ndarray, list, np.ndarray]:
        """States of every step of a (steps, pages, INPUT) batch, and what the next batch of the pages carries on.

        Steps that are masked out pass the state on.
        """
        steps, pages, _ = inputs.shape
        state, cell = np.zeros((2, pages, HIDDEN), np.float32) if carry is None else carry
        states, tape = np.empty((steps, pages, HIDDEN), np.float32), []
        driven = inputs.reshape(-1, INPUT) @ weight[:INPUT] + weight[-1]
        driven = driven.reshape(steps, pages, -1)
        recurrent = weight[INPUT:-1]
        for step in range(steps):
            gates = driven[step] + state @ recurrent
            sig = 1 / (1 + np.exp(-gates[:, : 3 * HIDDEN]))
            take, hold, show = sig[:, :HIDDEN], sig[:, HIDDEN : 2 * HIDDEN], sig[:, 2 * HIDDEN :]
            new = np.tanh(gates[:, 3 * HIDDEN :])
            on = mask[step][:, None]
            next_cell = on * (hold * cell + take * new) + (1 - on) * cell
            bent = np.tanh(next_cell)
            next_state = on * (show * bent) + (1 - on) * state
            if keep:
                tape.append((state, cell, take, hold, show, new, bent, on))
            state, cell = next_state, next_cell
            states[step] = state
        return states, tape, np.stack([state, cell])

    def _both(self, inputs: np.ndarray, mask: np.ndarray):
        ahead, tape_a, _ = self._run(self.weights[0], inputs, mask, True)
        back, tape_b, _ = self._run(self.weights[1], inputs[::-1], mask[::-1], True)
        return np.concatenate([ahead, back[::-1]], axis=2), (tape_a, tape_b)

    def scores(self, steps: int, pages: int, part: Callable[[int, int], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Scores of all steps of some pages. ``part(a, b)`` gives inputs and mask of the steps from a to b.

        Each direction goes over windows of steps and carries its state from one to the next.
        """
        found = np.full((steps, pages), self.out[-1], np.float32)
        windows = [(a, min(a + WINDOW_STEPS, steps)) for a in range(0, steps, WINDOW_STEPS)]
        only = part(0, steps) if len(windows) == 1 else None
        for side, order in enumerate((windows, windows[::-1])):
            out, carry = self.out[side * HIDDEN : (side + 1) * HIDDEN], None
            for a, b in order:
                turn = slice(None, None, -1 if side else 1)
                inputs, mask = only or part(a, b)
                states, _, carry = self._run(self.weights[side], inputs[turn], mask[turn], carry=carry)
                found[a:b] += (states @ out)[turn]
        return found

    def gradients(self, inputs: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        states, tapes = self._both(inputs, mask)
        chance = 1 / (1 + np.exp(-(states @ self.out[:-1] + self.out[-1])))
        error = (chance - labels) * mask / max(mask.sum(), 1)
        out = np.append(np.einsum("sp,sph->h", error, states), error.sum()).astype(np.float32)
        into = error[:, :, None] * self.out[:-1]
        parts = []
        for side, (weight, tape) in enumerate(zip(self.weights, tapes, strict=True)):
            own = into[:, :, side * HIDDEN : (side + 1) * HIDDEN]
            seen = inputs
            if side:
                own, seen = own[::-1], inputs[::-1]
            parts.append(self._back(weight, tape, seen, own))
        return [*parts, out]

    @staticmethod
    def _back(weight: np.ndarray, tape: list, inputs: np.ndarray, into: np.ndarray) -> np.ndarray:
        recurrent = weight[INPUT:-1]
        slopes = np.empty((len(tape), inputs.shape[1], 4 * HIDDEN), np.float32)
        d_state = np.zeros_like(tape[0][0])
        d_cell = np.zeros_like(d_state)
        for step in range(len(tape) - 1, -1, -1):
            state, cell, take, hold, show, new, bent, on = tape[step]
            d_state = d_state + into[step]
            d_show = d_state * on * bent
            d_next = d_cell + d_state * on * show * (1 - bent**2)
            gates = np.concatenate(
                [
                    d_next * on * new * take * (1 - take),
                    d_next * on * cell * hold * (1 - hold),
                    d_show * show * (1 - show),
                    d_next * on * take * (1 - new**2),
                ],
                axis=1,
            )
            slopes[step] = gates
            d_state = d_state * (1 - on) + gates @ recurrent.T
            d_cell = d_next * (on * hold + 1 - on)
        flat = slopes.reshape(-1, 4 * HIDDEN)
        states = np.stack([entry[0] for entry in tape]).reshape(-1, HIDDEN)
        return np.concatenate([inputs.reshape(-1, INPUT).T @ flat, states.T @ flat, flat.sum(axis=0)[None]])


# How templates wrap the main text and everything else; the last tag of a wrap holds the block.
_MAIN = "article|main article|main|div .content|div .page div .post .body|section .entry|div .article .body|div .main .text|td .story"
_MAIN_LEAVES = "h1|h2|p|p|p|p|p|p|li|blockquote|pre"
_OTHER = {
    "menu": "nav ul li|div .menu ul li|ul .navbar li|ul .nav li|ul .menu li|div .nav|header nav ul li|div .nav .links|nav|div .breadcrumb",
    "header": "header|div .header|div .masthead|header h1|div .top .bar|div .site .header p",
    "footer": "footer|div .footer|div .footer p|footer p|div .copyright|footer ul li|div .site .footer div",
    "sidebar": "aside|div .sidebar|div .related ul li|div .widget|aside p|aside ul li|div .sidebar div .widget p|div .side .col h3",
    "notice": "div .cookie|div .notice|div .banner|div .gdpr p|div .alert|div .consent|div .popup p|div .modal|div .message",
    "advert": "div .ad|div .ads|div .advert|aside .sponsored|div .promo p|div .advertisement|div .banner .ad|section .sponsor",
    "form": "form|form .newsletter p|div .search form|form div|div .subscribe form|form .login|form fieldset|button",
    "comments": "section .comments|div .comments div .comment p|ol .commentlist li p|article .comment|div .comment .body|section .comments article p|ul .comments li|div .reply|div .discussion p|section .responses p|h3 .comments",
    "share": "div .share|ul .social li|div .tags|div .author .bio|div .byline|p .meta",
}
_BEFORE = ("header", "menu", "notice", "advert", "form", "sidebar")
_AFTER = ("comments", "sidebar", "advert", "form", "footer", "menu", "notice", "share")


def _lay_out(texts: list[str], words: np.ndarray, random: np.random.Generator):
    """Paths, texts, link shares and labels of a page with the texts as its main text."""
    rows: list[tuple[tuple[str, ...], str, float, float]] = []

    def pick(options: str) -> tuple[str, ...]:
        return tuple(random.choice(options.split("|")).split(" "))

    def other(kind: str, around: tuple[str, ...]) -> None:
        wrap, many = pick(_OTHER[kind]), kind in ("menu", "comments", "sidebar", "share")
        for _ in range(int(random.integers(1, 8)) if many else int(random.integers(1, 3))):
            most = {"menu": 4, "comments": 80, "sidebar": 40, "advert": 40}.get(kind, 24)
            text = " ".join(random.choice(words, int(random.integers(1, most))))
            link = 1.0 if kind == "menu" else float(random.random() < 0.3)
            rows.append((around + wrap, text, link, 0.0))

    body = ("html", "body") + (pick("div .wrap|div .page|div .container") if random.random() < 0.3 else ())
    main = body + pick(_MAIN)
    for kind in _BEFORE:
        if random.random() < 0.4:
            other(kind, body)
    leaves = ["p"] if random.random() < 0.6 else _MAIN_LEAVES.split("|")
    noise = random.choice([0.0, 0.02, 0.1])
    for number, text in enumerate(texts):
        leaf = "h1" if not number and random.random() < 0.8 else str(random.choice(leaves))
        around = main + (("ul",) if leaf == "li" else ())
        rows.append((around if random.random() < 0.05 else around + (leaf,), text, float(random.random() < 0.02), 1.0))
        if random.random() < noise:
            other(str(random.choice(["advert", "share", "form", "sidebar", "notice"])), main)
    if random.random() < 0.25:
        other("comments", main)
    for kind in _AFTER:
        if random.random() < 0.4:
            other(kind, body)
    return rows


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(steps, pages, INPUT) and the mask of the steps each page has."""
    longest = max(len(r) for r in rows)
    inputs = np.zeros((longest, len(rows), INPUT), np.float32)
    mask = np.zeros((longest, len(rows)), np.float32)
    for page, row in enumerate(rows):
        inputs[: len(row), page], mask[: len(row), page] = row, 1
    return inputs, mask


def _features(paths: list[tuple[str, ...]], texts: list[str], links: list[float], kept: dict) -> np.ndarray:
    if len(kept) > 20_000:
        kept.clear()
    rows = []
    for path in paths:
        vector = kept.get(path)
        if vector is None:
            vector = kept[path] = path_vector(path)
        rows.append(vector)
    link = np.array(links, np.float32)[:, None]
    return np.concatenate([np.stack(rows), word_vectors(texts), link], axis=1)


def material(blocks: Blocks, page: str) -> tuple[list[str], list[str]] | None:
    """Some text blocks and words of a page to train on, of bounded size; None if it has no text."""
    paths, texts, _ = blocks.cut(page)
    if not texts:
        return None
    main = [t for p, t in zip(paths, texts, strict=True) if "article" in p or "main" in p] or texts
    main = [t[:BLOCK_CHARS] for t in main]
    every, room, chosen = -(-sum(map(len, main)) // SAMPLE_CHARS), SAMPLE_CHARS, []
    for number, text in enumerate(main):
        if room > 0 and not number // RUN % every:
            chosen.append(text)
            room -= len(text)
    words = (word[:WORD_CHARS] for text in texts for word in text.split())
    return chosen, list(itertools.islice(words, SAMPLE_WORDS))


def train(samples: list[tuple[list[str], list[str]]]) -> BiLstm | None:
    """The labeller, from the ``material`` of some pages; None without any."""
    if not samples:
        return None
    random = np.random.default_rng(SEED)
    mains = [main for main, _ in samples]
    words = [word for _, own in samples for word in own]
    rows, labels, kept = [], [], {}
    vocabulary = np.array(words)
    everything = [text for main in mains for text in main]
    for _ in range(max(LAYOUTS, -(-LEAST_LAYOUTS // len(mains)))):
        for main in mains:
            size = int(np.exp(random.uniform(0, np.log(LONGEST))))
            more = [everything[i] for i in random.integers(0, len(everything), max(0, size - len(main)))]
            made = _lay_out([*main, *more][:size], vocabulary, random)
            rows.append(_features([r[0] for r in made], [r[1] for r in made], [r[2] for r in made], kept))
            labels.append(np.array([r[3] for r in made], np.float32))
    model = BiLstm(random)
    values = [*model.weights, model.out]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(rows))
        order = order[np.argsort([len(rows[i]) // 8 for i in order], kind="stable")]
        batches = [order[i : i + 32] for i in range(0, len(order), 32)]
        for at in random.permutation(len(batches)):
            inputs, mask = _padded([rows[i] for i in batches[at]])
            wanted = np.zeros_like(mask)
            for page, i in enumerate(batches[at]):
                wanted[: len(labels[i]), page] = labels[i]
            step += 1
            rate = 0.02 if epoch < EPOCHS * 2 // 3 else 0.005
            for value, slope, m, v in zip(values, model.gradients(inputs, mask, wanted), first, second, strict=True):
                m += 0.1 * (slope - m)
                v += 0.01 * (slope**2 - v)
                value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return model


class Extractor:
    def __init__(self, model: BiLstm):
        self.model, self.blocks, self.paths = model, Blocks(), {}

    def texts(self, pages: list[str]) -> list[str]:
        """Main text of each page."""
        cut = [self.blocks.cut(page) for page in pages]
        found = [""] * len(pages)
        for some in _groups([len(c[0]) for c in cut]):

            def part(a: int, b: int, some: list[int] = some) -> tuple[np.ndarray, np.ndarray]:
                own = [[cut[i][k][a:b] for k in range(3)] for i in some]
                whole = _features(*([x for o in own for x in o[k]] for k in range(3)), self.paths)
                edges = np.cumsum([len(o[0]) for o in own])[:-1]
                return _padded(np.split(whole, edges))

            scores = self.model.scores(len(cut[some[-1]][0]), len(some), part)
            for place, i in enumerate(some):
                found[i] = " ".join(t for t, s in zip(cut[i][1], scores[:, place].tolist()) if s >= 0)
        return found


def _groups(sizes: list[int]) -> Iterator[list[int]]:
    """Numbers of the pages that have blocks, in groups of like size that are small enough when padded; the longest is last."""
    group: list[int] = []
    for i in sorted((i for i, size in enumerate(sizes) if size), key=lambda i: sizes[i]):
        if group and (len(group) == _TOGETHER or sizes[i] * (len(group) + 1) > WINDOW_STEPS):
            yield group
            group = []
        group.append(i)
    if group:
        yield group


def main_text(page: Column | str, model: BiLstm | None) -> Column:
    """Struct of text and n_chars; a null page counts as empty."""
    kept: list[Extractor] = []

    def apply(array: pa.Array) -> pa.Array:
        texts: list[str] = []
        if model is None:
            texts = [""] * len(array)
        else:
            if not kept:
                kept.append(Extractor(model))
            for start, end in pieces(array):
                texts += kept[0].texts([p or "" for p in array.slice(start, end - start).to_pylist()])
        columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.StructArray.from_arrays(columns, EXTRACTED.fieldNames())

    return F.arrow_udf(apply, returnType=EXTRACTED)(page)


def _material(page: Column | str) -> Column:
    """Struct of the texts and words of ``material``; null for a page without text."""
    blocks = Blocks()

    def apply(array: pa.Array) -> pa.Array:
        found = (material(blocks, page) if page else None for page in (x.as_py() for x in array))
        return pa.array([f and dict(zip(MATERIAL.fieldNames(), f, strict=True)) for f in found], _MATERIAL_ARROW)

    return F.arrow_udf(apply, returnType=MATERIAL)(page)


def fit(pages: DataFrame) -> BiLstm | None:
    """The labeller of a table of pages, from at most SAMPLE_PAGES of them; None only if no page has a text."""
    hashed = pages.filter(F.length("html") > 0).select(F.xxhash64("page_id").alias("hash"), "page_id", "html")
    least = [r.hash for r in hashed.select("hash").orderBy("hash").limit(SAMPLE_PAGES).collect()]
    if not least:
        return None
    # Where the pages of least hash have no text, those that have one are looked for among all.
    for some in (hashed.filter(F.col("hash") <= least[-1]), hashed):
        cut = some.select("hash", "page_id", _material("html").alias("made")).filter("made is not null")
        rows = cut.orderBy("hash", "page_id", F.xxhash64("made")).limit(SAMPLE_PAGES).collect()
        if rows:
            return train([(r.made.texts, r.made.words) for r in rows])
    return None


def html_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Blocks of the main text, with character references decoded and white space as single spaces, joined
    by one space. A null or empty page, or one without main text, has an empty text. Repeated rows and null ids each
    give a row; other columns are left out. No rows give none.
    """
    chosen = short_batches(pages).select("page_id", "url", "html")
    made = chosen.select("page_id", "url", main_text("html", fit(chosen)).alias("made"))
    return made.select("page_id", "url", "made.text", "made.n_chars")
