"""Main text of HTML pages, by a recurrent labeller of the page's text blocks.

A page is cut into leaf blocks: runs of text between block-level tags. Each block has a vector of its
tag path (tags, class and id words of all open elements, hashed), of its words (hashed) and of a few
shares. A bidirectional LSTM in numpy reads all blocks of the page in both directions and says of each
whether it belongs to the article. It is trained on pages laid out from sampled blocks in many ways, so
that each block's label is known; the sample's own pages come along, labelled by their semantic tags.

Character references are decoded, white space in a block becomes one blank, blocks are joined by an empty
line in page order. A null or empty page has an empty text. Each row gives one row; other columns are left
aside. A page table without any text trains on placeholder words only.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.llm.texts import WordCache, rows_of, sized
from lotflow.shipping import ship

#: Bound of the training sample, pages laid out from it, and sizes of the network.
SAMPLE_PAGES, LAID_OUT, PATH_SIZE, WORD_SIZE, HIDDEN = 120, 600, 96, 32, 20
EPOCHS, BATCH, RATE, SEED = 9, 32, 1e-2, 11
PARAGRAPH = "\n\n"

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"<]*"|'[^'<]*'|["'])*+)(?:>|\Z))""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# How HTML's elements behave.
_RAW = frozenset("script style noscript template textarea title iframe".split())
# elements with tags inside, whose text is not the page's; the first two may close themselves
_FOREIGN = frozenset("svg math".split())
_SILENT = _FOREIGN | frozenset("select option button object canvas audio video datalist".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
# in these a foreign element holds the page's own kind of tags; elsewhere a block that begins in one ends it
_HOLDS_HTML = frozenset("foreignobject desc title annotation-xml".split())
_CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}


@dataclass
class Block:
    text: str
    path: np.ndarray
    leaf: str
    linked: float
    names: frozenset[str]


@lru_cache(maxsize=20_000)
def _signature(tag: str, attributes: str) -> tuple[tuple[int, ...], frozenset[str]]:
    """Hashed places of an element in the path vector, and its words."""
    words = {tag}
    for found in _NAMES.finditer(attributes):
        words.update(word.lower() for word in _NAME_WORD.findall("".join(filter(None, found.groups()))))
    return tuple(sorted({zlib.crc32(word.encode()) % PATH_SIZE for word in words})), frozenset(words)


def blocks_of(page: str | None, with_names: bool = False) -> list[Block]:
    """Leaf blocks of a page in order; text of scripts, styles and the like is none.

    ``with_names`` adds the words of the open elements, which only training looks at.
    """
    page = page or ""
    found: list[Block] = []
    stack: list[tuple[str, tuple[int, ...], frozenset[str]]] = []
    open_path = np.zeros(PATH_SIZE, dtype=np.int32)
    pieces: list[str] = []
    opened: dict[str, list[int]] = {}  # places in the stack by tag
    blocks_open: list[int] = []
    silent_open: list[int] = []
    open_words: Counter[str] = Counter()
    linked = total = links = at = 0

    def flush() -> None:
        nonlocal linked, total
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        if text:
            leaf = stack[blocks_open[-1]][0] if blocks_open else "body"
            names = frozenset(open_words)
            found.append(Block(text, np.minimum(open_path, 1).astype(np.float32), leaf, linked / max(1, total), names))
        pieces.clear()
        linked = total = 0

    def close(down_to: int) -> None:
        nonlocal links
        for tag, places, words in reversed(stack[down_to:]):
            open_path[list(places)] -= 1
            links -= tag == "a"
            opened[tag].pop()
            if with_names:
                open_words.subtract(words)
                for word in words:
                    if not open_words[word]:
                        del open_words[word]
        del stack[down_to:]
        for held in (blocks_open, silent_open):
            while held and held[-1] >= down_to:
                held.pop()

    def add(text: str) -> None:
        nonlocal linked, total
        if text and not silent_open:
            pieces.append(text)
            total += len(text)
            linked += len(text) * (links > 0)

    while at < len(page):
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        add(page[at : tag.start()])
        at = tag.end()
        name = (tag.group(2) or "").lower()
        if not name:
            continue
        if tag.group(1):
            depth = opened[name][-1] if opened.get(name) else None
            if name in _BLOCK and (not silent_open or depth is not None and depth < silent_open[0]):
                flush()
            elif name == "br" and not silent_open:
                pieces.append(" ")
            if depth is not None:
                close(depth)
            continue
        foreign = max((opened[outer][-1] for outer in _FOREIGN if opened.get(outer)), default=-1)
        if foreign >= 0 and name in _BLOCK and max((opened[inner][-1] for inner in _HOLDS_HTML if opened.get(inner)), default=-1) < foreign:
            close(min(opened[outer][0] for outer in _FOREIGN if opened.get(outer)))
            foreign = -1
        if (name in _FOREIGN or foreign >= 0) and (tag.group(3) or "").endswith("/"):
            continue
        if stack and stack[-1][0] == "option" and (name in _BLOCK or name in ("option", "optgroup")):
            close(len(stack) - 1)
        if name in _BLOCK and not silent_open:
            flush()
        elif name == "br" and not silent_open:
            pieces.append(" ")
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            closing = page.find(">", end.start()) if end else -1
            at = closing + 1 if closing >= 0 else len(page)
            continue
        if name in _VOID:
            continue
        if name in _BLOCK and blocks_open and (not silent_open or blocks_open[-1] > silent_open[-1]):
            # an open paragraph ends where a block begins, an open item where the next one does
            inner = stack[blocks_open[-1]][0]
            if inner == "p" or inner == name and name in _CLOSES or {inner, name} <= {"dt", "dd"} or {inner, name} <= {"td", "th"}:
                close(blocks_open[-1])
        places, words = _signature(name, tag.group(3) or "")
        opened.setdefault(name, []).append(len(stack))
        if name in _BLOCK:
            blocks_open.append(len(stack))
        if name in _SILENT:
            silent_open.append(len(stack))
        if with_names:
            open_words.update(words)
        stack.append((name, places, words))
        open_path[list(places)] += 1
        links += name == "a"
    flush()
    return found


_LEAVES = ("p", "h1", "h2", "h3", "li", "div", "td", "blockquote")
N_SHARES = len(_LEAVES) + 7
N_INPUT = PATH_SIZE + WORD_SIZE + N_SHARES


_word_places = WordCache(lambda word: zlib.crc32(word.encode()) % WORD_SIZE, 50_000)


def vectors(blocks: list[Block]) -> np.ndarray:
    """A row of inputs for each block."""
    rows = np.zeros((len(blocks), N_INPUT), dtype=np.float32)
    for row, block in zip(rows, blocks):
        words = block.text.lower().split()
        row[:PATH_SIZE] = block.path
        counts = np.bincount([_word_places[word] for word in words], minlength=WORD_SIZE)
        row[PATH_SIZE : PATH_SIZE + WORD_SIZE] = np.sqrt(counts / len(words))
        size = len(block.text)
        shares = [block.leaf == leaf for leaf in _LEAVES]
        marks = sum(map(block.text.count, ".,;:!?"))
        row[PATH_SIZE + WORD_SIZE :] = [
            *shares, block.linked, np.log1p(len(words)) / 5, np.log1p(size) / 8, marks / size * 10,
            block.text[-1] in ".!?", "©" in block.text, sum(map(str.isdigit, block.text[:64])) / 64,
        ]
    return rows


class Lstm:
    """One direction: gates i, f, o and g side by side in the weights."""

    def __init__(self, random: np.random.Generator):
        self.inputs = random.normal(0, 1 / np.sqrt(N_INPUT), (N_INPUT, 4 * HIDDEN)).astype(np.float32)
        self.state = random.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.bias = np.zeros(4 * HIDDEN, dtype=np.float32)
        self.bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first

    def run(self, rows: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """``rows``: steps x pages x inputs; past a page's end its state stays as it is."""
        steps, pages, _ = rows.shape
        hidden, cell = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        driven = rows @ self.inputs + self.bias
        for step in range(steps):
            gates = driven[step] + hidden @ self.state
            sigma = 1 / (1 + np.exp(-np.clip(gates[:, : 3 * HIDDEN], -30, 30)))
            i, f, o, g = sigma[:, :HIDDEN], sigma[:, HIDDEN : 2 * HIDDEN], sigma[:, 2 * HIDDEN :], np.tanh(gates[:, 3 * HIDDEN :])
            live = mask[step][:, None]
            fresh = f * cell + i * g
            squashed = np.tanh(fresh)
            if keep is not None:
                keep.append((hidden, cell, i, f, o, g, squashed, live))
            hidden, cell = np.where(live, o * squashed, hidden), np.where(live, fresh, cell)
            out[step] = hidden
        return out

    def back(self, rows: np.ndarray, kept: list, by_out: np.ndarray) -> list[np.ndarray]:
        """Slopes of the weights, from the slopes of the outputs."""
        by_state, by_bias = np.zeros_like(self.state), np.zeros_like(self.bias)
        by_gates = np.zeros((len(kept), rows.shape[1], 4 * HIDDEN), np.float32)
        by_hidden, by_cell = np.zeros_like(by_out[0]), np.zeros_like(by_out[0])
        for step in range(len(kept) - 1, -1, -1):
            hidden, cell, i, f, o, g, squashed, live = kept[step]
            by_hidden = by_hidden + by_out[step]
            on = by_hidden * live
            into = by_cell * live + on * o * (1 - squashed**2)
            gates = np.concatenate([into * g * i * (1 - i), into * cell * f * (1 - f), on * squashed * o * (1 - o), into * i * (1 - g**2)], axis=1)
            by_gates[step] = gates
            by_state += hidden.T @ gates
            by_bias += gates.sum(axis=0)
            by_hidden = gates @ self.state.T + by_hidden * ~live
            by_cell = into * f + by_cell * ~live
        by_inputs = np.tensordot(rows, by_gates, axes=([0, 1], [0, 1]))
        return [by_inputs, by_state, by_bias]


class Labeller:
    """Both directions and a logistic output on their states."""

    def __init__(self, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.ahead, self.behind = Lstm(random), Lstm(random)
        self.top = random.normal(0, 0.3, 2 * HIDDEN).astype(np.float32)
        self.shift = np.zeros(1, np.float32)

    def _weights(self) -> list[np.ndarray]:
        return [w for part in (self.ahead, self.behind) for w in (part.inputs, part.state, part.bias)] + [self.top, self.shift]

    @staticmethod
    def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pages side by side, in order and each turned round, and where they have blocks."""
        steps = max(map(len, pages))
        rows, turned = np.zeros((2, steps, len(pages), N_INPUT), np.float32)
        mask = np.zeros((steps, len(pages)), bool)
        for n, page in enumerate(pages):
            rows[: len(page), n], turned[: len(page), n], mask[: len(page), n] = page, page[::-1], True
        return rows, turned, mask

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Of each block of each page; pages of similar length are read together."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((n for n in range(len(pages)) if len(pages[n])), key=lambda n: len(pages[n]))
        at = 0
        while at < len(order):
            some = order[at : at + (BATCH * 2 if len(pages[order[min(at + BATCH * 2, len(order)) - 1]]) < 2000 else 1)]
            at += len(some)
            rows, turned, mask = self.padded([pages[n] for n in some])
            one, two = self.ahead.run(rows, mask), self.behind.run(turned, mask)
            for place, n in enumerate(some):
                size = len(pages[n])
                both = np.concatenate([one[:size, place], two[:size, place][::-1]], axis=1)
                out[n] = 1 / (1 + np.exp(-np.clip(both @ self.top + self.shift, -30, 30)))
        return out

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> Labeller:
        random = np.random.default_rng(SEED)
        weights = self._weights()
        mean, square, count = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for _ in range(EPOCHS):
            for some in np.array_split(random.permutation(len(pages)), max(1, len(pages) // BATCH)):
                some = [n for n in some if len(pages[n])]
                if not some:
                    continue
                rows, turned, mask = self.padded([pages[n] for n in some])
                keep_one, keep_two = [], []
                one, two = self.ahead.run(rows, mask, keep_one), self.behind.run(turned, mask, keep_two)
                by_one, by_two = np.zeros_like(one), np.zeros_like(two)
                by_top, by_shift, blocks = np.zeros_like(self.top), np.zeros(1, np.float32), mask.sum()
                for place, n in enumerate(some):
                    size = len(pages[n])
                    both = np.concatenate([one[:size, place], two[:size, place][::-1]], axis=1)
                    guess = 1 / (1 + np.exp(-np.clip(both @ self.top + self.shift, -30, 30)))
                    off = ((guess - labels[n]) / blocks).astype(np.float32)
                    by_top += both.T @ off
                    by_shift += off.sum()
                    by_one[:size, place] = off[:, None] * self.top[:HIDDEN]
                    by_two[:size, place] = (off[:, None] * self.top[HIDDEN:])[::-1]
                slopes = self.ahead.back(rows, keep_one, by_one) + self.behind.back(turned, keep_two, by_two) + [by_top, by_shift]
                norm = np.sqrt(sum(float((s**2).sum()) for s in slopes))
                count += 1
                for n, slope in enumerate(slopes):
                    slope = slope * min(1.0, 1.0 / (norm + 1e-9))
                    mean[n] = 0.9 * mean[n] + 0.1 * slope
                    square[n] = 0.999 * square[n] + 0.001 * slope**2
                    weights[n] -= RATE * (mean[n] / (1 - 0.9**count)) / (np.sqrt(square[n] / (1 - 0.999**count)) + 1e-8)
        return self


# How pages name their parts. Each is a tag and words of its class.
_MAIN = [("article", ""), ("main", ""), ("article", "post"), ("div", "content"), ("div", "main-content"), ("div", "article-body"), ("div", "post-content"), ("section", "entry-content"), ("div", "story text"), ("div", "entry")]
_ASIDE = [
    ("nav", ""), ("nav", "menu"), ("div", "menu"), ("ul", "menu"), ("ul", "nav"), ("div", "navbar"), ("div", "breadcrumb"), ("header", ""), ("div", "header"), ("footer", ""),
    ("div", "footer"), ("aside", ""), ("div", "sidebar"), ("aside", "sidebar"), ("div", "widget"), ("div", "related"), ("div", "ad"), ("div", "ads"), ("div", "advert"),
    ("div", "ad-banner"), ("div", "banner"), ("div", "sponsored"), ("div", "promo"), ("div", "cookie-notice"), ("div", "cookie consent"), ("div", "notice"), ("div", "popup"),
    ("div", "modal"), ("form", ""), ("form", "search"), ("div", "newsletter subscribe"), ("div", "social share"), ("div", "comments"), ("section", "comments"), ("div", "comment"),
    ("ol", "comment-list"), ("div", "respond reply"), ("div", "copyright"), ("div", "legal"), ("div", "toolbar"), ("div", "pagination"), ("div", "tags"), ("div", "author-bio"), ("div", "skip login"),
]
_ASIDE_WORDS = frozenset(
    "nav menu navbar breadcrumb footer aside sidebar widget related ad ads advert banner sponsored promo cookie consent notice popup modal form "
    "newsletter subscribe social share comments comment respond reply copyright pagination".split()
)


def semantic_labels(blocks: list[Block]) -> np.ndarray | None:
    """Labels that a page's own semantic tags give, or None where it has no article or main element."""
    if not any(block.names & {"article", "main"} for block in blocks):
        return None
    return np.array([bool(block.names & {"article", "main"}) and not block.names & _ASIDE_WORDS for block in blocks], dtype=np.float32)


def laid_out(texts: list[str], random: np.random.Generator) -> tuple[str, set[str]]:
    """A page built from the given texts, and the texts that are its article."""

    def pick(options: list):
        return options[int(random.integers(len(options)))]

    def element(tag: str, names: str, inside: str) -> str:
        shown = f' {pick(["class", "class", "id"])}="{names}"' if names else ""
        return f"<{tag}{shown}>{inside}</{tag}>"

    serial = 0

    def said(short: bool = False) -> str:
        nonlocal serial
        serial += 1
        words = pick(texts).split(maxsplit=60)
        words = words[: int(random.integers(1, 4))] if short else words[: int(random.integers(3, 60))]
        return html.escape(" ".join([*words, f"~{serial}"]))  # the number tells equal texts apart, and is taken off again

    def aside() -> str:
        tag, names = pick(_ASIDE)
        style = int(random.integers(4))
        if tag in ("ul", "ol") or style == 0 or tag == "nav":
            rows = "".join(f'<li><a href="/x">{said(True)}</a></li>' for _ in range(int(random.integers(2, 8))))
            return element(tag, names, rows if tag in ("ul", "ol") else f"<ul>{rows}</ul>")
        inside = {1: lambda: said(), 2: lambda: f"<p>{said()}</p>" * 1 + f"<p>{said()}</p>", 3: lambda: f"<h3>{said(True)}</h3><p>{said()}</p><a href='/x'>{said(True)}</a>"}[style]()
        return element(tag, names, inside)

    main: list[str] = []

    def own(tag: str, short: bool = False) -> str:
        text = said(short)
        main.append(html.unescape(text))
        inside = f"<b>{text}" + pick(["</b>", "<br>"]) if random.random() < 0.1 else text
        return f"<{tag}>{inside}" + (f"</{tag}>" if random.random() < 0.9 or tag != "p" else "")

    body = [own("h1", random.random() < 0.5)] if random.random() < 0.8 else []
    for _ in range(int(random.integers(1, 14))):
        kind = random.random()
        if kind < 0.8:
            body.append(own("p"))
        elif kind < 0.86:
            body.append(own("h2", True))
        elif kind < 0.91:
            body.append("<ul>" + "".join(own("li") for _ in range(int(random.integers(1, 5)))) + "</ul>")
        elif kind < 0.94:
            body.append(own("blockquote"))
        else:
            body.append(aside())
    tag, names = pick(_MAIN)
    inside = "".join(body) + (aside() if random.random() < 0.25 else "")
    article = element(tag, names, inside)
    if random.random() < 0.4:
        article = element("div", pick(["wrapper", "container", "page", "row", "layout"]), article + (aside() if random.random() < 0.5 else ""))
    before = "".join(aside() for _ in range(int(random.integers(0, 4))))
    after = "".join(aside() for _ in range(int(random.integers(0, 4))))
    return f"<html><head><title>x</title></head><body>{before}{article}{after}</body></html>", set(main)


def train(pages: list[str | None]) -> Labeller:
    """Fit on laid-out pages and on those of the sample whose own tags tell the article."""
    random = np.random.default_rng(SEED)
    real = [blocks_of(page, with_names=True) for page in pages]
    texts = [block.text for blocks in real for block in blocks if len(block.text) > 20] or ["one two three four five six seven eight nine ten"]
    rows, labels = [], []
    for blocks in real:
        own = semantic_labels(blocks)
        if own is not None:
            rows.append(vectors(blocks))
            labels.append(own)
    for _ in range(LAID_OUT):
        page, main = laid_out(texts, random)
        blocks = blocks_of(page)
        labels.append(np.array([block.text in main for block in blocks], dtype=np.float32))
        for block in blocks:
            block.text = re.sub(r"\s?~\d+", "", block.text) or "x"
        rows.append(vectors(blocks))
    return Labeller().fit(rows, labels)


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Labeller:
    """Train on the ``SAMPLE_PAGES`` pages whose ids have the smallest hashes."""
    ids = pages.select(F.col(id_col).alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PAGES)
    sample = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).join(ids, "id").orderBy("id", "html").limit(SAMPLE_PAGES)
    return train([row["html"] for row in sample.select("html").collect()])


def main_texts(pages: DataFrame, model: Labeller, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Per row: id, the kept columns, text, n_chars."""
    sent = pages.sparkSession.sparkContext.broadcast(model)
    names = [id_col, *keep]
    fields = ", ".join(f"`{name}` {pages.schema[name].dataType.simpleString()}" for name in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = sent.value
        for batch in batches:
            schema = pa.schema([*[(name, batch.column(name).type) for name in names], ("text", pa.string()), ("n_chars", pa.int64())])

            def rows() -> Iterator[tuple]:
                for held in rows_of([batch], *names, "__html"):
                    for at in range(0, len(held), 256):
                        some = held[at : at + 256]
                        parsed = [blocks_of(row[-1]) for row in some]
                        for row, blocks, chances in zip(some, parsed, labeller.probabilities([vectors(blocks) for blocks in parsed])):
                            text = PARAGRAPH.join(block.text for block, chance in zip(blocks, chances) if chance >= 0.5)
                            yield *row[:-1], text, len(text)

            yield from sized(rows(), schema)

    ship(pages.sparkSession)
    return pages.select(*names, F.col(html_col).alias("__html")).mapInArrow(run, f"{fields}, text string, n_chars long")
