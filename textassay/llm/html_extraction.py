"""Main text of web pages by a recurrent block labeller.

A page is read as the sequence of its leaf blocks. Each block has the hashed tokens of its tag path (tag names, words of
class, id, role and itemprop of all its ancestors), the hashed words of its text, and a few figures. Inline elements that carry
such words count for a block whose text lies in them as a whole. Pages are scanned in linear time. A numpy
bidirectional LSTM reads the whole sequence, so every block is judged with the page around it.

There are no labels for pages. The labeller is taught on a bounded sample (``SAMPLE`` pages by hash of the id):
their paragraphs are set into layouts drawn at random (main text in article, main or named containers; menus, headers,
sidebars, notices, adverts, forms, comments and footers around and within it), whose blocks are known by
construction, along with the sampled pages as they are, whose blocks are labelled by the plain meaning of their
elements. Where there are fewer than ``LEAST`` pages to teach from, layouts around built-in sentences make up for them. Extraction then runs page by page in Arrow batches, pages of like length together.

Defined cases: null or empty html, and pages without a main block, give an empty text; broken and unclosed tags are
read on to the end; a page of any length is read whole; rows stay rows, and an empty table gives an empty table.
Columns other than the ids, url and html are not read.
"""

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textassay.llm.common import whole

SAMPLE = 240
SAMPLE_CHARS = 60_000  # longer pages are not taught from; they are extracted like all others
PATH_SLOTS, WORD_SLOTS = 2048, 1024
PATH_SIZE, WORD_SIZE, HIDDEN = 16, 6, 20
FIGURES = 5
EPOCHS = 12
LEAST = 120
SENTENCES = (
    "The river rose for three days before anyone thought to move the boats.",
    "She measured the beams twice and wrote the numbers on the wall.",
    "Most of the town had left by then, and the rest were packing.",
    "A warm wind came over the hills and dried the fields within a week.",
    "Nobody could say who had built the bridge or when.",
    "The museum keeps the original drawings, which are shown once a year.",
    "In winter the road is closed, and letters arrive by train.",
    "He explained the method slowly, with an example for each step.",
    "Prices fell in spring; by autumn they were where they had been.",
    "The committee met on Tuesday and agreed on very little.",
    "Two of the engines were tested again, with the same result.",
    "It takes about an hour to walk from the station to the old mill.",
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^'\">]|\"[^\"]*\"|'[^']*')*)>|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^>]*)>",
    re.S,
)
_BOGUS = re.compile(r"(?P<close>)(?P<name>)(?P<name2>)<![^>]*>")
_ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z0-9]+")
# Elements, as fixed classes of HTML.
HIDDEN_ELEMENTS = frozenset("script style noscript template textarea select option datalist button iframe object svg math canvas head title".split())
RAW_ELEMENTS = frozenset("script style textarea title noscript iframe".split())
VOID_ELEMENTS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE_ELEMENTS = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr br img input".split()
)
CLOSED_BY_NEXT = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "p": "p"}


class Path(NamedTuple):
    """What is known of the elements around a text: hashed tokens of all of them, the last token, and two plain meanings."""

    slots: frozenset[int] = frozenset()
    leaf: str = ""
    inside: bool = False
    outside: bool = False

    def below(self, name: str, words: list[str], inline: bool) -> "Path":
        tokens = words if inline else [name, *words]
        slots = {crc32(t.encode("utf-8", "surrogatepass")) % PATH_SLOTS for t in tokens}
        return Path(
            self.slots if slots <= self.slots else self.slots | slots, tokens[-1],
            self.inside or not INSIDE.isdisjoint(tokens), self.outside or not OUTSIDE.isdisjoint(tokens),
        )


# Plain meanings of elements and class names, from which the sampled pages are labelled.
INSIDE = frozenset({"article", "main"})
OUTSIDE = frozenset({"nav", "header", "footer", "aside", "form"} | {"." + w for w in ("ad", "ads", "advert", "sidebar", "menu", "comments", "comment", "cookie", "footer", "notice", "promo")})


def leaf_blocks(page: str) -> list[tuple[Path, str, int]]:
    """(path, text, characters within links) of the blocks of a page that have a text, in page order."""
    out: list[tuple[Path, str, int]] = []
    # Name, path, and depth of the nearest element at or below that is not inline.
    stack: list[tuple[str, Path, int]] = [("", Path(), 0)]
    opened: Counter[str] = Counter()
    hidden = links = linked = 0
    pieces: list[str] = []
    around: Path | None = None  # the path that all pieces with a text share; None before the first one
    mixed = False
    at, n = 0, len(page)
    last_end, last_section, last_comment = page.rfind(">"), page.rfind("]]>"), page.rfind("<!--")

    def close() -> None:
        nonlocal linked, around, mixed
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append((stack[stack[-1][2]][1] if mixed or around is None else around, text, linked))
            pieces.clear()
        linked, around, mixed = 0, None, False

    def say(raw: str) -> None:
        nonlocal linked, around, mixed
        if raw and not hidden:
            text = entities.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if links:
                linked += len(text)
            if not text.isspace():
                mixed = mixed or (around is not None and around is not stack[-1][1])
                around = stack[-1][1]

    def pop() -> None:
        nonlocal hidden, links
        name = stack.pop()[0]
        opened[name] -= 1
        hidden -= name in HIDDEN_ELEMENTS
        links -= name == "a"

    while at < n:
        start = page.find("<", at)
        if start < 0 or start > max(last_end, last_comment):
            say(page[at:])
            break
        found = None
        if start < last_end or page.startswith("<!--", start):
            if start > last_section and page.startswith("<![CDATA[", start):
                found = _BOGUS.match(page, start)
            else:
                found = _TOKEN.match(page, start)
        if found is None:
            say(page[at : start + 1])
            at = start + 1
            continue
        say(page[at:start])
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        inline = name in INLINE_ELEMENTS
        if not inline:
            close()
        elif name == "br" and not hidden:
            pieces.append(" ")
        if found["close"] or found["close2"]:
            if opened[name] > 0:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in VOID_ELEMENTS:
            continue
        rest = found["rest"] or found["rest2"] or ""
        if name in CLOSED_BY_NEXT or not inline:
            depth = stack[-1][2]
            if depth and stack[depth][0] in CLOSED_BY_NEXT.get(name, "p").split():
                while len(stack) > depth:
                    pop()
        words = ["." + w for quoted, single, bare in _ATTRIBUTE.findall(rest) for w in _NAME.findall((quoted or single or bare).lower())]
        parent = stack[-1][1]
        path = parent if inline and not words else parent.below(name, words, inline)
        if rest.endswith("/") and name in ("svg", "path", "iframe"):
            continue
        stack.append((name, path, stack[-1][2] if inline else len(stack)))
        opened[name] += 1
        hidden += name in HIDDEN_ELEMENTS
        links += name == "a"
        if name in RAW_ELEMENTS:
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            pop()
    close()
    return out


@lru_cache(maxsize=1 << 12)
def _path_slots(path: Path) -> tuple[int, ...]:
    leaf = {crc32(("leaf:" + path.leaf).encode("utf-8", "surrogatepass")) % PATH_SLOTS} if path.leaf else set()
    return tuple(sorted(path.slots | leaf)) or (0,)


def inputs(blocks: list[tuple[Path, str, int]]) -> tuple[list[tuple[int, ...]], list[np.ndarray], np.ndarray]:
    """Path slots, word slots and figures of each block of a page."""
    paths, words, figures = [], [], np.zeros((len(blocks), FIGURES), np.float32)
    for i, (path, text, linked) in enumerate(blocks):
        tokens = text.encode("utf-8", "surrogatepass").lower().split()
        paths.append(_path_slots(path))
        words.append(np.array([crc32(w) % WORD_SLOTS for w in tokens] or [0]))
        marks = text.count(".") + text.count("!") + text.count("?")
        figures[i] = (np.log1p(len(tokens)) / 4, min(linked / len(text), 1.0), min(marks / max(len(tokens), 1), 1.0), text[-1:] in ".!?\"'", i / max(len(blocks) - 1, 1))
    return paths, words, figures


class BlockLabeller:
    """Embeddings, a forward and a backward LSTM, and a logistic output per block."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        size = PATH_SIZE + WORD_SIZE + FIGURES
        self.p = {"paths": rng.normal(0, 0.3, (PATH_SLOTS, PATH_SIZE)), "words": rng.normal(0, 0.1, (WORD_SLOTS, WORD_SIZE))}
        for side in ("f", "b"):
            self.p["w" + side] = rng.normal(0, 0.25, (size + HIDDEN, 4 * HIDDEN))
            self.p["c" + side] = np.append(np.zeros(HIDDEN), np.append(np.ones(HIDDEN), np.zeros(2 * HIDDEN)))
        self.p["out"] = rng.normal(0, 0.3, 2 * HIDDEN + size)
        self.p["bias"] = np.zeros(1)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def embed(self, page) -> np.ndarray:
        paths, words, figures = page
        by_path = np.array([self.p["paths"][list(s)].mean(axis=0) for s in paths])
        flat = np.concatenate(words)
        starts = np.cumsum([0, *map(len, words[:-1])])
        by_word = np.add.reduceat(self.p["words"][flat], starts, axis=0) / np.array([len(w) for w in words])[:, None]
        return np.column_stack([by_path, by_word, figures]).astype(np.float32)

    @staticmethod
    def _pad(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        longest = max(map(len, sequences))
        x = np.zeros((longest, len(sequences), sequences[0].shape[1]), np.float32)
        mask = np.zeros((longest, len(sequences), 1), np.float32)
        for i, s in enumerate(sequences):
            x[: len(s), i], mask[: len(s), i] = s, 1
        return x, mask

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool):
        """Hidden states in page order; padding leaves the state as it is."""
        steps = range(len(x)) if side == "f" else range(len(x) - 1, -1, -1)
        w, c = self.p["w" + side], self.p["c" + side]
        h = cell = np.zeros((x.shape[1], HIDDEN), np.float32)
        out, memory = np.zeros((*x.shape[:2], HIDDEN), np.float32), {}
        driven = x @ w[: x.shape[2]] + c
        for t in steps:
            gates = driven[t] + h @ w[x.shape[2] :]
            i, f, o = (1 / (1 + np.exp(-gates[:, k * HIDDEN : (k + 1) * HIDDEN])) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            new = f * cell + i * g
            tanh = np.tanh(new)
            if keep:
                memory[t] = (h, cell, i, f, o, g, tanh)
            cell = mask[t] * new + (1 - mask[t]) * cell
            h = mask[t] * (o * tanh) + (1 - mask[t]) * h
            out[t] = h
        return out, memory

    def scores(self, pages: list) -> list[np.ndarray]:
        """The probability of main text for each block of each page."""
        sequences = [self.embed(p) for p in pages]
        x, mask = self._pad(sequences)
        states = np.concatenate([self._run(x, mask, "f", False)[0], self._run(x, mask, "b", False)[0], x], axis=2)
        y = 1 / (1 + np.exp(-(states @ self.p["out"] + self.p["bias"])))
        return [y[: len(s), i] for i, s in enumerate(sequences)]

    def _gradients(self, pages: list, labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        sequences = [self.embed(p) for p in pages]
        x, mask = self._pad(sequences)
        runs = {side: self._run(x, mask, side, True) for side in ("f", "b")}
        states = np.concatenate([runs["f"][0], runs["b"][0], x], axis=2)
        y = 1 / (1 + np.exp(-(states @ self.p["out"] + self.p["bias"])))
        wanted, _ = self._pad([v[:, None].astype(np.float32) for v in labels])
        error = (y - wanted[:, :, 0]) * mask[:, :, 0] / mask.sum()
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["out"], grad["bias"] = np.einsum("tb,tbd->d", error, states), np.array([error.sum()], np.float32)
        back = error[:, :, None] * self.p["out"]
        into_x = back[:, :, 2 * HIDDEN :].copy()
        for n, side in enumerate(("f", "b")):
            own, w = back[:, :, n * HIDDEN : (n + 1) * HIDDEN], self.p["w" + side]
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t in reversed(range(len(x))) if side == "f" else range(len(x)):
                h, cell, i, f, o, g, tanh = runs[side][1][t]
                dh = dh + own[t]
                live = mask[t]
                d_out, kept_h, kept_c = dh * live, dh * (1 - live), dc * (1 - live)
                d_new = dc * live + d_out * o * (1 - tanh**2)
                gates = np.concatenate([d_new * g * i * (1 - i), d_new * cell * f * (1 - f), d_out * tanh * o * (1 - o), d_new * i * (1 - g**2)], axis=1)
                grad["w" + side][: x.shape[2]] += x[t].T @ gates
                grad["w" + side][x.shape[2] :] += h.T @ gates
                grad["c" + side] += gates.sum(axis=0)
                into_x[t] += gates @ w[: x.shape[2]].T
                dh, dc = gates @ w[x.shape[2] :].T + kept_h, d_new * f + kept_c
        for n, (paths, words, _) in enumerate(pages):
            for t, (slots, own) in enumerate(zip(paths, words, strict=True)):
                np.add.at(grad["paths"], list(slots), into_x[t, n, :PATH_SIZE] / len(slots))
                np.add.at(grad["words"], own, into_x[t, n, PATH_SIZE : PATH_SIZE + WORD_SIZE] / len(own))
        return grad

    def fit(self, pages: list, labels: list[np.ndarray], epochs: int = EPOCHS, batch: int = 24, seed: int = 12) -> "BlockLabeller":
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        step = 0
        for epoch in range(epochs):
            rate = 0.02 * (1 - epoch / epochs)
            order = rng.permutation(len(pages))
            for i in range(0, len(order), batch):
                step += 1
                rows = order[i : i + batch]
                for k, g in self._gradients([pages[j] for j in rows], [labels[j] for j in rows]).items():
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return self


# What the layouts are drawn from: elements and class names by the part they stand for.
_MAIN = ["article", "main", 'div class="content"', 'div class="post-body"', 'div id="main-content"', 'section class="story"', 'div class="entry-content"', 'div role="main"', 'div itemprop="articleBody"', "div", "td"]
_PARTS = {
    "menu": ["nav", 'ul class="menu"', 'div class="navigation"', 'div id="navbar"', 'div role="navigation"', 'div class="breadcrumb"', 'ol class="breadcrumbs"'],
    "header": ["header", 'div class="header"', 'div id="masthead"', 'div class="site-header banner"', 'div role="banner"'],
    "side": ["aside", 'div class="sidebar"', 'div class="related"', 'div class="widget"', 'section class="recommended"', 'div role="complementary"'],
    "notice": ['div class="cookie-notice"', 'div class="notice"', 'div id="consent"', 'div class="alert banner"', 'div class="cookie-banner" role="dialog"', 'p class="notice"'],
    "ad": ['div class="ad"', 'div class="advert"', 'div class="sponsored"', 'div class="promo"', 'ins class="adsbygoogle"', 'aside class="ad"', 'div class="ads banner"', 'div class="advertisement"', 'span class="advert"', 'span class="ad"', 'a class="sponsored"'],
    "form": ["form", 'form class="newsletter"', 'div class="subscribe"', 'form class="search"', 'form id="login"'],
    "comments": ['section class="comments"', 'div id="comments"', 'div class="comment-list"', 'ol class="discussion"', 'section class="comments reader"', 'div id="disqus_thread"', 'div class="responses"'],
    "footer": ["footer", 'div class="footer"', 'div id="footer"', 'div role="contentinfo"', 'div class="site-footer copyright"'],
}


def _end(opening: str) -> str:
    return f"</{opening.split()[0]}>"


def drawn_layout(paragraphs: list[str], rng: np.random.Generator) -> str:
    """A page of a random layout around the paragraphs. Main text carries a mark in front, \\x01, nothing else does."""
    words = " ".join(paragraphs).split() or ["a"]
    pick = lambda options: options[rng.integers(len(options))]

    def say(low: int, high: int) -> str:
        start = int(rng.integers(len(words)))
        return entities.escape(" ".join((words * 2)[start : start + int(rng.integers(low, high))]))

    def part(kind: str) -> str:
        opening = pick(_PARTS[kind])
        if kind == "menu":
            item = "li" if opening.startswith(("ul", "ol")) or rng.random() < 0.6 else "span" if rng.random() < 0.3 else "div"
            body = "".join(f"<{item}><a href=#>{say(1, 4)}</a></{item}>" for _ in range(rng.integers(2, 9)))
            body = f"<ul>{body}</ul>" if item == "li" and not opening.startswith(("ul", "ol")) else body
        elif kind == "comments":
            item = pick(['div class="comment"', 'article class="comment"', "li", 'div class="reply"'])
            text = lambda: f"<p>{say(2, 60)}</p>" if rng.random() < 0.7 else say(2, 60)
            body = f"<h3>{say(1, 4)}</h3>" * int(rng.random() < 0.7) + "".join(f"<{item}>{text()}{_end(item)}" for _ in range(rng.integers(1, 6)))
        elif kind == "form":
            body = f"<label>{say(1, 6)}</label><input name=q><p>{say(2, 14)}</p><button>{say(1, 3)}</button>"
        elif kind == "side":
            body = f"<h3>{say(1, 5)}</h3>" + ("<ul>" + "".join(f"<li><a href=#>{say(2, 10)}</a></li>" for _ in range(rng.integers(2, 6))) + "</ul>" if rng.random() < 0.6 else f"<p>{say(4, 50)}</p>" * 2)
        elif kind == "header":
            body = f"<h1>{say(1, 6)}</h1>" * int(rng.random() < 0.5) + f"<div>{say(1, 12)}</div>" + (part("menu") if rng.random() < 0.5 else "")
        else:
            body = say(2, 40) if rng.random() < 0.5 else f"<p>{say(2, 40)}</p>"
        return f"<{opening}>{body}{_end(opening)}"

    main = [f"<{pick(['h1', 'h1', 'h2'])}>\x01{say(3, 14)}"] if rng.random() < 0.8 else []
    for p in paragraphs:
        kind = pick(["p"] * 8 + ["h2", "ul", "blockquote", "pre", "b"])
        text = entities.escape(p)
        main.append({"ul": f"<ul><li>\x01{text}<li>\x01{say(2, 12)}</ul>", "b": f"<p><b>\x01{text}<br>"}.get(kind, f"<{kind}>\x01{text}</{kind}>"))
        if rng.random() < 0.08:
            main.append(part(pick(["ad", "ad", "side", "notice", "form"])))
    if main and main[0].startswith("<h"):
        main[0] += f"</{main[0][1:3]}>"
    if rng.random() < 0.25:
        main.append(part("comments"))
    opening = pick(_MAIN)
    before = [part(k) for k in ("notice", "header", "menu", "ad", "side") if rng.random() < 0.5]
    after = [part(k) for k in ("ad", "side", "comments", "form", "notice", "footer") if rng.random() < 0.5]
    body = f"<{opening}>{''.join(main)}{_end(opening)}"
    if rng.random() < 0.3:
        body = f"<div class=\"{pick(['wrapper', 'container', 'page', 'row'])}\">{body}</div>"
    tail = "</body></html>" if rng.random() < 0.9 else ""
    return f"<html><head><title>{say(2, 8)}</title><style>p{{}}</style></head><body>{''.join(before)}{body}{''.join(after)}{tail}"


def plain_labels(blocks: list[tuple[Path, str, int]]) -> np.ndarray:
    """Labels of a real page by the plain meaning of its elements."""
    return np.array([path.inside and not path.outside for path, _, _ in blocks], np.float32)


def teach(pages: list[str], seed: int = 13) -> BlockLabeller:
    """A labeller taught on the given pages and on layouts drawn around their paragraphs."""
    rng = np.random.default_rng(seed)
    examples, labels = [], []
    taught = 0

    def add_layouts(texts: list[str]) -> None:
        for _ in range(2):
            some = [texts[i] for i in rng.permutation(len(texts))[: int(rng.integers(1, 12))]]
            drawn = leaf_blocks(drawn_layout(some, rng))
            labels.append(np.array([text.startswith("\x01") for _, text, _ in drawn], np.float32))
            examples.append(inputs([(path, text.replace("\x01", "") or " ", linked) for path, text, linked in drawn]))

    for page in pages:
        blocks = leaf_blocks(page)
        if not blocks:
            continue
        taught += 1
        plain = plain_labels(blocks)
        if plain.any():
            examples += [inputs(blocks)] * 3
            labels += [plain] * 3
        texts = [text.replace("\x01", "") for (_, text, _), main in zip(blocks, plain, strict=True) if main or len(text.split()) > 3] or [blocks[0][1]]
        add_layouts(texts)
    for _ in range(LEAST - taught):
        add_layouts([" ".join(SENTENCES[i] for i in rng.permutation(len(SENTENCES))[: int(rng.integers(1, 5))]) for _ in range(int(rng.integers(1, 9)))])
    return BlockLabeller().fit(examples, labels)


def extract(model: BlockLabeller, pages: list[str], batch: int = 64) -> list[str]:
    """The main texts of pages; pages of like length are labelled together."""
    blocks = [leaf_blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i, b in enumerate(blocks) if b), key=lambda i: len(blocks[i]))
    for group in _groups(order, [len(b) for b in blocks], batch):
        for i, scores in zip(group, model.scores([inputs(blocks[i]) for i in group]), strict=True):
            out[i] = "\n".join(text for (_, text, _), score in zip(blocks[i], scores, strict=True) if score >= 0.5)
    return out


def _groups(order: list[int], sizes: list[int], batch: int, most_blocks: int = 40_000) -> Iterator[list[int]]:
    """Runs of pages that are padded to one length: at most ``batch`` of them, fewer of long ones."""
    group: list[int] = []
    for i in order:
        if group and (len(group) >= batch or (len(group) + 1) * sizes[i] > most_blocks):
            yield group
            group = []
        group.append(i)
    if group:
        yield group


def main_texts(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per row. Teaches the labeller on the driver when called."""
    usable = df.where(F.length(html_col) <= SAMPLE_CHARS)
    sample = usable.orderBy(F.xxhash64(id_col), id_col, F.md5(html_col)).limit(SAMPLE).select(html_col).collect()
    weights = df.sparkSession.sparkContext.broadcast(teach([r[0] for r in sample]).p)

    def run(batches):
        model = BlockLabeller()
        model.p = weights.value
        for b in batches:
            for i in range(0, len(b), 512):
                part = b.iloc[i : i + 512]
                yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": extract(model, part["html"].tolist())})

    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), whole(html_col).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    found = rows.mapInPandas(run, f"page_id {kind}, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
