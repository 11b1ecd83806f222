"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks in page order. Each block's vector holds its tag path and its words,
both hashed, and a few figures. A bidirectional LSTM in numpy reads the whole sequence of blocks and
gives each its probability of being article text, so that a block is judged by what stands around it.

It is trained here, on a bounded sample of pages. Their labels come from semantic tags (article or main,
less navigation and the like); each page is also set anew in other markup, with the same labels, so that
the labeller does not hang on one template. Where no page has such tags, pages are set anew alone.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A tag, quoted values taken whole; and one without a look at quotes, for pages whose quotes don't close.
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"(?:class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++))", re.I)
PLAIN_ATTRIBUTE = re.compile(r"(?:class|id|role)\s*+=\s*+[\"']?()()([^\s>\"']++)", re.I)
#: Elements whose content is no text of the page. Of the first, all up to the end tag is content; the others' ends may be missing.
SWALLOWING = {"script", "style", "textarea", "iframe"}
SKIPPED = SWALLOWING | {"noscript", "template", "svg", "title", "select", "option", "button"}
#: Where another of them opens before the end tag, that end tag is the other's.
FLAT = {"title", "select", "option", "button"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
#: An open element of the second set ends where one of the first begins.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SPACE = {"br", "img", "input", "hr"}

PATH, WORDS, FIGURES = 224, 64, 8
WIDTH = PATH + WORDS + FIGURES
HIDDEN = 20


class Trail:
    """The words of a tag path, cumulated: their hash buckets as bits, how many there are, and which of them labels look at."""

    __slots__ = ("bits", "length", "marks")

    def __init__(self, words: Iterable[str] = (), above: Trail | None = None):
        self.bits, self.length, self.marks = (above.bits, above.length, above.marks) if above else (0, 0, frozenset())
        for word in words:
            self.bits |= 1 << _path_buckets[word]
            self.length += 1
            if word in LABEL_WORDS:
                self.marks |= {word}


@dataclass
class Block:
    trail: Trail
    text: str
    linked: int


class _Ends:
    """The next place of a pattern from a position on; places are looked for once, so that a page is read a bounded number of times."""

    def __init__(self, page: str):
        self.page, self.known = page, {}

    def next(self, pattern: str, at: int) -> tuple[int, int] | None:
        found = self.known.get(pattern, (-1, -1))
        if found is not None and found[0] < at:
            m = re.compile(pattern, re.I).search(self.page, at)
            self.known[pattern] = found = m.span() if m else None
        return found


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks with text, in page order: tag path with class, id and role words, text, characters inside links.

    The work grows with the page's length, whatever its markup. An element of SKIPPED without an end tag ends at the next tag,
    but for those that swallow all up to their end tag.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, list[str], Trail]] = []
    opened: Counter[str] = Counter()
    root = Trail()
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append(Block(stack[-1][2] if stack else root, text, linked))
            parts.clear()
        linked = 0

    def push(name: str, words: list[str]) -> None:
        stack.append((name, words, Trail(words, stack[-1][2] if stack else root)))
        opened[name] += 1

    def cut(k: int) -> list[tuple[str, list[str], Trail]]:
        gone = stack[k:]
        del stack[k:]
        for name, _, _ in gone:
            opened[name] -= 1
        return gone

    ends, at, seek, end, last, quoted = _Ends(page), 0, 0, len(page), page.rfind(">"), True
    while at < end:
        # The next tag, comment or declaration: what is before it is text.
        lt, m, after = page.find("<", seek), None, end
        if lt < 0:
            lt = end
        elif page.startswith("<!--", lt):
            close = page.find("-->", lt + 4)
            after = close + 3 if close >= 0 else end
        elif lt > last:
            lt = end
        elif page[lt + 1] in "!?":
            after = page.find(">", lt) + 1
        else:
            m = (TAG if quoted else PLAIN_TAG).match(page, lt)
            if m is None and quoted and (m := PLAIN_TAG.match(page, lt)):
                quoted = False  # a quote never closes
            if m is None:
                seek = lt + 1
                continue
            after = m.end()
        piece = page[at:lt]
        if piece:
            parts.append(piece)
            if opened["a"]:
                linked += len(piece)
        at = seek = after
        if m is None:
            continue
        name = m.group(2).lower()
        if m.group(1):  # an end tag
            if name in INLINE:
                if opened[name]:
                    k = next((k for k in range(len(stack) - 1, max(-1, len(stack) - 5), -1) if stack[k][0] == name), None)
                    if k is not None:
                        for other, words, _ in cut(k)[1:]:
                            push(other, words)
                continue
            flush()
            if opened[name]:
                cut(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
            continue
        if name in SKIPPED:
            if name not in {"script", "style", "template", "noscript", "svg"}:
                flush()
            close = ends.next(rf"</{name}(?=[\s/>])[^>]*+>", at)
            if close and name in FLAT:
                again = ends.next(rf"<{name}(?=[\s/>])", at)
                close = None if again and again[0] < close[0] else close
            if close:
                at = seek = close[1]
            elif name in SWALLOWING:
                at = end
            else:
                found = page.find("<", at)
                at = seek = found if found >= 0 else end
            continue
        if name in VOID:
            if name in SPACE:
                parts.append(" ")
            if name == "hr":
                flush()
            continue
        if name not in INLINE:
            flush()
            own = CLOSES.get(name, ())
            if own:
                if any(opened[t] for t in own):
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] in own:
                            cut(k)
                            break
                        if stack[k][0] in {"ul", "ol", "dl", "table", "select"}:
                            break
            elif opened["p"]:  # a paragraph ends where a block begins
                cut(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "p"))
        words = [name]
        if m.group(3):
            for a in (ATTRIBUTE if quoted else PLAIN_ATTRIBUTE).finditer(m.group(3)):
                found = re.findall(r"[a-z]+", (a.group(1) or a.group(2) or a.group(3) or "").lower())
                words += [f"{name}.{w}" for w in found] + found
        push(name, words)
    flush()
    return out


class _Buckets(dict):
    """Word -> its bucket, worked out once."""

    def __init__(self, size: int, seed: int):
        super().__init__()
        self.size, self.seed = size, seed

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = bucket = zlib.crc32(word.encode("utf-8", "surrogatepass"), self.seed) % self.size
        return bucket


_path_buckets, _word_buckets = _Buckets(PATH, 1), _Buckets(WORDS, 2)


def vectors(found: list[Block]) -> np.ndarray:
    """One row for each block."""
    out = np.zeros((len(found), WIDTH), np.float32)
    for i, (b, row) in enumerate(zip(found, out, strict=True)):
        row[:PATH] = np.unpackbits(np.frombuffer(b.trail.bits.to_bytes(PATH // 8, "little"), np.uint8), bitorder="little")
        words = b.text.split(" ")
        counts = np.bincount(np.fromiter(map(_word_buckets.__getitem__, words), np.int64, len(words)), minlength=WORDS)
        row[PATH : PATH + WORDS] = 0.5 * np.sqrt(counts / (len(words) + 8))
        row[PATH + WORDS :] = (
            min(len(words), 200) / 50,
            np.log1p(len(words)) / 5,
            min(1.0, b.linked / len(b.text)),
            sum(b.text.count(c) for c in ".,;!?") / len(words),
            i / len(found),
            1 / (1 + i),
            1 / (len(found) - i),
            min(b.trail.length, 50) / 10,
        )
    return out


#: Markup whose text is not the article's, wherever it stands. Fixed values.
BOILER = ["nav", "header", "footer", "aside", "form", "ad", "ads", "advert", "banner", "menu", "sidebar", "comments", "comment", "cookie", "notice", "share", "related", "promo", "discussion", "replies", "responses", "reactions", "disqus"]


LABEL_WORDS = {*BOILER, "article", "main"}


def weak_labels(found: list[Block]) -> np.ndarray:
    """1 for blocks inside article or main and in nothing that holds other things."""
    boiler = set(BOILER) - {"header"}
    return np.array([float(bool(b.trail.marks & {"article", "main"}) and not boiler & b.trail.marks) for b in found], np.float32)


#: How pages are set anew for training. Fixed values.
CONTENT_PATHS = [("article",), ("main",), ("main", "article"), ("div", "div.content", "content"), ("div", "div.post", "post"), ("div", "div.entry", "entry"), ("div", "div.article", "article", "div.body", "body"), ("div", "div.story", "story"), ("section", "section.text", "text"), ("div", "div.main", "main"), ("table", "tr", "td"), ("div",)]
CONTENT_TAGS = ["p", "p", "p", "p", "h", "h1", "h2", "h3", "li", "blockquote", "div", "td", "pre", "figcaption"]
OTHER_PATHS = [
    ("nav", "ul", "li"), ("nav",), ("header",), ("header", "div"), ("header", "nav", "ul", "li"), ("footer",), ("footer", "p"), ("footer", "div"), ("aside",), ("aside", "p"), ("aside", "ul", "li"), ("form",), ("form", "p"), ("form", "label"),
    *[("div", f"div.{w}", w) for w in ["ad", "ads", "advert", "advertisement", "banner", "menu", "sidebar", "comments", "comment", "cookie", "notice", "share", "social", "related", "promo", "navigation", "nav", "footer", "header", "breadcrumb", "newsletter", "subscribe", "copyright", "widget", "popup", "sponsored", "login", "tags"]],
    *[("section", f"section.{w}", w, "p") for w in ["comments", "related", "promo", "discussion", "replies"]],
    *[("div", f"div.{w}", w, "p") for w in ["comments", "comment", "sidebar", "cookie", "notice", "ad", "footer", "related"]],
    *[("ul", f"ul.{w}", w, "li") for w in ["menu", "nav", "navigation", "comments", "breadcrumb", "related"]],
    *[(t, f"{t}.{w}", w, e) for w in ["discussion", "responses", "reactions"] for t, e in [("div", "p"), ("ol", "li")]], ("ol", "ol.comments", "comments", "li"), ("ul", "ul.comments", "comments", "li", "p"),
]


def set_anew(found: list[Block], labels: np.ndarray, rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The same texts in other markup, with more blocks of other things before, among and after the article."""

    def strange(tag: str) -> tuple[str, ...]:
        """A tag with class words that say nothing, as pages have them."""
        made = ["".join(map(chr, rng.integers(97, 123, rng.integers(3, 9)))) for _ in range(rng.integers(1, 3))]
        return (tag, *[x for w in made for x in (f"{tag}.{w}", w)])

    content = CONTENT_PATHS[rng.integers(len(CONTENT_PATHS))]
    if rng.random() < 0.5:
        tags = ["div", "section", "main", "article"]
        outer = [strange(tags[rng.integers(4)]) if rng.random() < 0.7 else (tags[rng.integers(4)],) for _ in range(rng.integers(1, 4))]
        content = tuple(x for part in outer for x in part)
    wrap = strange("div") if rng.random() < 0.3 else ()
    article: list[tuple[tuple[str, ...], str, int]] = []
    for i, b in enumerate(b for b, y in zip(found, labels, strict=True) if y):
        tag = CONTENT_TAGS[rng.integers(len(CONTENT_TAGS))] if i else "h1"
        words = b.text.split(" ")
        text = " ".join(words[: rng.integers(1, 5)]) if rng.random() < 0.25 else b.text  # short ones, too
        link = i and rng.random() < 0.06  # a paragraph that is a link as a whole
        article.append(((*content, *(["p", "a"] if link else [tag])), text, len(text) if link else 0))
    spare = [b.text for b in found]

    def other(inside: bool) -> list[tuple[tuple[str, ...], str, int]]:
        path = OTHER_PATHS[rng.integers(len(OTHER_PATHS))]
        path = (*strange(path[0]), *path[1:]) if rng.random() < 0.2 else path
        path = (*content, *path) if inside else path
        out = []
        for _ in range(rng.integers(1, 6)):
            words = spare[rng.integers(len(spare))].split(" ")
            start, most = rng.integers(len(words)), [3, 8, 30, 120][rng.integers(4)]
            text = " ".join(words[start : start + rng.integers(1, most + 1)])
            link = len(text) if "li" in path and rng.random() < 0.7 else 0
            out.append((path + (("a",) if link else ()), text, link))
        return out

    rows: list[tuple[tuple[str, ...], str, int]] = []
    marks: list[float] = []

    def add(new: list[tuple[tuple[str, ...], str, int]], mark: float) -> None:
        rows.extend(new)
        marks.extend([mark] * len(new))

    for _ in range(rng.integers(0, 4)):
        add(other(False), 0.0)
    for b in article:
        if rng.random() < 0.06:
            add(other(True), 0.0)
        add([b], 1.0)
    for _ in range(rng.integers(0, 4)):
        add(other(rng.random() < 0.3), 0.0)
    return [Block(Trail(("html", "body", *wrap, *path)), text, link) for path, text, link in rows], np.array(marks, np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM over the blocks' vectors, and a logistic output."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        scale = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.w = {}
        for d in "fb":
            self.w |= {f"x{d}": scale(WIDTH, 4 * HIDDEN), f"h{d}": scale(HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.w[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1  # at first, remember
        self.w |= {"o": scale(2 * HIDDEN, 1)[:, 0], "p": np.zeros(1, np.float32)}

    def _pass(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        n, steps, _ = x.shape
        gates = x.reshape(n * steps, -1) @ self.w[f"x{d}"] + self.w[f"c{d}"]
        gates = gates.reshape(n, steps, 4 * HIDDEN)
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((n, steps, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = gates[:, t] + h @ self.w[f"h{d}"]
            s = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            new = f * c + i * g
            tc = np.tanh(new)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tc))
            c, h = m * new, m * o * tc
            out[:, t] = h
        return out

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        out = np.concatenate([self._pass(d, x, mask, None if keep is None else keep.setdefault(d, [])) for d in "fb"], axis=2)
        if keep is not None:
            keep["out"] = out
        return _sigmoid(out @ self.w["o"] + self.w["p"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        keep: dict = {}
        p = self.forward(x, mask, keep)
        dy = (p - y) * mask / mask.sum()
        out, grads = keep["out"], {}
        grads["o"], grads["p"] = np.einsum("nt,nth->h", dy, out), dy.sum(keepdims=True)[0]
        d_out = dy[:, :, None] * self.w["o"]
        for k, d in enumerate("fb"):
            own = d_out[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            dh, dc = np.zeros_like(own[:, 0]), np.zeros_like(own[:, 0])
            dz = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            gh = np.zeros_like(self.w[f"h{d}"])
            for t, h, c, i, f, o, g, tc in reversed(keep[d]):
                m = mask[:, t, None]
                dh = (dh + own[:, t]) * m
                dc = dc * m + dh * o * (1 - tc * tc)
                z = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                dz[:, t] = z
                gh += h.T @ z
                dh, dc = z @ self.w[f"h{d}"].T, dc * f
            flat = dz.reshape(-1, 4 * HIDDEN)
            grads |= {f"x{d}": x.reshape(-1, WIDTH).T @ flat, f"h{d}": gh, f"c{d}": flat.sum(0)}
        return grads

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 24, batch: int = 24, rate: float = 0.012, seed: int = 0) -> Labeller:
        """Adam over batches of pages of like length."""
        rng = np.random.default_rng(seed)
        first, second, step = {k: np.zeros_like(v) for k, v in self.w.items()}, {k: np.zeros_like(v) for k, v in self.w.items()}, 0
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][0]))
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        for epoch in range(epochs):
            now = rate * (1 - epoch / epochs)
            for k in rng.permutation(len(groups)):
                x, mask = padded([pages[i][0] for i in groups[k]])
                y = np.zeros(mask.shape, np.float32)
                for row, i in zip(y, groups[k], strict=True):
                    row[: len(pages[i][1])] = pages[i][1]
                grads, step = self.gradients(x, mask, y), step + 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                for name, g in grads.items():
                    g = g / max(1.0, norm)
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g * g
                    self.w[name] = (self.w[name] - now * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, WIDTH), np.float32), np.zeros((len(pages), steps), np.float32)
    for i, v in enumerate(pages):
        x[i, : len(v)], mask[i, : len(v)] = v, 1
    return x, mask


def labelled(model: Labeller, pages: list[list[Block]], cells: int = 40_000) -> Iterator[tuple[int, np.ndarray]]:
    """(page number, probability of each block), pages of like length together, at most about `cells` blocks at once."""
    order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if pages[i]]
    while order:
        count = max(1, min(len(order), 256, cells // len(pages[order[0]])))
        while count > 1 and count * len(pages[order[count - 1]]) > cells:
            count //= 2
        own, order = order[:count], order[count:]
        x, mask = padded([vectors(pages[i]) for i in own])
        for i, p in zip(own, model.forward(x, mask), strict=True):
            yield i, p[: len(pages[i])]


def _sampled(pages: DataFrame, sample: int) -> DataFrame:
    """`sample` pages at most, the first by hash of page_id and html: no task holds more, whatever repeats."""
    return pages.select(F.xxhash64("page_id", "html").alias("h"), "html").orderBy("h", "html").limit(sample)


def fit_labeller(pages: DataFrame, sample: int = 240, anew: int = 6, window: int = 128, seed: int = 0) -> Labeller:
    """Fit on `sample` whole pages at most that hold an article or main element; each is also set anew `anew` times.

    Fitting is one task, whose numpy takes one core, over the bounded sample. Long pages are cut into windows of `window` blocks, all
    of which are used; their vectors are those of the whole page. Where no page has such an element, labels come from pages set anew
    alone: their articles are what runs to 15 words or more and is no link (or anything, if nothing does). Without any text there is
    nothing to fit, nor to extract.
    """

    def fitted(tagged: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = sorted((h, page) for batch in batches for h, page in zip(batch.column("h").to_pylist(), batch.column("html").to_pylist(), strict=True))
            rng, data = np.random.default_rng(seed), []
            for found in (blocks(page) for _, page in rows):
                labels = weak_labels(found) if tagged else np.array([float(len(b.text.split(" ")) >= 15 and 2 * b.linked < len(b.text)) for b in found], np.float32)
                if not tagged and found and not labels.any():
                    labels = np.ones(len(found), np.float32)
                if not labels.any():
                    continue
                as_is = [(found, labels)] if tagged else []
                for own, marks in [*as_is, *[set_anew(found, labels, rng) for _ in range(anew)]]:
                    x = vectors(own)
                    x[rng.random(len(x)) < 0.3, PATH : PATH + WORDS] = 0  # so that single words don't decide
                    data += [(x[i : i + window], marks[i : i + window]) for i in range(0, len(x), window)]
            if data:
                w = Labeller(seed).fit(data).w
                yield pa.RecordBatch.from_pydict({"name": list(w), "shape": pa.array([list(v.shape) for v in w.values()], pa.list_(pa.int32())), "body": [v.astype("<f4").tobytes() for v in w.values()]})

        return run

    model = Labeller(seed)
    kinds = ((True, F.col("html").rlike("(?i)<(article|main)[ >]")), (False, F.col("html").isNotNull()))
    for tagged, kind in kinds:
        found = _sampled(pages.where(kind), sample).mapInArrow(fitted(tagged), "name string, shape array<int>, body binary").collect()
        if found:
            model.w = {r.name: np.frombuffer(bytes(r.body), "<f4").reshape(r.shape).copy() for r in found}
            break
    return model


def _extractor(model: Labeller) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                pages = [blocks(x.as_py()) for x in part.column("html")]
                texts = [""] * len(pages)
                for i, p in labelled(model, pages):
                    texts[i] = " ".join(b.text for b, keep in zip(pages[i], p > 0.5, strict=True) if keep)
                yield pa.RecordBatch.from_pydict(
                    {"page_id": part.column("page_id"), "url": part.column("url"), "text": texts, "n_chars": np.array([len(t) for t in texts], np.int64)}
                )

    return run


def extract(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page, from its whole html.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one space in page
    order. Null or empty html gives an empty text. Rows that repeat a page_id get a row each, as do null page_ids. Other columns are not
    read. An empty table gives no rows.
    """
    model = model or fit_labeller(pages)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(_extractor(model), "page_id long, url string, text string, n_chars long")
