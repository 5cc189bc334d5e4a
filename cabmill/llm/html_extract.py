"""Main text of web pages: a recurrent labeller over each page's sequence of leaf blocks.

A block is read as a vector: its tag path (elements, classes and ids, hashed), its words (hashed)
and a few densities. A bidirectional LSTM in numpy runs over all blocks of a page and labels each
from the context of the whole page. It is fitted on a bounded sample of the given pages, whose
landmark elements say which blocks are the article, and on pages of many other layouts made from
the sample's blocks, with and without landmarks. Labelling is one pass without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.llm.common import chosen, read, ship, smallest_hashes
from cabmill.llm.html_blocks import Block, blocks

#: Pages sampled for fitting (those whose texts have the smallest hashes) and pages made of them.
SAMPLE, MADE = 300, 1500
#: Blocks of a sampled page that are learned from, and characters of each.
LEARNED, LEARNED_CHARS = 400, 4000
#: Blocks of a page that are read together; a longer page is read in such windows.
WINDOW = 4096
#: Sizes of the hashed path, the hashed own element, the hashed words, and of each LSTM.
PATH, LEAF, WORDS, HIDDEN = 96, 32, 32, 24
_DENSE = 11
INPUT = PATH + LEAF + WORDS + _DENSE
_KEPT = 200_000

# Names that mark what is not the article, wherever they stand.
OUTSIDE = frozenset(
    "ad ads advert advertisement advertising alert banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disclaimer dialog disqus footer form gdpr header login menu "
    "menubar modal nav navbar navigation newsletter notice notification pager pagination popup "
    "promo promoted promotion recommended related replies reply response responses search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar "
    "topbar widget widgets".split()
)
OUTSIDE_TAGS = frozenset("nav header footer aside form button dialog menu input legend fieldset".split())


def _bucket(name: str, size: int) -> tuple[int, float]:
    h = zlib.crc32(name.encode())
    return h % size, 1.0 if h >> 31 else -1.0


class Vectors:
    """Feature vectors of a page's blocks; remembers those of paths and words it has met."""

    def __init__(self):
        self._paths: dict[tuple[str, ...], np.ndarray] = {}
        self._words: dict[str, int] = {}

    def _path(self, path: tuple[str, ...]) -> np.ndarray:
        found = self._paths.get(path)
        if found is None:
            found = np.zeros(PATH + LEAF)
            for depth, element in enumerate(reversed(path)):
                tag, *names = element.split(" ")
                for name in ["<" + tag, *names]:
                    i, sign = _bucket(name, PATH)
                    found[i] += sign / (1 + 0.1 * depth)
                if depth == 0 or (depth == 1 and tag in ("li", "td", "p")):
                    for name in ["<" + tag, *names]:
                        i, sign = _bucket("own " + name, LEAF)
                        found[PATH + i] += sign
            if len(self._paths) >= _KEPT:
                self._paths.clear()
            self._paths[path] = found
        return found

    @staticmethod
    def _marks(path: tuple[str, ...]) -> tuple[bool, bool, bool]:
        """Whether a name, and a tag, on the path marks what is set aside; whether it is inside
        a landmark of the article."""
        elements = [e.split(" ") for e in path]
        return (
            any(not OUTSIDE.isdisjoint(names) for _, *names in elements),
            any(tag in OUTSIDE_TAGS for tag, *_ in elements),
            any(tag in ("article", "main") for tag, *_ in elements),
        )

    def _word_counts(self, words: list[str]) -> np.ndarray:
        known = self._words
        try:
            at = [known[w] for w in words]
        except KeyError:
            if len(known) > _KEPT:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = zlib.crc32(w.lower().encode()) % WORDS
            at = [known[w] for w in words]
        return np.bincount(at, minlength=WORDS) / len(words)

    def page(self, found: list[Block], first: int = 0, blocks_of_page: int | None = None) -> np.ndarray:
        """Vectors of blocks, the first of which has so many others of its page before it."""
        out, whole = np.zeros((len(found), INPUT)), blocks_of_page or len(found)
        for i, b in enumerate(found):
            words = b.text.split(" ")
            n = len(b.text)
            out[i, : PATH + LEAF] = self._path(b.path)
            out[i, PATH + LEAF : -_DENSE] = self._word_counts(words)
            out[i, -_DENSE:] = (
                np.log1p(n) / 5, np.log1p(len(words)) / 4, b.linked / n, b.text[-1] in ".!?…\"»”",
                min(1.0, sum(map(b.text.count, ".,;")) * 10 / n), (first + i + 1) / whole,
                len(b.path) / 10, 1.0, *self._marks(b.path),
            )
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Two LSTMs, one reading forwards and one backwards, and an output unit on both states."""

    w: list[np.ndarray]  # per direction: (INPUT + HIDDEN + 1) x 4 HIDDEN
    out: np.ndarray  # 2 HIDDEN + 1

    @staticmethod
    def new(seed: int = 5) -> Labeller:
        rng = np.random.default_rng(seed)
        w = [rng.normal(0, 0.12, (INPUT + HIDDEN + 1, 4 * HIDDEN)) for _ in range(2)]
        for x in w:
            x[-1, HIDDEN : 2 * HIDDEN] = 1.0  # the forget gates start open
        return Labeller(w, rng.normal(0, 0.1, 2 * HIDDEN + 1))

    def _read(self, w: np.ndarray, x: np.ndarray, mask: np.ndarray, keep: bool = False, carried=None):
        """States of one direction. x: time x pages x INPUT; a masked step leaves the state.
        ``carried`` is the pair of states after what was read before; it is brought up to date."""
        steps, pages, _ = x.shape
        h, c = carried or (np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN)))
        states, saved = np.empty((steps, pages, HIDDEN)), []
        given = x @ w[:INPUT] + w[-1]
        for t in range(steps):
            z = given[t] + h @ w[INPUT:-1]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            m = mask[t][:, None]
            if keep:
                saved.append((h, c, i, f, o, g, tanh_c, m))
            c = np.where(m, new_c, c)
            h = np.where(m, o * tanh_c, h)
            states[t] = h
        if carried is not None:
            carried[:] = h, c
        return states, saved

    def logits_of_long(self, vectors: Vectors, found: list[Block], window: int) -> np.ndarray:
        """The same for one page, read in windows with both states carried from one to the next."""
        out, n = np.full(len(found), self.out[-1]), len(found)
        edges = [(a, min(a + window, n)) for a in range(0, n, window)]
        parts = (self.out[:HIDDEN], self.out[HIDDEN:-1])
        for w, part, order, step in zip(self.w, parts, (edges, edges[::-1]), (1, -1), strict=True):
            carried = [np.zeros((1, HIDDEN)), np.zeros((1, HIDDEN))]
            for a, b in order:
                x = vectors.page(found[a:b], a, n)[::step, None]
                states, _ = self._read(w, x, np.ones((b - a, 1), bool), carried=carried)
                out[a:b] += (states[:, 0] @ part)[::step]
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        ahead, _ = self._read(self.w[0], x, mask)
        back, _ = self._read(self.w[1], x[::-1], mask[::-1])
        return ahead @ self.out[:HIDDEN] + back[::-1] @ self.out[HIDDEN:-1] + self.out[-1]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray):
        reads = [
            self._read(self.w[0], x, mask, keep=True),
            self._read(self.w[1], x[::-1], mask[::-1], keep=True),
        ]
        ahead, back = reads[0][0], reads[1][0][::-1]
        logit = ahead @ self.out[:HIDDEN] + back @ self.out[HIDDEN:-1] + self.out[-1]
        d = np.where(mask, _sigmoid(logit) - y, 0.0) / max(1, mask.sum())
        d_out = np.concatenate([
            np.einsum("tp,tph->h", d, ahead), np.einsum("tp,tph->h", d, back), [d.sum()]
        ])
        grads = []
        for k, (w, (_, saved)) in enumerate(zip(self.w, reads, strict=True)):
            part = self.out[:HIDDEN] if k == 0 else self.out[HIDDEN:-1]
            error, given = (d, x) if k == 0 else (d[::-1], x[::-1])
            grads.append(self._back(w, saved, given, error[:, :, None] * part))
        return grads, d_out

    @staticmethod
    def _back(w, saved, x, d_states):
        grad = np.zeros_like(w)
        dh, dc = np.zeros_like(d_states[0]), np.zeros_like(d_states[0])
        dzs = np.empty((len(saved), x.shape[1], 4 * HIDDEN))
        for t in range(len(saved) - 1, -1, -1):
            h, c, i, f, o, g, tanh_c, m = saved[t]
            dh = dh + d_states[t]
            live, live_c = np.where(m, dh, 0), np.where(m, dc, 0)
            d_new_c = live_c + live * o * (1 - tanh_c**2)
            dz = np.concatenate([
                d_new_c * g * i * (1 - i), d_new_c * c * f * (1 - f),
                live * tanh_c * o * (1 - o), d_new_c * i * (1 - g**2),
            ], axis=1)
            dzs[t] = dz
            grad[INPUT:-1] += h.T @ dz
            dh = np.where(m, dz @ w[INPUT:-1].T, dh)
            dc = np.where(m, d_new_c * f, dc)
        flat = dzs.reshape(-1, 4 * HIDDEN)
        grad[:INPUT] = x.reshape(-1, INPUT).T @ flat
        grad[-1] = flat.sum(0)
        return grad


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), INPUT)), np.zeros((steps, len(pages)), bool)
    for j, p in enumerate(pages):
        x[: len(p), j], mask[: len(p), j] = p, True
    return x, mask


def fit_labeller(
    pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 8, batch: int = 32, rate: float = 0.01
) -> Labeller:
    """Adam on the mean logistic loss of the blocks; pages of like length share a batch."""
    model, rng = Labeller.new(), np.random.default_rng(6)
    pages = sorted((p for p in pages if len(p[0])), key=lambda p: len(p[0]))
    groups = [pages[i : i + batch] for i in range(0, len(pages), batch)]
    params = [*model.w, model.out]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, total = 0, max(1, epochs * len(groups))
    for _ in range(epochs):
        for k in rng.permutation(len(groups)):
            x, mask = _padded([p[0] for p in groups[k]])
            y = np.zeros(mask.shape)
            for j, p in enumerate(groups[k]):
                y[: len(p[1]), j] = p[1]
            grads, d_out = model.gradients(x, mask, y)
            step += 1
            for p, g, a, b in zip(params, [*grads, d_out], m, v, strict=True):
                g = g * min(1.0, 5.0 / (np.sqrt((g**2).sum()) + 1e-9))
                a += 0.1 * (g - a)
                b += 0.001 * (g**2 - b)
                p -= rate * (1 - step / (total + 1)) * (a / (1 - 0.9**step)) / (
                    np.sqrt(b / (1 - 0.999**step)) + 1e-8
                )
    return model


def landmark_labels(found: list[Block]) -> np.ndarray | None:
    """1 for blocks inside an article or main element and no part that is set aside there; None
    for a page without such an element."""
    out, seen = [], False
    for b in found:
        inside = aside = False
        for element in b.path:
            tag, *names = element.split(" ")
            if tag in ("article", "main"):
                inside, aside = True, bool(OUTSIDE & set(names))
            elif tag in OUTSIDE_TAGS or OUTSIDE & set(names):
                aside = True
        seen |= inside
        out.append(float(inside and not aside))
    return np.array(out) if seen else None


class Maker:
    """Pages of many layouts, with labels, from a stock of texts."""

    # What the made pages are built of, "tag names" each.
    MAIN = (
        "article", "main", "article post", "div content", "div main content", "div article body",
        "div post", "section entry content", "div story", "div text", "section article", "div",
        "main content", "div page content", "td content", "section body", "div entry", "section",
    )
    LISTS = ("nav", "nav menu", "div menu", "ul nav", "div navbar", "div breadcrumbs", "header nav",
             "div top links", "div pagination", "div tags", "div site navigation", "nav toc", "ul menu")
    SHORT = ("header", "div header", "header site header", "div ad", "div ads", "aside ad", "div banner",
             "div advert", "div sponsored", "section promo", "div cookie notice", "div notice", "div alert",
             "div consent", "div popup modal", "div newsletter", "form", "form search", "form subscribe",
             "div share social", "div login", "p notice", "div skip", "div message", "aside notice",
             "div byline share", "dialog", "div cookie banner", "section newsletter", "p ad", "span ad")
    ASIDE = ("aside", "aside sidebar", "div sidebar", "div related", "section related posts",
             "div widget", "div recommended", "section popular", "aside related", "div more stories")
    COMMENTS = ("section comments", "div comments", "div comment list", "ol commentlist", "ul comments",
                "div reader comments", "section responses", "div discussion comments", "div replies")
    FOOT = ("footer", "div footer", "footer site footer", "div copyright", "div legal footer", "div bottom")
    NOISE = ("row", "col", "container", "wrapper", "md", "8", "inner", "x", "box", "grid", "block", "module")

    def __init__(self, long: list[str], short: list[str], seed: int = 7):
        self.long, self.short = long or ["a b c."], short or ["a b"]
        self.rng = np.random.default_rng(seed)

    def _one(self, options):
        return options[int(self.rng.integers(len(options)))]

    def _chance(self, p: float) -> bool:
        return self.rng.random() < p

    def _sentence(self) -> str:
        words = self._one(self.long).split(" ")
        at = int(self.rng.integers(len(words)))
        return " ".join(words[at : at + int(self.rng.integers(2, 18))])

    def _noise(self, element: str) -> str:
        return element + "".join(" " + self._one(self.NOISE) for _ in range(int(self.rng.integers(3)))) \
            if self._chance(0.3) else element

    def _part(self, path, kind) -> list[Block]:
        p = (*path, self._noise(self._one(kind)))
        if kind is self.LISTS or (kind is self.FOOT and self._chance(0.3)) or (kind is self.ASIDE and self._chance(0.5)):
            item = ("ul", "li", "a") if self._chance(0.7) else ("a",) if self._chance(0.5) else ("div", "a")
            texts = [self._one(self.short) for _ in range(int(self.rng.integers(1, 9)))]
            head = [Block((*p, "h3"), self._one(self.short), 0)] if self._chance(0.3) else []
            return head + [Block((*p, *item), t, len(t)) for t in texts]
        if kind is self.COMMENTS:
            own = self._one(((), ("div comment",), ("li comment",), ("article comment",), ("div comment", "p"), ("p",)))
            head = [Block((*p, self._one(("h2", "h3"))), self._one(self.short), 0)] if self._chance(0.6) else []
            return head + [
                Block((*p, *own), self._one(self.long) if self._chance(0.4) else self._sentence(), 0)
                for _ in range(int(self.rng.integers(1, 7)))
            ]
        n = int(self.rng.integers(1, 3))
        inner = self._one(((), ("p",), ("span",), ("label",), ("button",), ("h2",), ("div",)))
        texts = [self._sentence() if self._chance(0.6) else self._one(self.long) if self._chance(0.25) else self._one(self.short) for _ in range(n)]
        return [Block((*p, *inner), t, len(t) if self._chance(0.2) else 0) for t in texts]

    def _article(self, path) -> list[tuple[Block, float]]:
        p = (*path, self._noise(self._one(self.MAIN)))
        if self._chance(0.25):
            p = (*p, self._noise(self._one(("div", "div body", "section", "div text"))))
        out = []
        if self._chance(0.9):
            title = Block((*p, self._one(("h1", "h1", "h1 title", "h2"))), self._sentence(), 0)
            out.append((title, 1.0))
        if self._chance(0.04):  # many short paragraphs, alike
            text = self._sentence()
            for _ in range(int(self.rng.integers(20, 140))):
                text = self._sentence() if self._chance(0.1) else text
                out.append((Block((*p, "p"), text, 0), 1.0))
        for _ in range(int(self.rng.integers(1, 12))):
            if self._chance(0.12):
                out += [(b, 0.0) for b in self._part(p, self._one((self.SHORT, self.ASIDE)))]
            tag = self._one(("p",) * 12 + ("h2", "h3", "blockquote", "pre", "ul/li", "ol/li", "blockquote/p", "table/tr/td", "figure/figcaption", "p intro", "p/b", "p/em", "div"))
            text = self._one(self.long) if self._chance(0.75) else self._sentence()
            linked = int(len(text) * self.rng.random() * 0.3) if self._chance(0.1) else 0
            out.append((Block((*p, *tag.split("/")), text, linked), 1.0))
        if self._chance(0.2):
            kind = self._one((self.COMMENTS, self.SHORT, self.ASIDE, self.FOOT, self.LISTS))
            out += [(b, 0.0) for b in self._part(p, kind)]
        return out

    def page(self) -> tuple[list[Block], np.ndarray]:
        path = ("html", "body")
        for _ in range(int(self.rng.integers(3))):
            path = (*path, self._noise(self._one(("div", "div wrapper", "div page", "div container"))))
        rows: list[tuple[Block, float]] = []
        for kind, p in ((self.SHORT, 0.4), (self.LISTS, 0.8), (self.SHORT, 0.4), (self.ASIDE, 0.2)):
            if self._chance(p):
                rows += [(b, 0.0) for b in self._part(path, kind)]
        rows += self._article(path)
        for kind, p in ((self.SHORT, 0.3), (self.COMMENTS, 0.35), (self.ASIDE, 0.35), (self.SHORT, 0.2), (self.LISTS, 0.2), (self.FOOT, 0.85)):
            if self._chance(p):
                rows += [(b, 0.0) for b in self._part(path, kind)]
        return [b for b, _ in rows], np.array([y for _, y in rows])


def _learned_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page the blocks that are learned from, with their labels; at most LEARNED of them
    and so many characters each: those around the first block of its article."""
    for batch in batches:
        for h, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = blocks(html)
            labels = landmark_labels(found)
            article = int(labels.argmax()) if labels is not None else 0
            first = max(0, min(article - LEARNED // 2, len(found) - LEARNED))
            part = found[first : first + LEARNED]
            if part:
                told = [None] * len(part) if labels is None else labels[first : first + LEARNED].tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([h] * len(part)), pa.array(range(len(part)), pa.int64()),
                        pa.array([list(b.path) for b in part], pa.list_(pa.string())),
                        pa.array([b.text[:LEARNED_CHARS] for b in part], pa.string()),
                        pa.array([b.linked for b in part], pa.int64()), pa.array(told, pa.float64()),
                    ],
                    ["h", "i", "path", "text", "linked", "label"],
                )


_LEARNED_SCHEMA = "h long, i long, path array<string>, text string, linked long, label double"


def _with_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        some = [bool(blocks(html)) for html in batch.column(1).to_pylist()]
        yield batch.filter(pa.array(some, pa.bool_()))


def fit(pages: DataFrame, sample: int = SAMPLE, made: int = MADE) -> Labeller | None:
    """A labeller fitted on at most ``sample`` distinct pages (those whose texts have the smallest
    hashes, whatever their ids and lengths) and ``made`` others built from their texts; None if no
    page has a block."""
    ship(pages.sparkSession)
    rows = chosen(pages, html="string").where("html <> ''").select(F.xxhash64("html").alias("h"), "html")

    def learned(rows: DataFrame) -> list:
        hashes = smallest_hashes(rows.select("h").distinct(), "h", "sample", sample)
        picked = rows.join(F.broadcast(hashes), "h", "left_semi").groupBy("h").agg(F.first("html").alias("html"))
        return picked.mapInArrow(_learned_part, _LEARNED_SCHEMA).orderBy("h", "i").collect()

    found = learned(rows)
    if not found:  # all of the sample is empty; some other page may not be
        found = learned(rows.mapInArrow(_with_blocks, "h long, html string"))
    if not found:
        return None
    vectors, given, long, short = Vectors(), [], [], []
    for _, page in groupby(found, key=lambda r: r.h):
        page = list(page)
        part = [Block(tuple(r.path), r.text, min(r.linked, len(r.text))) for r in page]
        if page[0].label is not None:
            given.append((vectors.page(part), np.array([r.label for r in page])))
        for b in part:
            (long if len(b.text) > 80 else short).append(b.text)
    maker = Maker(long, short)
    others = [(vectors.page(b), y) for b, y in (maker.page() for _ in range(made))]
    return fit_labeller(given + others)


def _extracted(model):
    def texts(vectors: Vectors, labeller: Labeller, pages: list[str | None]) -> list[str]:
        found = [blocks(p or "") for p in pages]
        out = [""] * len(pages)
        order = sorted((i for i in range(len(pages)) if found[i]), key=lambda i: len(found[i]))
        while order and len(found[order[-1]]) > WINDOW:
            i = order.pop()
            kept = labeller.logits_of_long(vectors, found[i], WINDOW) > 0
            out[i] = " ".join(b.text for b, k in zip(found[i], kept, strict=True) if k)
        at = 0
        while at < len(order):
            # Pages of like length together; the padded batch stays below a few MB.
            end = at + 1
            while end < len(order) and (end - at + 1) * len(found[order[end]]) <= 2048:
                end += 1
            some = order[at:end]
            x, mask = _padded([vectors.page(found[i]) for i in some])
            logits = labeller.logits(x, mask)
            for j, i in enumerate(some):
                kept = logits[: len(found[i]), j] > 0
                out[i] = " ".join(b.text for b, k in zip(found[i], kept, strict=True) if k)
            at = end
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, labeller = Vectors(), model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                pages = part.column(2).to_pylist()
                got = texts(vectors, labeller, pages) if labeller else [""] * len(pages)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(got, pa.string()),
                     pa.array([len(t) for t in got], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return run


def extract_pages(pages: DataFrame, labeller: Labeller | None) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null or empty page, and one whose blocks are all labelled as something else, has the empty
    text. Repeated rows get a row each, null ids and urls stay null, an empty table gives no rows,
    further columns are ignored.
    """
    sent = pages.sparkSession.sparkContext.broadcast(labeller)  # some 30 000 numbers
    return chosen(pages, page_id="long", url="string", html="string").mapInArrow(
        _extracted(sent), "page_id long, url string, text string, n_chars long"
    )


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return extract_pages(pages, fit(pages))
