"""HTML extraction: a recurrent labeller of blocks.

A page is the sequence of its leaf blocks. Each block is a vector of hashed words of its tag path, of hashed words of
its text and of a few measures; a bidirectional LSTM in numpy reads the whole sequence, so every block is labelled as
main text or not in view of all others. The main text is all blocks so labelled, whole and in page order.

Pages carry no labels, so the training pages are laid out here: texts of a bounded sample of real pages (``SAMPLE`` of
them, of at most ``SAMPLE_LETTERS`` letters, those with the smallest hash) are put into random layouts in which the
place of the article, of menus, headers, footers, sidebars, notices, adverts, forms, and reader comments is known.
Layouts name their parts in many ways, some not at all and some by names that tell nothing, so that paths, words and
order must all be weighed; some hide parts, some have no markup. Training is seeded.

Defined results: null and empty pages, and pages without main text, have the empty text; repeated rows are extracted
alike; text without any markup is one block. A table without text to learn from learns from fixed words.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.llm.common import ready, table
from roadpulse.llm.html_blocks import blocks

SAMPLE = 300
SAMPLE_LETTERS = 20_000
#: Words that a worker remembers, and the longest of them.
REMEMBERED, LONGEST = 300_000, 64
PATH, WORDS, MEASURES = 291, 32, 8
HIDDEN = 24
TRAINING_PAGES = 5000
ROUNDS = 10
BATCH = 32

#: Ways that layouts name their parts; words joined at random, as site authors do.
CONTENT = (
    "article", "article body", "article content", "post", "post content", "post body", "entry", "entry content", "story",
    "story body", "content", "main content", "main", "page content", "body text", "text", "prose", "blog post", "news article",
    "rich text", "read",
)
OTHER = {
    "menu": ("nav", "navbar", "menu", "main menu", "navigation", "breadcrumb", "breadcrumbs", "topnav", "site nav", "tabs", "toc", "pagination", "pager"),
    "header": ("header", "site header", "masthead", "top bar", "branding", "logo", "page header", "banner"),
    "footer": ("footer", "site footer", "bottom", "copyright", "legal", "foot", "colophon"),
    "sidebar": ("sidebar", "side", "aside", "widget", "widgets", "rail", "right column", "related", "related posts", "recommended", "more stories", "popular", "trending", "tags", "share", "social"),
    "notice": ("cookie", "cookie notice", "cookie banner", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "privacy notice", "message", "toast", "paywall"),
    "advert": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner ad", "ad slot", "adsbox", "outbrain"),
    "form": ("form", "newsletter", "subscribe", "signup", "login", "search", "search form", "contact form", "comment form"),
    "comments": ("comments", "comment", "comment list", "comment body", "discussion", "replies", "reply", "responses", "disqus", "user comments", "reader comments", "feedback"),
}
SAYINGS = {
    "header": ("Welcome", "Daily News", "The best of the web"),
    "footer": ("© 2024 All rights reserved", "Terms of use", "Privacy policy", "Contact us", "Imprint"),
    "notice": ("We use cookies to improve your experience.", "This site uses cookies. Accept", "By continuing you agree to our policy.", "Please enable JavaScript."),
    "advert": ("Advertisement", "Sponsored", "Buy now", "Special offer", "Anzeige"),
    "form": ("Subscribe to our newsletter", "Email address", "Send", "Search", "Log in", "Your name"),
    "comments": ("Reply", "3 comments", "Leave a comment", "says:", "Great post!", "Anonymous wrote"),
    "sidebar": ("Related articles", "Most read", "Share this", "Tags", "Popular posts"),
    "menu": ("Home", "About", "Contact", "News", "Sport", "Next page"),
}


def _hashed(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % size


class Reader:
    """Blocks as vectors; paths and words met before are remembered, a bounded number."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.words: dict[str, int] = {}

    def vectors(self, found: list[tuple[tuple[str, ...], str, int]]) -> np.ndarray:
        if len(self.words) > REMEMBERED:
            self.words.clear()
        if len(self.paths) > 20_000:
            self.paths.clear()
        rows = np.zeros((len(found), PATH + WORDS + MEASURES), np.float32)
        known = self.words
        for k, (path, text, linked) in enumerate(found):
            way = self.paths.get(path)
            if way is None:
                way = np.zeros(PATH, np.float32)
                for depth, w in enumerate(reversed(path)):
                    way[_hashed(w, PATH)] = max(way[_hashed(w, PATH)], 1 - 0.06 * min(depth, 10))
                self.paths[path] = way
            words = text.split(" ")
            once = []
            for w in set(words).difference(known):
                known[w] = _hashed(w.lower().strip(".,;:!?()"), WORDS)
                if len(w) > LONGEST:
                    once.append(w)
            n = len(words)
            rows[k, :PATH] = way
            rows[k, PATH : PATH + WORDS] = np.bincount([*map(known.__getitem__, words)], minlength=WORDS) / n
            for w in once:
                del known[w]
            stops = text.count(".") + text.count(",") + text.count("!") + text.count("?")
            rows[k, PATH + WORDS :] = (
                np.log1p(n) / 4, np.log1p(len(text)) / 6, min(1.0, linked / len(text)), min(1.0, 5 * stops / n),
                text[-1] in ".!?", k / len(found), 1 / (1 + k), 1 / (len(found) - k),
            )
        return rows


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Weights by name: f and b for the two directions, input, recurrent, bias; out and its bias."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = 3) -> Labeller:
        rng = np.random.default_rng(seed)
        size = PATH + WORDS + MEASURES
        w = {}
        for d in "fb":
            w[d + "x"] = rng.normal(0, 1 / np.sqrt(size), (size, 4 * HIDDEN)).astype(np.float32)
            w[d + "h"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            w[d + "c"] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)].astype(np.float32)
        w["o"] = rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32)
        w["s"] = np.zeros(1, np.float32)
        return cls(w)

    def _run(self, x: np.ndarray, there: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """One direction over (steps, pages, vector); padded steps leave the state as it is."""
        w, n, h_ = self.weights, x.shape[1], HIDDEN
        ready_ = x.reshape(-1, x.shape[2]) @ w[d + "x"] + w[d + "c"]
        ready_ = ready_.reshape(x.shape[0], n, 4 * h_)
        h, c = np.zeros((n, h_), np.float32), np.zeros((n, h_), np.float32)
        out, tape = np.zeros((x.shape[0], n, h_), np.float32), []
        for t in range(x.shape[0]) if d == "f" else range(x.shape[0] - 1, -1, -1):
            gates = ready_[t] + h @ w[d + "h"]
            i, f, o = _sigmoid(gates[:, :h_]), _sigmoid(gates[:, h_ : 2 * h_]), _sigmoid(gates[:, 2 * h_ : 3 * h_])
            g = np.tanh(gates[:, 3 * h_ :])
            m = there[t][:, None]
            c_ = np.where(m, f * c + i * g, c)
            s = np.tanh(c_)
            h_new = np.where(m, o * s, h)
            tape.append((t, h, c, i, f, o, g, s, m))
            h, c = h_new, c_
            out[t] = h
        return out, tape

    def scores(self, x: np.ndarray, there: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, there, "f")[0], self._run(x, there, "b")[0]], axis=2)
        return both @ self.weights["o"] + self.weights["s"]

    def gradients(self, x: np.ndarray, there: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        w, h_ = self.weights, HIDDEN
        runs = {d: self._run(x, there, d) for d in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        p = _sigmoid(both @ w["o"] + w["s"])
        n = there.sum()
        loss = -(np.log(np.where(y, p, 1 - p) + 1e-9) * there).sum() / n
        miss = ((p - y) * there / n).astype(np.float32)
        grad = {"o": np.tensordot(miss, both, 2), "s": np.array([miss.sum()])}
        for k, d in enumerate("fb"):
            above = miss[:, :, None] * w["o"][k * h_ : (k + 1) * h_]
            dgates = np.zeros((*x.shape[:2], 4 * h_), np.float32)
            dh, dc, wh = np.zeros((x.shape[1], h_), np.float32), np.zeros((x.shape[1], h_), np.float32), 0
            for t, h, c, i, f, o, g, s, m in reversed(runs[d][1]):
                dh = dh + above[t]
                got = np.where(m, dh, 0)
                dc_ = np.where(m, dc + got * o * (1 - s * s), 0)
                step = np.concatenate([dc_ * g * i * (1 - i), dc_ * c * f * (1 - f), got * s * o * (1 - o), dc_ * i * (1 - g * g)], axis=1)
                dgates[t] = step
                wh = wh + h.T @ step
                dh = np.where(m, 0, dh) + step @ w[d + "h"].T
                dc = np.where(m, dc_ * f, dc)
            flat = dgates.reshape(-1, 4 * h_)
            grad |= {d + "x": x.reshape(-1, x.shape[2]).T @ flat, d + "h": wh, d + "c": flat.sum(axis=0)}
        return loss, grad

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], rounds: int, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for turn in range(rounds):
            order = rng.permutation(len(pages))
            order = np.array(sorted(order, key=lambda k: len(pages[k][0]) + rng.random() * 8))
            groups = [order[k : k + BATCH] for k in range(0, len(order), BATCH)]
            for group in (groups[k] for k in rng.permutation(len(groups))):
                x, there = padded([pages[k][0] for k in group])
                y = np.zeros(there.shape, bool)
                for column, k in enumerate(group):
                    y[: len(pages[k][1]), column] = pages[k][1]
                _, grad = self.gradients(x, there, y)
                norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
                step += 1
                rate = 0.01 * (1 - 0.8 * turn / rounds)
                for k, g in grad.items():
                    g = g * min(1.0, 1 / (norm + 1e-9)) + 1e-5 * self.weights[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    change = rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                    self.weights[k] = (self.weights[k] - change).astype(np.float32)

    def labels(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block is main text; pages of like length run together."""
        found: list = [np.zeros(0, bool)] * len(sequences)
        order = sorted((k for k in range(len(sequences)) if len(sequences[k])), key=lambda k: len(sequences[k]))
        start = 0
        while start < len(order):
            # Blocks of one run, padding included, are bounded.
            stop = start + 1
            while stop < len(order) and stop - start < 128 and len(sequences[order[stop]]) * (stop + 1 - start) <= 50_000:
                stop += 1
            group = order[start:stop]
            marks = self.scores(*padded([sequences[k] for k in group])) > 0
            for column, k in enumerate(group):
                found[k] = marks[: len(sequences[k]), column]
            start = stop
        return found


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, sequences))
    x = np.zeros((steps, len(sequences), sequences[0].shape[1]), np.float32)
    there = np.zeros((steps, len(sequences)), bool)
    for k, s in enumerate(sequences):
        x[: len(s), k], there[: len(s), k] = s, True
    return x, there


class Layouts:
    """Random pages with known main text: the parts of a page are lists of (path, text, linked letters)."""

    def __init__(self, texts: list[str], seed: int = 11):
        self.rng = np.random.default_rng(seed)
        self.texts = texts or [" ".join(s) for s in SAYINGS.values()]
        self.words = " ".join(self.texts[:200]).split() or ["word"]
        #: Whether all names of a page tell nothing.
        self.strange = False

    def _one(self, options):
        return options[int(self.rng.integers(len(options)))]

    def _foreign(self) -> str:
        """A name that tells nothing: sites have them in any language."""
        letters = "abcdefghiklmnoprstuvwz"
        return "".join(letters[int(k)] for k in self.rng.integers(len(letters), size=int(self.rng.integers(2, 11))))

    def _name(self, options, known: float = 0.75) -> tuple[str, ...]:
        draw, known = self.rng.random(), 0.0 if self.strange else known
        if draw > known + (1 - known) * 0.7:
            return ()
        if draw > known:
            return tuple(self._foreign() for _ in range(int(self.rng.integers(1, 3))))
        words = self._one(options).split()
        if self.rng.random() < 0.3:
            words = words + [self._one(("wrapper", "container", "box", "inner", "block", "area", "section", "1", "js", "wide"))]
        return tuple(words)

    def _short(self, most: int = 6) -> str:
        start, n = int(self.rng.integers(len(self.words))), int(self.rng.integers(1, most + 1))
        return " ".join(self.words[start : start + n])

    def _text(self) -> str:
        text = self._one(self.texts)
        if self.rng.random() < 0.3:
            words = text.split()
            text = " ".join(words[: int(self.rng.integers(1, 30))])
        return text

    def _paragraphs(self, path: tuple[str, ...], n: int) -> list:
        kinds = ["<p"] * 12 + ["<h2", "<h3", "<blockquote", "<ul <li", "<pre", "<figure <figcaption", "<table <tr <td", "<dl <dt", "<dl <dd", "<div", ""]
        found, brief = [], self.rng.random() < 0.2
        for _ in range(n):
            text = self._text() if self.rng.random() < 0.85 else self._short(12)
            if brief:  # an article of short sentences
                text = " ".join((self._short(20) + self._one((".", ".", ".", "?", "!")), self._short(8) + ".")[: 1 + (self.rng.random() < 0.3)])
            found.append(((*path, *self._one(kinds).split()), text, int(self.rng.random() < 0.05) * min(20, len(text))))
        return found

    def _other(self, kind: str, path: tuple[str, ...]) -> list:
        tag = {"menu": ("<nav", "<div", "<ul"), "header": ("<header", "<div"), "footer": ("<footer", "<div"), "sidebar": ("<aside", "<div", "<section")}
        tag = tag | {"form": ("<form", "<form", "<form", "<div"), "comments": ("<section", "<div", "<ol", "<aside"), "notice": ("<div", "<section", "<aside", "<dialog")}
        tag = self._one(tag.get(kind, ("<div", "<aside", "<section")))
        bare = tag in ("<nav", "<header", "<footer", "<aside", "<form") and self.rng.random() < 0.6
        path = (*path, tag, *(() if bare else self._name(OTHER[kind])))
        sayings, found = SAYINGS.get(kind, ("",)), []
        if kind == "menu":
            for _ in range(int(self.rng.integers(2, 9))):
                text = self._short(3) if self.rng.random() < 0.8 else self._one(sayings)
                found.append(((*path, "<ul", "<li") if self.rng.random() < 0.9 else (*path, "<a"), text, len(text)))
        elif kind == "form":
            for _ in range(int(self.rng.integers(1, 5))):
                text = self._one(sayings) if self.rng.random() < 0.6 else self._short(5)
                found.append(((*path, *self._one(("<label", "<button", "<p", "<div", "<fieldset", "<select <option", "")).split()), text, 0))
        elif kind == "comments":
            path = (*path, *self._one((("<div", "comment"), ("<ol", "<li"), ("<li", "comment"), ("<article", "comment"), ())))
            for _ in range(int(self.rng.integers(1, 6))):
                if self.rng.random() < 0.4:
                    found.append(((*path, *self._one(("<h3", "<div author", "<p", "<cite")).split()), self._one(sayings) if self.rng.random() < 0.5 else self._short(3), 0))
                found.append(((*path, *self._one(("<p", "<div", "<p", "<blockquote", "")).split()), self._text(), 0))
        else:
            for _ in range(int(self.rng.integers(1, 4))):
                text = self._one(sayings) if self.rng.random() < 0.3 else self._text() if self.rng.random() < 0.5 else self._short(12)
                if kind in ("header", "footer") and self.rng.random() < 0.6:  # they are short as a rule
                    text = self._short(5)
                linked = len(text) if self.rng.random() < (0.6 if kind in ("sidebar", "advert") else 0.2) else 0
                found.append(((*path, *self._one(("<p", "<div", "<ul <li", "<h3", "<span", "", "")).split()), text, linked))
        return found

    def _hidden(self, path: tuple[str, ...]) -> list:
        """A part that is not shown, whatever it holds."""
        kind, tag = self._one(list(OTHER)), self._one(("<div", "<section", "<p", "<ul", "<aside", "<article"))
        names = self._name(CONTENT if self.rng.random() < 0.3 else OTHER[kind])
        if tag == "<p":
            return [((*path, tag, *names, "hidden"), self._text(), 0)]
        return self._paragraphs((*path, tag, *names, "hidden"), int(self.rng.integers(1, 4)))

    def page(self) -> tuple[list, np.ndarray]:
        rng = self.rng
        if rng.random() < 0.02:  # no markup at all
            return [((), self._text(), 0)], np.array([True])
        self.strange = rng.random() < 0.25
        base = ("<html", "<body", *self._one((("<div", "page"), ("<div", "wrapper"), ("<div", "container"), (), (), ())))
        before, after = [], []
        for kind, p in (("notice", 0.3), ("header", 0.6), ("menu", 0.8), ("advert", 0.5), ("form", 0.3), ("sidebar", 0.3)):
            if rng.random() < p:
                before += self._other(kind, base)
        for kind, p in (("comments", 0.4), ("sidebar", 0.4), ("advert", 0.3), ("form", 0.3), ("menu", 0.2), ("notice", 0.2), ("footer", 0.9)):
            if rng.random() < p:
                after += self._other(kind, base)
        style = rng.random()
        if style < 0.45:
            path = (*base, *self._one((("<article",), ("<main",), ("<main", "<article"), ("<article", "<div", "content"))))
        elif style < 0.85:
            path = (*base, self._one(("<div", "<section", "<article", "<main")), *self._name(CONTENT))
        else:
            path = (*base, *self._one((("<div",), ("<div", "<div"), ("<table", "<tr", "<td"), ())))
        main = []
        if rng.random() < 0.8:
            head = ("<header", "<h1") if rng.random() < 0.2 else ("<h1",)
            main.append(((*path, *head), self._short(14), 0))
        main += self._paragraphs(path, int(rng.integers(1, 14)))
        marks = [True] * len(main)
        for kind, p in (("advert", 0.4), ("sidebar", 0.25), ("form", 0.4), ("notice", 0.2), ("menu", 0.2)):
            if rng.random() < p:  # inside the article
                at, extra = int(rng.integers(len(main) + 1)), self._other(kind, path)
                main[at:at], marks[at:at] = extra, [False] * len(extra)
        if rng.random() < 0.15:
            at, extra = int(rng.integers(len(main) + 1)), self._hidden(path)
            main[at:at], marks[at:at] = extra, [False] * len(extra)
        for part in (before, after):
            if rng.random() < 0.1:
                part += self._hidden(base)
        if rng.random() < 0.25:
            extra = self._other("comments", path)
            main, marks = main + extra, marks + [False] * len(extra)
        return before + main + after, np.array([False] * len(before) + marks + [False] * len(after))


def train(pages: DataFrame, html: str = "html") -> Labeller:
    """A labeller trained on layouts of texts of a bounded sample of ``pages``."""
    sample = pages.select(html).where(F.length(html) <= SAMPLE_LETTERS).withColumn("draw", F.xxhash64(html))
    rows = sample.orderBy("draw").limit(SAMPLE)
    texts = [t for page in rows.toArrow()[html].to_pylist() for _, t, _ in blocks(page)]
    layouts, reader = Layouts([t for t in texts if t]), Reader()
    made = [layouts.page() for _ in range(TRAINING_PAGES)]
    labeller = Labeller.fresh()
    labeller.train([(reader.vectors(found), marks) for found, marks in made], ROUNDS)
    return labeller


_readers: dict[str, Reader] = {}


def extract(pages: DataFrame, labeller: Labeller, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html`` as ``into``; the markup is left out."""
    ready(pages.sparkSession)
    shared, name = pages.sparkSession.sparkContext.broadcast(labeller), uuid.uuid4().hex
    carried = [c for c in pages.columns if c not in (html, into)]
    schema = pages.select(*carried).withColumn(into, F.lit("")).schema

    def run(batches):
        reader = _readers.get(name) or Reader()
        _readers.clear()
        _readers[name] = reader
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                found = [blocks(p) for p in batch.column(html).to_pylist()]
                marks = shared.value.labels([reader.vectors(f) for f in found])
                texts = [" ".join(t for (_, t, _), m in zip(f, k) if m) for f, k in zip(found, marks)]
                columns = [batch.column(c) for c in carried]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], schema.names)

    return pages.select(*carried, html).mapInArrow(run, schema)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract(pages, train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op7_html_extraction": op7_html_extraction}
ORACLES: dict[str, str] = {}
