"""Operator 7: main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks: runs of text between block-level tags, with
the path of open tags above them.  A block's vector holds hashed path tokens (tag
names and the words of their ``class``, ``id`` and ``role``), hashed words and a
few shape figures (length, share of link text, depth).  A bidirectional LSTM reads
the sequence of blocks of the whole page, so each block is judged with the rest of
the document before and after it, and a logistic layer labels it main text or not.

The labeller is trained in numpy on made-up pages: layouts drawn at random from the
ways sites mark articles and the parts around them, filled with words of a bounded
sample of the given pages.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfit.llm.common import ship, table, text_or_empty

PATH_DIM, WORD_DIM, SHAPE_DIM, HIDDEN = 48, 16, 8, 16
PATH_BUCKETS, WORD_BUCKETS = 1 << 12, 1 << 12
#: Bounds of training: pages whose words are sampled, made-up pages, epochs.
SAMPLE_PAGES, MADE_PAGES, EPOCHS = 200, 500, 10
BATCH = 64
#: Word ids whose vectors are held at once.
IDS_AT_ONCE = 1 << 18

#: Tags that never hold text to show.
SKIP = frozenset("script style noscript template svg math head title iframe object textarea select option".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that stay inside a block; any other tag ends one.
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q ruby rt rp s samp "
                    "small span strike strong sub sup time tt u var wbr del img picture source").split())
#: An open <p> or <li> (and so on) is closed by the next such tag.
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                "td": {"td", "th"}, "th": {"td", "th"}, "h1": {"p"}, "h2": {"p"}, "h3": {"p"}, "div": {"p"},
                "ul": {"p"}, "ol": {"p"}, "table": {"p"}, "section": {"p"}, "article": {"p"}, "aside": {"p"},
                "nav": {"p"}, "footer": {"p"}, "header": {"p"}, "form": {"p"}, "blockquote": {"p"}, "pre": {"p"}}

#: The next mark.  Quotes count after "=" only, and only if they are closed; no character is
#: tried twice.  The last branch is a tag whose quotes swallow all that follows.
_TAG = r"""</?([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)>"""
_MARK = re.compile(rf"<!--|<[!?][^>]*+>|{_TAG}|</?[a-zA-Z]")
#: The same, with tags that end at the first ">".
_PLAIN_MARK = re.compile(r"<!--|<[!?][^>]*+>|</?([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-label)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^ ]+")


class Block:
    """``path``: the distinct tokens of all open tags; ``deep``: their number with repetitions."""

    __slots__ = ("path", "deep", "text", "linked")

    def __init__(self, path: tuple[str, ...], deep: int, text: str, linked: int):
        self.path, self.deep, self.text, self.linked = path, deep, text, linked


def _tokens(name: str, attrs: str) -> tuple[str, ...]:
    out = [name]
    if attrs:
        for m in _ATTR.finditer(attrs):
            value = (m[2] or m[3] or m[4] or "").lower()
            kind = m[1].lower()
            out += ["hidden"] if kind == "hidden" else [f"{'.' if kind != 'role' else '@'}{w}" for w in _SPLIT.split(value) if w]
    return tuple(out)


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order, white space collapsed, references decoded.
    Unclosed and stray tags are taken as browsers mostly do; no text is dropped
    but that of ``SKIP`` elements and comments."""
    out: list[Block] = []
    # each open element with the path, its length and "in a link" of all down to it:
    # what has no new token shares its parent's path, so depth costs nothing
    stack: list[tuple[str, tuple[str, ...], int, bool]] = []
    opened: dict[str, list[int]] = {}  # by name, the places in the stack
    outer: list[int] = []  # places of elements that are not inline
    buffer: list[str] = []
    linked = [0]
    path: tuple[str, ...] = ()
    deep = 0
    pos, n = 0, len(page)

    def flush() -> None:
        if buffer:
            text = _SPACE.sub(" ", html_lib.unescape("".join(buffer))).strip()
            if text:
                out.append(Block(path, deep, text, linked[0]))
            buffer.clear()
        linked[0] = 0

    def put(s: str) -> None:
        nonlocal path, deep
        if s and (buffer or not s.isspace()):
            if not buffer:  # a block stands where its first text stands
                path, deep = stack[-1][1:3] if stack else ((), 0)
            buffer.append(s)
            if stack and stack[-1][3]:
                linked[0] += len(s)

    def push(name: str, tokens: tuple[str, ...]) -> None:
        _, above, length, link = stack[-1] if stack else ("", (), 0, False)
        new = tuple(t for t in dict.fromkeys(tokens) if t not in above)
        opened.setdefault(name, []).append(len(stack))
        if name not in INLINE:
            outer.append(len(stack))
        stack.append((name, above + new if new else above, length + len(tokens), link or name == "a"))

    def close(k: int) -> None:
        while len(stack) > k:
            opened[stack.pop()[0]].pop()
        while outer and outer[-1] >= k:
            outer.pop()

    # beyond the last ">" no tag ends, beyond the last "-->" no comment; so the time is
    # linear in the page, however broken it is
    last, last_comment = page.rfind(">") + 1, page.rfind("-->")
    unclosed: set[str] = set()  # skipped elements of which no end tag follows
    mark = _MARK
    while pos < n and (m := mark.search(page, pos, max(pos, last))):
        if m[1] is None and mark is _MARK and m[0][1] not in "!?":
            mark = _PLAIN_MARK  # from here on no quote is believed
            continue
        put(page[pos:m.start()])
        pos = m.end()
        if m[1] is None:
            if m[0] == "<!--":
                pos = page.find("-->", pos) + 3 if m.start() < last_comment - 3 else n
            continue
        name = m[1].lower()
        if page.startswith("</", m.start()):
            if name not in INLINE:
                flush()
            if opened.get(name):
                close(opened[name][-1])
            continue
        if name in SKIP:
            if name not in INLINE:
                flush()
            if not m[0].endswith("/>"):
                end = None if name in unclosed else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, pos)
                if end is None:
                    unclosed.add(name)
                pos = end.end() if end else (n if name in ("script", "style", "textarea", "title") else pos)
            continue
        if name not in INLINE:
            flush()
            if outer and stack[outer[-1]][0] in SELF_CLOSING.get(name, ()):
                close(outer[-1])
        if name not in VOID and not m[0].endswith("/>"):
            push(name, _tokens(name, m[2]))
    rest = page.find("<!--", pos)
    put(page[pos:n if rest < 0 else rest])
    flush()
    return out


def _bucket(token: str, n: int) -> int:
    return xxhash.xxh32_intdigest(token.encode("utf-8", "surrogatepass")) % n


class _Buckets(dict):
    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, token: str) -> int:
        if len(self) > 200_000:
            self.clear()
        b = self[token] = _bucket(token, self.n)
        return b


def _sums(vectors: np.ndarray, ids: np.ndarray, size: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Weighted sum of ``vectors`` over each bag of ``size`` ids, a slice of bags at a time."""
    out = np.empty((len(size), vectors.shape[1]), np.float32)
    ends = np.cumsum(size)
    lo = 0
    while lo < len(size):
        begin = ends[lo] - size[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, begin + IDS_AT_ONCE, side="right")))
        at = slice(begin, ends[hi - 1])
        out[lo:hi] = np.add.reduceat(vectors[ids[at]] * share[at, None], ends[lo:hi] - size[lo:hi] - begin, axis=0)
        lo = hi
    return out


class Labeller:
    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        d, h = PATH_DIM + WORD_DIM + SHAPE_DIM, HIDDEN

        def init(*shape: int) -> np.ndarray:
            return (r.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {"path": (0.3 * r.normal(size=(PATH_BUCKETS, PATH_DIM))).astype(np.float32),
                  "word": (0.1 * r.normal(size=(WORD_BUCKETS, WORD_DIM))).astype(np.float32),
                  "out": init(2 * h + d, 1), "bias": np.zeros(1, np.float32)}
        for k in ("f", "b"):
            self.p["w" + k] = init(d + h, 4 * h)
            self.p["c" + k] = np.zeros(4 * h, np.float32)
            self.p["c" + k][h:2 * h] = 1.0

    # pages as index lists: bags of path buckets and of word buckets with their counts, and shape figures
    def encode(self, page: list[Block], paths: dict, words: dict) -> tuple[list[list[int]], list[tuple], np.ndarray]:
        bags_p, bags_w, shape = [], [], np.zeros((len(page), SHAPE_DIM), np.float32)
        for i, b in enumerate(page):
            bags_p.append([paths[t] for t in b.path] or [paths[""]])
            # every word counts; an id is held once, however often it comes
            ids = np.fromiter((words[t[0].lower()] for t in _WORD.finditer(b.text)), dtype=np.int64)
            bags_w.append(np.unique(ids if len(ids) else [words[""]], return_counts=True))
            n = len(b.text)
            shape[i] = (np.log1p(n) / 5, min(1.0, b.linked / max(n, 1)), n > 200, n < 25,
                        b.text[-1] in ".!?:;\"", i / max(1, len(page) - 1), i < 3, min(b.deep, 30) / 10)
        return bags_p, bags_w, shape

    def _inputs(self, pages: list, width: int) -> tuple[np.ndarray, dict]:
        """(T, B, D) inputs of pages padded to ``width`` blocks."""
        x = np.zeros((width, len(pages), PATH_DIM + WORD_DIM + SHAPE_DIM), np.float32)
        where = [(t, j) for j, p in enumerate(pages) for t in range(len(p[0]))]
        note = {"where": where}
        at = (np.array([t for t, _ in where]), np.array([j for _, j in where]))
        bags = [b for p in pages for b in p[0]]
        size = np.array([len(b) for b in bags])
        ids = np.fromiter((i for b in bags for i in b), dtype=np.int64, count=int(size.sum()))
        note["path"] = (ids, size, np.repeat(1 / np.sqrt(size), size).astype(np.float32))
        bags = [b for p in pages for b in p[1]]
        size = np.array([len(b) for b, _ in bags])
        share = np.concatenate([c / c.sum() for _, c in bags]).astype(np.float32)
        note["word"] = (np.concatenate([b for b, _ in bags]), size, share)
        for name, lo, dim in (("path", 0, PATH_DIM), ("word", PATH_DIM, WORD_DIM)):
            x[at[0], at[1], lo:lo + dim] = _sums(self.p[name], *note[name])
        x[at[0], at[1], PATH_DIM + WORD_DIM:] = np.concatenate([p[2] for p in pages])
        note["at"] = at
        return x, note

    def _lstm(self, x: np.ndarray, live: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        h, dim = HIDDEN, x.shape[2]
        w = self.p["w" + d]
        pre = x @ w[:dim] + self.p["c" + d]
        steps, b = x.shape[:2]
        hid, cell = np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
        out = np.empty((steps, b, h), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[t] + hid @ w[dim:]
            g = 0.5 * (np.tanh(0.5 * z[:, :3 * h]) + 1.0)
            new = np.tanh(z[:, 3 * h:])
            before, prev = cell, hid
            m = live[t][:, None]  # padding leaves the state as it is
            cell = np.where(m, g[:, h:2 * h] * cell + g[:, :h] * new, cell)
            tc = np.tanh(cell)
            hid = np.where(m, g[:, 2 * h:] * tc, hid)
            out[t] = hid
            if keep is not None:
                keep.append((t, g, new, before, prev, tc))
        return out

    def _forward(self, pages: list, keep: dict | None = None) -> tuple[np.ndarray, dict]:
        width = max(len(p[0]) for p in pages)
        x, note = self._inputs(pages, width)
        live = np.zeros((width, len(pages)), bool)
        live[note["at"]] = True
        kf, kb = ([], []) if keep is not None else (None, None)
        full = np.concatenate([self._lstm(x, live, "f", kf), self._lstm(x, live, "b", kb), x], axis=2)
        z = (full @ self.p["out"] + self.p["bias"])[:, :, 0]
        if keep is not None:
            keep.update(x=x, live=live, full=full, f=kf, b=kb, **note)
        return z, note

    def scores(self, pages: list) -> list[np.ndarray]:
        """Probability of main text for each block of each encoded page."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p[0]), key=lambda i: len(pages[i][0]))
        for lo in range(0, len(order), BATCH):
            part = order[lo:lo + BATCH]
            z, _ = self._forward([pages[i] for i in part])
            for j, i in enumerate(part):
                out[i] = 1.0 / (1.0 + np.exp(-z[:len(pages[i][0]), j]))
        return out

    def _gradients(self, pages: list, labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        keep: dict = {}
        z, _ = self._forward(pages, keep)
        h, x, live, b = HIDDEN, keep["x"], keep["live"], len(pages)
        y = np.zeros_like(z)
        y[keep["at"]] = np.concatenate(labels)
        gz = np.where(live, 1.0 / (1.0 + np.exp(-z)) - y, 0.0).astype(np.float32)[:, :, None] / b
        dim = x.shape[2]
        grads = {"out": keep["full"].reshape(-1, 2 * h + dim).T @ gz.reshape(-1, 1), "bias": gz.sum((0, 1))}
        g_full = gz @ self.p["out"].T
        g_x = g_full[:, :, 2 * h:].copy()
        for d, lo in (("f", 0), ("b", h)):
            w = self.p["w" + d]
            gw, gc = np.zeros_like(w), np.zeros(4 * h, np.float32)
            dh, dc = np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
            for t, g, new, before, prev, tc in reversed(keep[d]):
                m = live[t][:, None].astype(np.float32)
                dh = dh + g_full[t, :, lo:lo + h]
                i, f, o = g[:, :h], g[:, h:2 * h], g[:, 2 * h:]
                ds = (dc + dh * o * (1 - tc * tc)) * m
                dz = np.concatenate([ds * new * i * (1 - i), ds * before * f * (1 - f),
                                     dh * m * tc * o * (1 - o), ds * i * (1 - new * new)], axis=1)
                gw[:dim] += x[t].T @ dz
                gw[dim:] += prev.T @ dz
                gc += dz.sum(0)
                back = dz @ w.T
                g_x[t] += back[:, :dim]
                dh = back[:, dim:] + dh * (1 - m)
                dc = ds * f + dc * (1 - m)
            grads["w" + d], grads["c" + d] = gw, gc
        cell = g_x[keep["at"]]
        for name, lo, width in (("path", 0, PATH_DIM), ("word", PATH_DIM, WORD_DIM)):
            ids, size, share = keep[name]
            g = np.zeros_like(self.p[name])
            np.add.at(g, ids, np.repeat(cell[:, lo:lo + width], size, axis=0) * share[:, None])
            grads[name] = g
        return grads

    def fit(self, pages: list, labels: list[np.ndarray], epochs: int = EPOCHS, batch: int = 16,
            rate: float = 0.01, seed: int = 12) -> Labeller:
        r = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, epochs * max(1, -(-len(pages) // batch))
        for _ in range(epochs):
            order = r.permutation(len(pages))
            for lo in range(0, len(order), batch):
                at = order[lo:lo + batch]
                step += 1
                lr = rate * (1 - step / (total + 1))
                for k, g in self._gradients([pages[i] for i in at], [labels[i] for i in at]).items():
                    np.clip(g, -1, 1, out=g)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    pace = lr * (0.3 if k == "word" else 1.0)  # words tell less than marks
                    self.p[k] -= (pace * (first[k] / (1 - 0.9 ** step))
                                  / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return self


#: Names that sites give to article containers and to the parts around them.
MAIN_NAMES = "article post content entry story main body text article-body post-content entry-content page-content".split()
NOISE_NAMES = {
    "nav": "nav menu navbar navigation main-menu breadcrumb breadcrumbs topnav tabs pagination pager toc",
    "header": "header masthead site-header banner top-bar branding logo",
    "footer": "footer site-footer bottom copyright colophon legal credits",
    "aside": "sidebar aside widget related recommended rail secondary popular trending teaser more-stories",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner-ad ad-slot adsense promoted",
    "notice": "notice cookie cookie-banner consent gdpr alert popup modal subscribe newsletter paywall disclaimer overlay",
    "form": "form search search-form login signup contact-form comment-form",
    "comments": "comments comment comment-list reader-comments responses discussion replies disqus feedback",
    "social": "share social share-buttons follow tags tag-list meta byline toolbar",
}


def made_pages(words: list[str], count: int = MADE_PAGES, seed: int = 13) -> list[str]:
    """Made-up pages.  Main text is marked by the letter U+E000 at its start."""
    r = np.random.default_rng(seed)
    words = words or ["text"]
    twice = words * 2

    def pick(options):
        return options[int(r.integers(len(options)))]

    def say(lo: int, hi: int) -> str:
        at = int(r.integers(len(words)))
        return html_lib.escape(" ".join(twice[at:at + int(r.integers(lo, hi))]))

    def links(lo: int, hi: int) -> str:
        items = [f'<a href="/{i}">{say(1, 4)}</a>' for i in range(int(r.integers(lo, hi)))]
        form = int(r.integers(3))
        if form == 0:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return "".join(f"<p>{x}</p>" for x in items) if form == 1 else " | ".join(items)

    def name(kind: str) -> str:
        n = pick(NOISE_NAMES[kind].split())
        return f' {pick(["class", "class", "id"])}="{n}"'

    def noise(kind: str) -> str:
        plain = r.random() < 0.3
        tag = {"nav": pick(["nav", "nav", "div", "ul"]), "header": pick(["header", "div"]),
               "footer": pick(["footer", "footer", "div"]), "aside": pick(["aside", "aside", "div"]),
               "form": pick(["form", "form", "div"]), "comments": pick(["section", "div", "div", "aside"])}.get(
                   kind, pick(["div", "div", "section", "p", "aside"]))
        own = "" if plain and tag in ("nav", "header", "footer", "aside", "form") else name(kind)
        body = {"nav": lambda: links(3, 9), "header": lambda: f"<h1>{say(1, 4)}</h1>" * int(r.random() < 0.5) + f"<p>{say(2, 9)}</p>",
                "footer": lambda: f"&copy; {say(2, 12)} &middot; {say(2, 9)}" + links(0, 4) * int(r.random() < 0.4),
                "aside": lambda: f"<h3>{say(1, 4)}</h3>" + (links(2, 6) if r.random() < 0.6 else f"<p>{say(8, 40)}</p>" * int(r.integers(1, 3))),
                "ad": lambda: say(3, 20) if r.random() < 0.6 else f"<p>{say(4, 25)}</p><a href='#'>{say(1, 4)}</a>",
                "notice": lambda: f"<p>{say(6, 40)}</p><button>{say(1, 3)}</button>",
                "form": lambda: f"<label>{say(1, 4)}</label><input><p>{say(2, 12)}</p><button>{say(1, 3)}</button>",
                "comments": lambda: f"<h3>{say(1, 4)}</h3>" + "".join(
                    f'<{pick(["div", "li", "p"])} class="comment">{say(5, 60)}' + pick(["<p>" + say(5, 40) + "</p>", ""])
                    for _ in range(int(r.integers(1, 5)))),
                "social": lambda: links(2, 5)}[kind]()
        return f"<{tag}{own}>{body}</{tag}>"

    def article() -> str:
        tag = pick(["article", "article", "article", "main", "div", "section", "td"])
        own = f' {pick(["class", "id"])}="{pick(MAIN_NAMES)}"' if tag in ("div", "section", "td") or r.random() < 0.4 else ""
        parts = [f"<h1>{say(3, 12)}</h1>"] if r.random() < 0.85 else []
        for _ in range(int(r.integers(1, 20))):
            form = r.random()
            text = say(1, 8) if r.random() < 0.3 else say(6, 110)
            if form < 0.62:
                parts.append(f"<p>{text}" + pick(["</p>", "</p>", ""]))
            elif form < 0.72:
                parts.append(f"<p><b>{text}<br>{say(5, 60)}")
            elif form < 0.80:
                parts.append(f"<h2>{say(2, 8)}</h2>")
            elif form < 0.87:
                parts.append("<ul>" + "".join(f"<li>{say(2, 20)}</li>" for _ in range(int(r.integers(2, 6)))) + "</ul>")
            elif form < 0.92:
                parts.append(f"<blockquote>{text}</blockquote>")
            elif form < 0.96:
                parts.append(f"<table><tr><td>{say(1, 6)}</td><td>{say(1, 6)}</td></tr></table>")
            else:
                parts.append(f"<p>{say(2, 20)} <a href='/x'>{say(1, 5)}</a> {say(2, 20)}</p>")
            if r.random() < 0.07:
                parts.append("</p>" + noise(pick(["ad", "ad", "aside", "social", "notice"])))
        return f"<{tag}{own}>" + "".join(parts) + f"</{tag}>"

    out = []
    for _ in range(count):
        before = [noise(k) for k in ("notice", "header", "nav", "ad", "form", "aside", "social") if r.random() < 0.45]
        after = [noise(k) for k in ("social", "comments", "aside", "ad", "form", "nav", "notice", "footer") if r.random() < 0.45]
        r.shuffle(before)
        body = "".join(before) + article() + "".join(after)
        if r.random() < 0.4:
            body = f'<div {pick(["class", "id"])}="{pick("wrapper container page site layout".split())}">{body}</div>'
        out.append(f"<html><head><title>{say(2, 9)}</title></head><body>{body}</body></html>")
    return out


def train(pages: list[str]) -> Labeller:
    words = [w for p in pages for b in blocks(p) for w in b.text.split(" ")]
    model = Labeller()
    paths, known = _Buckets(PATH_BUCKETS), _Buckets(WORD_BUCKETS)
    xs, ys = [], []
    for page in made_pages(words):
        bs = blocks(page)
        y = np.array(["" in b.text for b in bs], dtype=np.float32)
        for b in bs:
            b.text = b.text.replace("", "") or " "
        if bs:
            xs.append(model.encode(bs, paths, known))
            ys.append(y)
    return model.fit(xs, ys)


def fit(pages: DataFrame, key: str = "page_id", html: str = "html") -> Labeller:
    """Train with words of at most ``SAMPLE_PAGES`` pages, taken by a hash of the key."""
    keys = pages.select(key).distinct().orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(SAMPLE_PAGES)
    rows = (pages.select(key, text_or_empty(html).alias("h")).join(F.broadcast(keys), key)
            .dropDuplicates([key]).orderBy(key))
    return train([r["h"] for r in rows.toLocalIterator()])


def extract(pages: DataFrame, model: Labeller, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``: the blocks labelled main text, in order, joined by one
    space.  A null or empty page, or one without such a block, gives the empty text.
    Row-local: no shuffle."""
    spark = pages.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # fixed size

    @F.pandas_udf("string")
    def main_text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        paths, words = _Buckets(PATH_BUCKETS), _Buckets(WORD_BUCKETS)
        for s in parts:
            texts = []
            for lo in range(0, len(s), 512):
                cut = [blocks(p) for p in s.iloc[lo:lo + 512]]
                marks = m.scores([m.encode(bs, paths, words) for bs in cut])
                texts += [" ".join(b.text for b, y in zip(bs, ys) if y >= 0.5) for bs, ys in zip(cut, marks)]
            yield pd.Series(texts, dtype=object)

    return pages.withColumn(out, main_text(text_or_empty(html)))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages; empty where there is none (also for a null page)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    got = extract(pages, fit(pages))
    return got.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
