"""Main text of web pages with a recurrent block labeller (operator 9).

A page becomes its sequence of leaf blocks: the text between two block-level tags, with the
path of open elements (names, classes, ids).  Every block gets a vector of its hashed path,
its hashed words and a few measures.  A bidirectional LSTM in numpy reads the sequence
both ways, so each block is judged with the whole page around it; blocks of one path
share the mean of their scores.  Blocks judged to be article text are joined.

An exact check follows: text inside elements that can't hold article text by their
meaning (navigation, footers, asides, page headers, forms beside or inside the article)
is never kept.  Blocks of a form around the whole page are left to the labeller.

Training: a bounded sample of ``sample_pages`` pages by hash order, labelled by where
their blocks stand, and pages composed by rule from the sample's words in many layouts
(menus, notices, adverts, forms, comments, articles with and without article tags).  The
model is a few thousand numbers, fitted on the driver and broadcast.

Nulls and ties: a null or empty html gives an empty text; a null url or id stays null;
repeated rows are extracted each; broken markup (missing end tags, stray brackets, cut pages)
is read as far as it goes; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col

PATH_DIM, WORD_DIM, MEASURES = 192, 32, 8
HIDDEN = 16
SAMPLE_PAGES = 200
COMPOSED_PAGES = 1200
SEED = 42

# Element names of HTML.
RAW = set("script style noscript template svg iframe textarea select title object canvas video audio".split())
#: Of these, those that hold plain text: no self-closed form, and an unclosed one goes to the end of the page.
PLAIN = {"script", "style", "textarea", "title"}
BLOCK = set(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption button label".split()
)
VOID = {"hr", "br", "img", "input", "meta", "link", "wbr", "source", "col", "area", "base", "embed", "track"}
#: An opening tag ends the nearest open element of these, unless one of the second set is nearer.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
FORMS = {"form", "fieldset"}
NEVER = {"nav", "footer", "aside", "button", "label", "legend", "menu", "dialog", "search", "head"}
#: Words that name the article's block in class and id attributes.
CONTENT = set("content article post entry story text main body page detail prose markdown".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S | re.I,
)
END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PIECE = re.compile(r"[A-Za-z]+")


def blocks(page: str | None) -> list[tuple[str, tuple, float]]:
    """(text, path, share of link characters) of every leaf block, in page order."""
    if not page:
        return []
    out: list[tuple[str, tuple, float]] = []
    stack: list[tuple[str, str]] = []
    text: list[str] = []
    linked, link = 0, 0
    at = 0

    def flush():
        nonlocal linked
        if text:
            said = " ".join(entities.unescape("".join(text)).split())
            if said:
                out.append((said, tuple(s[1] for s in stack), linked / max(1, sum(map(len, text)))))
            text.clear()
        linked = 0

    def say(piece: str):
        nonlocal linked
        if piece:
            text.append(piece)
            linked += len(piece) if link else 0

    unclosed: set[str] = set()
    while m := TOKEN.search(page, at):
        say(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, closing = name.lower(), m[1] or m[4]
        if name in RAW:
            if closing or name not in PLAIN and (name in unclosed or m[0].endswith("/>")):
                continue
            end = END[name].search(page, at)
            if end:
                at = end.end()
            elif name in PLAIN:
                at = len(page)
            else:
                unclosed.add(name)  # nor is any later one closed
            continue
        if name == "a":
            link = 0 if closing else 1
        elif name == "br":
            say(" ")
        elif name in BLOCK:
            flush()
            names = [s[0] for s in stack]
            if closing:
                if name in names:
                    del stack[len(names) - 1 - names[::-1].index(name) :]
                    link = 0
                continue
            over, bound = ENDS.get(name, ({"p"}, {"td", "th", "div", "article", "section", "li", "body"}))
            if name == "p" or name not in ("button", "label"):
                if names and names[-1] == "p":
                    stack.pop()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in bound or name not in ENDS:
                    break
                if stack[k][0] in over:
                    del stack[k:]
                    break
            if name not in VOID:
                attributes = (m[3] or m[6] or "").lower()
                own = " ".join(PIECE.findall(" ".join(a or b or c for a, b, c in NAMED.findall(attributes)))) if "=" in attributes else ""
                stack.append((name, f"{name} {own}".strip()))
    say(page[at:])
    flush()
    return out


def articles(page: list[tuple[str, tuple, float]]) -> bool:
    """Whether the page has an article or main element that no form holds."""
    for path in {path for _, path, _ in page}:
        for p in path:
            name = p.split(" ", 1)[0]
            if name in FORMS:
                break
            if name in ("article", "main"):
                return True
    return False


def barred(path: tuple, apart: bool = True) -> bool:
    """Whether an element on the path can't hold article text.

    A form may hold the whole page.  One with an article, main or content block inside it on the path is
    not barred, nor is any where the page has no article apart from forms (``apart``): the labeller judges.
    """
    names = [p.split(" ", 1)[0] for p in path]
    inside = next((i for i, n in enumerate(names) if n in ("article", "main")), None)
    held = max((i for i, p in enumerate(path) if names[i] in ("article", "main") or not CONTENT.isdisjoint(p.split(" ")[1:])), default=-1)
    for i, n in enumerate(names):
        if n in FORMS:
            if i > held and (apart or (inside is not None and inside < i)):
                return True
        elif n in NEVER or (n == "header" and (inside is None or i < inside)):
            return True
    return False


def _cell(token: str, size: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % size


def path_cells(path: tuple) -> list[int]:
    """Cells of every name and class word on the path, and of the innermost two elements once more."""
    tokens = set()
    for p in path:
        name, *own = p.split(" ")
        tokens.add("<" + name)
        tokens.update(own)
        tokens.update(w[:-1] for w in own if len(w) > 3 and w.endswith("s"))
    tokens.update(f"{i}^{p.split(' ', 1)[0]}" for i, p in enumerate(path[:-3:-1]))
    return [_cell(t, PATH_DIM) for t in tokens]


def vectors(page: list[tuple[str, tuple, float]], memo: dict) -> np.ndarray:
    """One vector per block."""
    out = np.zeros((len(page), PATH_DIM + WORD_DIM + MEASURES), np.float32)
    for i, (text, path, links) in enumerate(page):
        cells = memo.get(path)
        if cells is None:
            cells = memo[path] = path_cells(path)
        out[i, cells] = 1.0
        words = text.split(" ")
        n = len(words)
        hashed = [memo.get(w) for w in words]
        for k, h in enumerate(hashed):
            if h is None:
                if len(memo) > 500_000:
                    memo.clear()
                hashed[k] = memo[words[k]] = _cell(words[k].lower(), WORD_DIM)
        out[i, PATH_DIM : PATH_DIM + WORD_DIM] = np.sqrt(np.bincount(hashed, minlength=WORD_DIM)[:WORD_DIM] / n)
        ends = text[-1] in ".!?…\"”»"
        out[i, PATH_DIM + WORD_DIM :] = (np.log1p(n) / 4, links, ends, i / max(1, len(page)), len(path) / 8, text.isupper(), "©" in text, np.log1p(len(page)) / 5)
    return out


class Labeller:
    """Bidirectional LSTM with one logit per block."""

    def __init__(self, size: int, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = {}
        for d in "fb":
            self.p["w" + d] = rng.normal(0, 0.1, (size, 4 * hidden)).astype(np.float32)
            self.p["u" + d] = rng.normal(0, 0.2, (hidden, 4 * hidden)).astype(np.float32)
            self.p["a" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32)
        self.p["v"] = rng.normal(0, 0.2, (2 * hidden,)).astype(np.float32)
        self.p["c"] = np.zeros(1, np.float32)
        self.hidden = hidden

    def _pass(self, gates: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: bool):
        steps, n, h4 = gates.shape
        k = h4 // 4
        h = np.zeros((n, k), np.float32)
        c = np.zeros((n, k), np.float32)
        hs, kept = np.empty((steps, n, k), np.float32), []
        for t in range(steps):
            z = gates[t] + h @ u
            s = 1 / (1 + np.exp(-np.clip(z[:, : 3 * k], -30, 30)))
            i, f, o = s[:, :k], s[:, k : 2 * k], s[:, 2 * k :]
            g = np.tanh(z[:, 3 * k :])
            new = f * c + i * g
            tc = np.tanh(new)
            m = mask[t][:, None]
            if keep:
                kept.append((i, f, o, g, c, tc, h, m))
            c = np.where(m, new, c)
            h = np.where(m, o * tc, h)
            hs[t] = h
        return hs, kept

    def _back(self, dh_out: np.ndarray, kept: list, u: np.ndarray):
        steps, n, k = dh_out.shape
        dgates = np.zeros((steps, n, 4 * k), np.float32)
        du = np.zeros_like(u)
        dh, dc = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        for t in range(steps - 1, -1, -1):
            i, f, o, g, c, tc, h, m = kept[t]
            d = dh + dh_out[t]
            dn = np.where(m, d, 0)
            dcn = np.where(m, dc, 0) + dn * o * (1 - tc * tc)
            z = np.concatenate([dcn * g * i * (1 - i), dcn * c * f * (1 - f), dn * tc * o * (1 - o), dcn * i * (1 - g * g)], axis=1)
            dgates[t] = z
            du += h.T @ z
            dh = z @ u.T + np.where(m, 0, d)
            dc = dcn * f + np.where(m, 0, dc)
        return dgates, du

    def _batch(self, pages: list[np.ndarray]):
        steps = max(map(len, pages))
        x = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
        mask = np.zeros((steps, len(pages)), bool)
        for j, p in enumerate(pages):
            x[: len(p), j], mask[: len(p), j] = p, True
        return x, mask

    def logits(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Logits of every block of every page; pages of like length go together."""
        out: list = [None] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            upto = at + 1
            while upto < len(order) and (upto + 1 - at) * len(pages[order[upto]]) <= 8192:
                upto += 1
            part = order[at:upto]
            x, mask = self._batch([pages[i] for i in part])
            hf, _ = self._pass(x @ self.p["wf"] + self.p["af"], mask, self.p["uf"], False)
            hb, _ = self._pass((x @ self.p["wb"] + self.p["ab"])[::-1], mask[::-1], self.p["ub"], False)
            z = np.concatenate([hf, hb[::-1]], axis=2) @ self.p["v"] + self.p["c"]
            for j, i in enumerate(part):
                out[i] = z[: len(pages[i]), j]
            at = upto
        return [np.zeros(0, np.float32) if o is None else o for o in out]

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 10, batch: int = 32, rate: float = 0.01, seed: int = SEED) -> Labeller:
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        order, step = np.arange(len(pages)), 0
        for epoch in range(epochs):
            rng.shuffle(order)
            for at in range(0, len(order), batch):
                part = sorted(order[at : at + batch], key=lambda i: len(pages[i]))
                x, mask = self._batch([pages[i] for i in part])
                y = np.zeros(mask.shape, np.float32)
                for j, i in enumerate(part):
                    y[: len(labels[i]), j] = labels[i]
                hf, kf = self._pass(x @ self.p["wf"] + self.p["af"], mask, self.p["uf"], True)
                hb, kb = self._pass((x @ self.p["wb"] + self.p["ab"])[::-1], mask[::-1], self.p["ub"], True)
                h = np.concatenate([hf, hb[::-1]], axis=2)
                z = h @ self.p["v"] + self.p["c"]
                dz = np.where(mask, 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y, 0).astype(np.float32) / max(1, mask.sum()) * 8
                grad = {"v": np.tensordot(dz, h, ((0, 1), (0, 1))), "c": dz.sum(keepdims=True).reshape(1)}
                dh = dz[:, :, None] * self.p["v"]
                for d, (k, rev) in {"f": (kf, slice(None)), "b": (kb, slice(None, None, -1))}.items():
                    part_dh = dh[:, :, : self.hidden] if d == "f" else dh[:, :, self.hidden :]
                    dg, du = self._back(part_dh[rev], k, self.p["u" + d])
                    dg = dg[rev]
                    grad["w" + d] = np.tensordot(x, dg, ((0, 1), (0, 1)))
                    grad["u" + d], grad["a" + d] = du, dg.sum((0, 1))
                step += 1
                for k, g in grad.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    self.p[k] = self.p[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
        return self


# Words that name the parts of a page in class and id attributes.
SIDE = (
    "ad ads advert advertisement banner sponsor sponsored promo cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup login search menu nav navbar navigation "
    "topbar breadcrumb breadcrumbs sidebar side widget rail related recommended share social toolbar comments comment reply respond discussion disqus footer foot bottom copyright legal header masthead logo top pagination pager tags"
).split()


def placed(path: tuple, apart: bool = True) -> int:
    """Label of a block by where it stands, for the sample of given pages."""
    names = [p.split(" ", 1)[0] for p in path]
    words = {w for p in path for w in p.split(" ")[1:]}
    if barred(path, apart) or words & set(SIDE):
        return 0
    return int(any(n in ("article", "main") for n in names) or bool(words & CONTENT))


def composed(vocabulary: list[str], n: int, seed: int = SEED) -> tuple[list, list]:
    """Pages composed by rule as block sequences, with the label of every block."""
    rng = np.random.default_rng(seed)
    pick = lambda options: options[int(rng.integers(len(options)))]

    def say(low: int, high: int) -> str:
        words = [vocabulary[i] for i in rng.integers(0, len(vocabulary), int(rng.integers(low, high + 1)))]
        return " ".join(words) + pick([".", ".", ".", "", "!"])

    def side(base: tuple) -> list:
        kind = pick(["links", "note", "note", "form", "comments", "ad", "header", "footer", "aside"])
        named = lambda *w: f"{pick(['div', 'div', 'section', 'ul'])} {pick(list(w) or SIDE)}"
        if kind == "links":
            box = pick([("nav",), ("nav", "ul"), (named("menu", "nav", "navbar", "navigation", "breadcrumb", "related", "tags", "pagination", "share", "social"),)])
            return [(say(1, 3), (*base, *box, "li"), 1.0, 0) for _ in range(int(rng.integers(2, 9)))]
        if kind == "comments":
            box = (named("comments", "comment", "reply", "respond", "discussion", "disqus"),)
            return [(say(1, 40), (*base, *box, *pick([(), ("p",), ("div comment", "p"), ("li", "p"), ("article comment", "p")])), 0.0, 0) for _ in range(int(rng.integers(1, 6)))]
        if kind == "form":
            box = (pick(["form", "form search", "div newsletter", "div subscribe", "div login", "div signup"]),)
            return [(say(1, 8), (*base, *box, *pick([(), ("p",), ("label",), ("button",)])), 0.0, 0) for _ in range(int(rng.integers(1, 4)))]
        if kind == "header":
            return [(say(1, 8), (*base, pick(["header", "header masthead", "div header", "div masthead", "div topbar", "div logo"]), *pick([(), ("h1",), ("p",), ("div",)])), float(rng.random() < 0.3), 0) for _ in range(int(rng.integers(1, 3)))]
        if kind == "footer":
            return [(pick(["© ", ""]) + say(2, 20), (*base, pick(["footer", "div footer", "div copyright", "div legal", "div bottom"]), *pick([(), ("p",), ("div",)])), 0.0, 0) for _ in range(int(rng.integers(1, 3)))]
        if kind == "aside":
            return [(say(2, 30), (*base, pick(["aside", "aside sidebar", "div sidebar", "div widget", "div rail", "div side"]), *pick([(), ("p",), ("h3",), ("ul", "li")])), float(rng.random() < 0.4), 0) for _ in range(int(rng.integers(1, 5)))]
        return [(say(2, 30), (*base, f"{pick(['div', 'p', 'section', 'aside'])} {pick(SIDE)}", *pick([(), (), ("p",), ("span",)])), float(rng.random() < 0.3), 0) for _ in range(int(rng.integers(1, 3)))]

    named_content = sorted(CONTENT)
    pages, labels = [], []
    for _ in range(n):
        top = (*pick([("html", "body"), ("html", "body"), ("body",), ()]), *pick([(), (), ("div wrapper",), ("div container",), ("div page",)]))
        if rng.random() < 0.15:  # a form around the whole page
            at = top.index("body") + 1 if "body" in top else 0
            top = (*top[:at], pick(["form", "form aspnetForm", "form form"]), *top[at:])
        frame = pick([("article",), ("article",), ("main",), ("main", "article"), (f"article {pick(named_content)}",), (f"div {pick(named_content)}",), (f"div {pick(named_content)}",), (f"section {pick(named_content)}",), (f"div {pick(named_content)} {pick(named_content)}", "div")])
        page = []
        for _ in range(int(rng.integers(0, 5))):
            page += side(top)
        body = [(say(2, 10), (*top, *frame, pick(["h1", "h1", "h2"])), 0.0, 1)] if rng.random() < 0.85 else []
        for _ in range(int(rng.integers(1, 14))):
            leaf = pick([("p",), ("p",), ("p",), ("p",), ("h2",), ("ul", "li"), ("blockquote", "p"), ("pre",), (), ("table", "tr", "td")])
            body.append((say(1, 60), (*top, *frame, *leaf), 0.2 * float(rng.random() < 0.1), 1))
            if rng.random() < 0.06:
                body += side((*top, *frame))
        page += body
        for _ in range(int(rng.integers(0, 5))):
            page += side((*top, *frame) if rng.random() < 0.15 else top)
        pages.append([b[:3] for b in page])
        labels.append(np.array([b[3] for b in page], np.float32))
    return pages, labels


def trained(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, id_col: str = "page_id", html_col: str = "html") -> Labeller:
    """The labeller fitted on the documented sample and the composed pages.

    The sample is the ``sample_pages`` lowest row hashes below a bound that about eight
    times as many rows pass, so what tasks send doesn't follow their number.
    """
    bound = 1.0 if (n := pages.count()) <= 8 * sample_pages else 8 * sample_pages / n
    rows = pages.select(col(html_col).cast("string").alias("h"), F.xxhash64(col(id_col), col(html_col)).alias("k"))
    rows = rows.filter((F.pmod("k", F.lit(1 << 40)) < F.lit(int(bound * (1 << 40)))) & F.col("h").isNotNull())
    rows = rows.orderBy("k", "h").limit(sample_pages).collect()
    given = [b for b in (blocks(r["h"]) for r in rows) if b]
    words = [w for p in given for text, _, _ in p for w in text.split(" ")[:50]] or "a bare page without any words of its own".split()
    made, labels = composed(words, COMPOSED_PAGES)
    labels += [np.array([placed(path, apart) for _, path, _ in p], np.float32) for p in given for apart in [articles(p)]]
    memo: dict = {}
    x = [vectors(p, memo) for p in [*made, *given]]
    return Labeller(x[0].shape[1]).fit(x, labels)


def decide(page: list[tuple[str, tuple, float]], logits: np.ndarray) -> list[str]:
    """The texts kept: blocks of one path share their mean score."""
    total: dict = {}
    apart = articles(page)
    for (_, path, _), z in zip(page, logits.tolist()):
        s = total.setdefault(path, [0.0, 0])
        s[0] += z
        s[1] += 1
    return [text for text, path, _ in page if total[path][0] > 0 and not barred(path, apart)]


def extract(pages: DataFrame, model: Labeller | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text`` of every page."""
    model = model or trained(pages, id_col=id_col, html_col=html_col)
    sent = pages.sparkSession.sparkContext.broadcast(model)
    rows = pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"), col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for b in batches:
            for at in range(0, len(b), 256):  # vectors of few pages at a time
                part = b.slice(at, 256)
                cut = [blocks(h) for h in part.column(2).to_pylist()]
                logits = sent.value.logits([vectors(p, memo) for p in cut])
                texts = ["\n\n".join(decide(p, z)) for p, z in zip(cut, logits)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return rows.mapInArrow(run, T.StructType([rows.schema["page_id"], rows.schema["url"]]).add("text", "string"))
