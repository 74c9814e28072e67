"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks (runs of text between block-level tags).  Each block has binary features
from its ancestor tags, their class and id words, and its text; a two-state chain (main text or not)
scores blocks and transitions, is trained by gradient ascent on the likelihood of labelled pages, and
decoded by Viterbi.

Labelled pages: a bounded sample of the distinct pages is labelled where mark-up tells (an ``article`` or
``main`` that is not inside page furniture), and its blocks are also set into further page layouts
whose parts are known (``layout``), so that the model does not hang on one site's tags.  Where mark-up labels
nothing in the sample, the layouts alone are the labelled pages: long sentences of the sampled blocks fill
their main text, the other blocks their furniture.  If all pages are longer than ``SAMPLE_CHARS``, the sample
is of their beginnings; without any text, fixed words fill the layouts.  So a trained chain always decodes.

Defined results: null or empty html has an empty text.  Character references are decoded once, white
space in a block becomes one space, ``br`` is white space, an unclosed comment, script or style runs to the end.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.frames import ROW, annotate

SAMPLE = 120
SAMPLE_CHARS = 60_000
"""Bounds of the training sample: pages, and characters of a page."""

# Elements of the mark-up language.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li legend main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead title tr ul caption button textarea label".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template iframe svg canvas title object audio video math".split())
RAW = frozenset("script style textarea title iframe noscript".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
"""Elements that end when the key begins beside them."""
SCOPE = frozenset("ul ol dl table select body html div section article".split())

_TAG = re.compile(r"<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|[!?/][^>]*(?:>|\Z))", re.S)
_LOOSE = re.compile(r"<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>[^>]*)>")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PIECE = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Block:
    tags: tuple[str, ...]
    """Ancestors, outermost first."""
    names: tuple[str, ...]
    """Words of their class, id and role attributes."""
    text: str
    linked: int
    """Characters inside links."""


DEPTH = 128
"""Open elements a page may nest; an element below these takes the place of the innermost one."""


def blocks(page: str) -> list[Block]:
    """The non-empty leaf blocks of a page in page order, in time linear in the page's length."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    links, linked, hidden, at, n = 0, 0, 0, 0, len(page)
    last = page.rfind(">")

    def flush() -> None:
        nonlocal held, linked
        text = " ".join("".join(held).split())
        if text:
            out.append(Block(tuple(t for t, _ in stack), tuple(w for _, ws in stack for w in ws), text, linked))
        held, linked = [], 0

    def pop(until: int) -> None:
        nonlocal hidden, links
        for tag, _ in stack[until:]:
            hidden -= tag in UNSEEN
            links -= tag == "a"
        del stack[until:]

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at and not hidden:
            text = entities.unescape(page[at:lt])
            held.append(text)
            if links:
                linked += len(text.strip())
        if lt == n:
            break
        # Without a ">" to come only comments and declarations are left, which end with the page.
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt) if lt < last or page[lt + 1 : lt + 2] in "!?/" else None
        if m is None:
            if not hidden:
                held.append("<")
            at = lt + 1
            continue
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["close"]:
            where = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if name in BLOCKS:
                flush()
            elif name in UNSEEN and not hidden:
                held.append(" ")
            if where is not None and (name in BLOCKS or not any(t in BLOCKS for t, _ in stack[where + 1 :])):
                pop(where)
            continue
        if name in BLOCKS:
            flush()
            for i in range(len(stack) - 1, -1, -1):
                tag = stack[i][0]
                if tag == "p" or tag in CLOSES.get(name, ()):
                    pop(i)
                    break
                if tag in SCOPE:
                    break
        if name == "br":
            held.append("\n")
        if name in VOID:
            continue
        if m["rest"].endswith("/") and name not in BLOCKS and name != "a":
            continue
        words = tuple(
            w for g in _NAMES.findall(m["rest"]) for x in g if x for w in _PIECE.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", x).lower())
        )
        if len(stack) >= DEPTH:
            pop(DEPTH - 1)
        stack.append((name, words))
        hidden += name in UNSEEN
        links += name == "a"
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            stop = end.start() if end else n
            if not hidden and stop > at:
                held.append(entities.unescape(page[at:stop]))
            at = stop
    flush()
    return out


# Words in class and id attributes that name page furniture or main text.
FURNITURE = {
    "menu": "nav navbar navigation menu menubar topnav breadcrumb breadcrumbs sitemap pagination pager toc tabs toolbar skip",
    "head": "header masthead banner topbar logo brand hero top",
    "foot": "footer foot bottom copyright legal colophon imprint",
    "side": "sidebar side aside rail widget widgets related recommended recommendations trending popular more tags archive complementary",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay warning message banner privacy dialog toast",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted commercial partner banner",
    "form": "form login signin signup subscribe subscription newsletter search contact register input field",
    "comment": "comment comments commentlist commenter reply replies discussion discuss respond disqus feedback reader readers thread reviews",
    "share": "share sharing social follow facebook twitter print email",
}
MAIN = "article content post entry story main body text prose page hentry blog articlebody contentinfo document copy"
_GROUPS: dict[str, tuple[str, ...]] = {}
for _kind, _words in {**FURNITURE, "main": MAIN}.items():
    for _w in _words.split():
        _GROUPS[_w] = (*_GROUPS.get(_w, ()), _kind)
_GROUPS["contentinfo"] = ("foot",)


def features(block: Block, place: int, total: int) -> list[str]:
    """Names of the binary features that hold."""
    text, n = block.text, len(block.text)
    words = text.count(" ") + 1
    blocky = [t for t in block.tags if t in BLOCKS]
    kinds = {k for w in block.names for k in _GROUPS.get(w, ())}
    # The words of the nearest named ancestors say more than a page-wide wrapper's.
    near = {k for w in block.names[-3:] for k in _GROUPS.get(w, ())}
    out = ["bias", f"tag={blocky[-1] if blocky else '-'}", f"size={min(8, n.bit_length() // 1)}", f"words={min(7, words.bit_length())}"]
    out += [f"in={t}" for t in {*block.tags} - {"html", "body", "b", "i", "p", "span", "em", "strong"}]
    out += [f"kind={k}" for k in kinds] + [f"near={k}" for k in near]
    share = block.linked / n
    out.append(f"links={0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.7 else 3}")
    if text[-1:] in ".!?…»\"”":
        out.append("sentence")
    if "©" in text or "copyright" in text.lower():
        out.append("copyright")
    if not kinds:
        out.append("unnamed")
    out.append("first" if place == 0 else "last" if place == total - 1 else "inner")
    return out


# Parts of page layouts; {m} is a block of main text, {x} one of furniture.
AROUND = (
    "<main>{}</main>", "<article>{}</article>", "<main><article>{}</article></main>", '<div id="content">{}</div>',
    '<div class="post"><div class="entry-content">{}</div></div>', '<section class="story">{}</section>', "<div>{}</div>",
    '<div class="page-wrapper"><div class="article-body">{}</div></div>', "<table><tr><td>{}</td></tr></table>",
    '<article class="post"><div class="prose">{}</div></article>', '<div role="main">{}</div>', "{}",
)
INNER = (
    "<h1>{m}</h1><p>{m}</p><p>{m}</p>", "<h2>{m}</h2><p>{m}</p><blockquote>{m}</blockquote><p>{m}</p>",
    "<p>{m}</p><ul><li>{m}</li><li>{m}</li></ul><p>{m}</p>", "<header><h1>{m}</h1></header><p>{m}</p><h2>{m}</h2><p>{m}</p>",
    "<h1>{m}</h1><table><tr><td>{m}</td><td>{m}</td></tr></table><p>{m}</p>", "<h1>{m}</h1><pre>{m}</pre><p>{m}</p><h3>{m}</h3><p>{m}</p>",
    "<h1>{m}</h1><p>{m}</p><figure><figcaption>{m}</figcaption></figure><p>{m}</p>", "<div>{m}</div><div>{m}</div><div>{m}</div>",
)
BEFORE = (
    '<header><a href="/">{x}</a></header>', "<header><h1>{x}</h1><p>{x}</p></header>", '<div class="site-header"><h1>{x}</h1></div>',
    '<nav><ul><li><a href="/">{x}</a></li><li><a href="/">{x}</a></li></ul></nav>', '<div id="nav"><a href="/">{x}</a></div>',
    '<ul class="menu"><li>{x}</li><li>{x}</li></ul>', '<div class="cookie-notice"><p>{x}</p><button>{x}</button></div>',
    '<div class="alert"><p>{x}</p></div>', '<div id="gdpr-consent">{x}</div>', '<div role="banner"><p>{x}</p></div>',
    '<div class="topbar">{x}</div>', '<div class="breadcrumbs"><a href="/">{x}</a></div>', "<nav><p>{x}</p></nav>",
)
AMONG = (
    '<div class="ad"><p>{x}</p></div>', '<div class="advertisement">{x}</div>', '<aside class="promo"><p>{x}</p></aside>', "<aside><p>{x}</p></aside>",
    '<div class="sponsored-box"><p>{x}</p></div>', '<form class="search"><p>{x}</p></form>', '<div class="share"><a href="/">{x}</a></div>',
    '<div class="related"><ul><li><a href="/">{x}</a></li></ul></div>', '<div class="notice"><p>{x}</p></div>',
    "<nav><a href=\"/\">{x}</a></nav>", '<div class="newsletter-signup"><p>{x}</p></div>', "<footer><p>{x}</p></footer>",
)
AFTER = (
    "<aside><h3>{x}</h3><p>{x}</p></aside>", '<div class="sidebar"><p>{x}</p><a href="/">{x}</a></div>', '<div id="sidebar"><h2>{x}</h2><ul><li>{x}</li></ul></div>',
    '<section class="comments"><h3>{x}</h3><div class="comment"><p>{x}</p></div><div class="comment"><p>{x}</p></div></section>',
    '<div id="comments"><p>{x}</p><p>{x}</p></div>', '<ol class="commentlist"><li>{x}</li><li class="reply"><p>{x}</p></li></ol>',
    '<div class="discussion"><div><p>{x}</p></div></div>', "<form><label>{x}</label><p>{x}</p><button>{x}</button></form>", '<form id="login">{x}</form>',
    '<div class="subscribe"><p>{x}</p></div>', '<div class="widget"><p>{x}</p></div>', "<footer>{x}</footer>", "<footer><p>{x}</p><p>{x}</p></footer>",
    '<div class="footer">{x}</div>', '<div class="copyright">&copy; {x}</div>', '<p class="legal">{x}</p>', '<div class="ad-slot"><p>{x}</p></div>',
    '<div class="popup modal"><p>{x}</p></div>',
)
VARIANTS = 6


def layout(seed: int) -> str:
    """A page layout put together from the parts."""
    pick = np.random.default_rng(seed)

    def some(parts: tuple[str, ...], most: int) -> list[str]:
        return [parts[i] for i in pick.choice(len(parts), pick.integers(0, most + 1), replace=False)]

    inner = re.split(r"(?<=</p>)(?=<)", INNER[pick.integers(len(INNER))])
    for part in some(AMONG, 2):
        inner.insert(int(pick.integers(0, len(inner) + 1)), part)
    # Readers' comments may stand inside the article.
    inner += some(AFTER[3:7], 1) if pick.random() < 0.3 else []
    main = AROUND[pick.integers(len(AROUND))].replace("{}", "".join(inner))
    return "<body>" + "".join([*some(BEFORE, 4), main, *some(AFTER, 5)]) + "</body>"


_OUTSIDE = frozenset("nav header footer aside form menu button select label textarea dialog".split())


def told(block: Block) -> bool | None:
    """The label that mark-up tells, if it does."""
    if "article" not in block.tags and "main" not in block.tags:
        return False
    start = max(i for i, t in enumerate(block.tags) if t in ("article", "main"))
    kinds = {k for w in block.names for k in _GROUPS.get(w, ())} - {"main"}
    return not (kinds or _OUTSIDE & set(block.tags[start + 1 :]) or {"nav", "footer", "aside", "form"} & set(block.tags))


Labelled = list[tuple[list[list[str]], list[int]]]


def _variants(main: list[str], rest: list[str], first: int, shift: int = 0) -> Labelled:
    """``VARIANTS`` layouts from number ``first`` on, filled with the texts from place ``shift`` on."""
    out = []
    for variant in range(VARIANTS):
        labels: list[int] = []

        def fill(m: re.Match, labels=labels) -> str:
            j = len(labels)
            labels.append(int(m[0] == "{m}"))
            # Readers' comments and notices are prose too.
            pool = main if m[0] == "{m}" or j % 2 else rest
            return entities.escape(pool[(j + shift) % len(pool)])

        made = blocks(re.sub(r"\{[mx]\}", fill, layout(first + variant)))
        if len(made) == len(labels):
            out.append(([features(b, j, len(made)) for j, b in enumerate(made)], labels))
    return out


# What fills the layouts of a sample without any text, and the words of a long sentence.
FILL = (("A heading", "A sentence of some length that says a little about one thing.", "Another sentence, which goes on from there to the next."), ("Home", "More", "A notice."))
LONG = 8


def labelled(pages: list[str]) -> Labelled:
    """Training sequences: feature names and labels of the blocks of each page and its variants."""
    out = []
    cut = [blocks(page) for page in pages]
    for i, found in enumerate(cut):
        marks = [told(b) for b in found]
        main = [b.text for b, k in zip(found, marks, strict=True) if k]
        rest = [b.text for b, k in zip(found, marks, strict=True) if not k]
        if not main or not rest:
            continue
        out.append(([features(b, j, len(found)) for j, b in enumerate(found)], [int(k) for k in marks]))
        out += _variants(main, rest, i * VARIANTS)
    if out:
        return out
    long = [b.text for found in cut for b in found if b.text.count(" ") + 1 >= LONG and not b.linked]
    other = [b.text for found in cut for b in found if b.text.count(" ") + 1 < LONG or b.linked]
    long, other = long or other or list(FILL[0]), other or long or list(FILL[1])
    # Headings are main text too.
    main = [t for i, x in enumerate(long) for t in ((x,) if i % 4 else (other[i % len(other)], x))]
    for i in range(SAMPLE):
        out += _variants(main, other, i * VARIANTS, 7 * i)
    return out


@dataclass
class Chain:
    """Weights: a score of label 1 against 0 for each feature, and of each pair of neighbouring labels."""

    weights: dict[str, float]
    moves: np.ndarray

    def decode(self, sequence: list[list[str]]) -> list[int]:
        """The labels of highest score (Viterbi)."""
        if not sequence:
            return []
        get = self.weights.get
        stay0, enter, leave, stay1 = self.moves.ravel().tolist()
        back: list[tuple[int, int]] = []
        zero, one = 0.0, sum(get(f, 0.0) for f in sequence[0])
        for fs in sequence[1:]:
            s = sum(get(f, 0.0) for f in fs)
            from0, from1 = zero + enter, one + stay1
            to0, to1 = zero + stay0, one + leave
            back.append((int(to1 > to0), int(from1 > from0)))
            zero, one = max(to0, to1), max(from0, from1) + s
        out = [int(one > zero)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]


def fit(sequences: list[tuple[list[list[str]], list[int]]], rounds: int = 200, rate: float = 0.5, decay: float = 1e-4) -> Chain:
    """Maximum likelihood with a quadratic penalty, by full-batch gradient ascent (scaled steps)."""
    index = {f: i for i, f in enumerate(sorted({f for s, _ in sequences for fs in s for f in fs}))}
    longest = max(len(y) for _, y in sequences)
    labels = np.full((len(sequences), longest), -1)
    rows, cols = [], []
    for i, (s, y) in enumerate(sequences):
        labels[i, : len(y)] = y
        for j, fs in enumerate(s):
            rows += [i * longest + j] * len(fs)
            cols += [index[f] for f in fs]
    rows, cols = np.array(rows), np.array(cols)
    real = labels >= 0
    pairs = real[:, 1:]
    seen = np.array([[((labels[:, :-1] == a) & (labels[:, 1:] == b) & pairs).sum() for b in (0, 1)] for a in (0, 1)], float)
    w, moves = np.zeros(len(index)), np.zeros((2, 2))
    gw, gm = np.full(len(index), 1e-6), np.full((2, 2), 1e-6)
    for _ in range(rounds):
        emit = np.zeros((len(sequences), longest, 2))
        emit[:, :, 1] = np.bincount(rows, w[cols], minlength=labels.size).reshape(labels.shape)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0]
        for t in range(1, longest):
            step = np.logaddexp(ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1]) + emit[:, t]
            ahead[:, t] = np.where(real[:, t, None], step, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            later = emit[:, t + 1] + behind[:, t + 1]
            step = np.stack([np.logaddexp(*(later + moves[a]).T) for a in (0, 1)], axis=1)
            behind[:, t] = np.where(real[:, t + 1, None], step, 0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])[:, None]
        p = np.where(real, np.exp(ahead[:, :, 1] + behind[:, :, 1] - total), 0)
        expected = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                q = ahead[:, :-1, a] + moves[a, b] + emit[:, 1:, b] + behind[:, 1:, b] - total
                expected[a, b] = np.exp(q[pairs]).sum()
        error = np.where(real, labels, 0) - p
        dw = np.bincount(cols, error.ravel()[rows], minlength=len(w)) - decay * len(sequences) * w
        dm = seen - expected - decay * len(sequences) * moves
        gw += dw * dw
        gm += dm * dm
        w += rate * dw / np.sqrt(gw)
        moves += rate * dm / np.sqrt(gm)
    return Chain({f: float(w[i]) for f, i in index.items()}, moves)


def train(pages: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Chain:
    """Fit on at most ``sample`` distinct pages of at most ``chars`` characters, chosen by a hash of the page.

    If all pages are longer, on the first ``chars`` characters of as many of them.
    """
    size = F.char_length("html")
    chosen = _chosen(pages.where(size.between(1, chars)).select("html"), sample)
    if not chosen:
        chosen = _chosen(pages.where(size > chars).select(F.substring("html", 1, chars).alias("html")), sample)
    return fit(labelled(chosen))


def _chosen(pages: DataFrame, sample: int) -> list[str]:
    """The distinct pages of the lowest hashes.  First the hashes alone, so that no task sends pages in vain."""
    hashed = F.xxhash64("html")
    low = [r[0] for r in pages.select(hashed.alias("h")).distinct().orderBy("h").limit(sample).collect()]
    # A table of few pages: copies fold in each task before they are sent.
    found = pages.where(hashed.isin(low)).distinct().select(hashed.alias("h"), "html").collect() if low else []
    return [r["html"] for r in sorted(found, key=lambda r: (r["h"], r["html"]))][:sample]


def main_text(chain: Chain, page: str) -> tuple[str, int, int]:
    """The main text, how many blocks it has, how many the page has."""
    found = blocks(page)
    labels = chain.decode([features(b, i, len(found)) for i, b in enumerate(found)])
    kept = [b.text for b, k in zip(found, labels, strict=True) if k]
    return "\n".join(kept), len(kept), len(found)


def extract(pages: DataFrame, chain: Chain) -> DataFrame:
    """``_row`` (the columns of ``pages``), ``main``, ``n_main`` and ``n_blocks``."""
    fields = [T.StructField("main", T.StringType()), T.StructField("n_main", T.LongType()), T.StructField("n_blocks", T.LongType())]
    shared = pages.sparkSession.sparkContext.broadcast(chain)

    def fn(texts: pa.Array) -> dict:
        got = [main_text(shared.value, t) for t in texts.to_pylist()]
        return {f.name: [g[i] for g in got] for i, f in enumerate(fields)}

    return annotate(pages, fields, fn, text="html")


def report(pages: DataFrame, **how) -> DataFrame:
    return extract(pages.select("page_id", "url", "html"), train(pages, **how)).select(
        f"{ROW}.page_id", f"{ROW}.url", F.col("main").alias("text"), F.char_length("main").cast("long").alias("n_chars")
    )


