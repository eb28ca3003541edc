"""Main text of web pages by boosted trees over DOM nodes and hierarchical decoding.

Every block element and every text block is a node with features of its subtree (text, link
and punctuation density), of what its attribute words stand for, of its depth, its siblings
and ancestors, and of its place beside the page's heading.  Boosted trees give each node the
log-odds of holding main text.  Decoding picks the set of nodes of greatest total log-odds in
which every chosen node's parent is chosen: an element ruled out takes its whole subtree with
it, and a text cannot be kept inside it.

What an attribute word stands for is learned: hashed words, and hashed beginnings of words for
those not seen, each have a weight, their log-odds of main text over training pages.  The trees
are trained on other pages, in many of which the words say nothing, so that they go by
structure where words are unknown.  The pages are composed by this module (``compose``): no
labelled pages exist.  The training set has a fixed size; extraction is one pass over the pages
where they are read.
"""

from __future__ import annotations

import random
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import boosting
from .arrowio import bounded_batches, pieces
from .dom import Page, parse

_GROUPS = (
    ("article",), ("main",), ("section",), ("div",), ("p",), ("h1",), ("h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "dl", "menu"), ("li", "dt", "dd"),
    ("nav",), ("header",), ("footer",), ("aside",), ("form", "fieldset", "button", "label", "legend"), ("table", "tbody", "thead", "tr"), ("td", "th"),
    ("blockquote", "pre", "figure", "figcaption", "address", "details", "summary"), ("#text",), ("body", "html", "#root"),
)
_GROUP = {t: i for i, g in enumerate(_GROUPS) for t in g}
_OFF_TAGS = frozenset(("nav", "footer", "aside", "form", "fieldset", "button", "label", "header"))
_KEEP_TAGS = frozenset(("article", "main"))
HASHES = 1 << 13
_STEM = 4


@dataclass(frozen=True)
class Words:
    """Learned weight of each hashed attribute word; 0 where nothing was learned."""

    weight: np.ndarray

    @staticmethod
    def slots(word: str) -> tuple[int, int]:
        """Of the word and of its beginning."""
        return zlib.crc32(word.encode()) % HASHES, zlib.crc32(b"~" + word[:_STEM].encode()) % HASHES

    def of(self, tokens: tuple[str, ...]) -> tuple[float, float]:
        """(sum of the weights above, below zero) of an element's words, of an unknown word by its beginning."""
        plus = minus = 0.0
        for w in tokens:
            a, b = self.slots(w)
            v = float(self.weight[a] or self.weight[b])
            plus, minus = plus + max(v, 0.0), minus + min(v, 0.0)
        return plus, minus

    @staticmethod
    def learn(pages: list[Page], good: np.ndarray, least: int = 4) -> "Words":
        """From the nodes of the pages, one after the other, and whether each holds main text."""
        seen = np.zeros((HASHES, 2))
        at = 0
        for p in pages:
            for tokens in p.tokens:
                for w in set(tokens):
                    for slot in set(Words.slots(w)):
                        seen[slot, int(good[at])] += 1
                at += 1
        share = seen.sum(0) / max(seen.sum(), 1)
        odds = np.log((seen[:, 1] + share[1]) / (seen[:, 0] + share[0]) * (share[0] / max(share[1], 1e-9)))
        return Words(np.where(seen.sum(1) >= least, odds, 0.0))


@dataclass(frozen=True)
class Model:
    words: Words
    trees: boosting.Boosted


def features(pages: list[Page], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(features, parent) of all nodes of the pages, one after the other; roots have parent -1."""
    first = np.cumsum([0, *(len(p.tag) for p in pages)])
    n = int(first[-1])
    page_of = np.repeat(np.arange(len(pages)), np.diff(first))
    cat = lambda name: [v for p in pages for v in getattr(p, name)]
    tag, tokens, text = cat("tag"), cat("tokens"), cat("text")
    depth = np.array(cat("depth"))
    parent = np.concatenate([np.where(np.array(p.parent) < 0, -1, np.array(p.parent) + f) for p, f in zip(pages, first)]) if n else np.zeros(0, np.int64)
    group = np.array([_GROUP.get(t, 3) for t in tag])
    memo: dict = {(): (0.0, 0.0)}
    for t in set(tokens):
        memo[t] = words.of(t)
    plus, minus = np.array([memo[t] for t in tokens]).reshape(n, 2).T
    named = np.array([len(t) > 0 for t in tokens], float)
    hidden = np.array(cat("hidden"), float)
    off = np.array([t in _OFF_TAGS for t in tag], float)
    keep = np.array([t in _KEEP_TAGS for t in tag], float)
    chars = np.array([len(t) if t else 0 for t in text], float)
    links = np.array(cat("link_chars"), float)
    stops = np.array([sum(t.count(c) for c in ".,;:!?") if t else 0 for t in text], float)
    count = np.array([t.count(" ") + 1 if t else 0 for t in text], float)
    leaf = (group == _GROUP["#text"]).astype(float)
    para, h1 = (group == _GROUP["p"]).astype(float), (group == _GROUP["h1"]).astype(float)
    own = np.stack([chars, links, stops, count, leaf, np.ones(n), off, para, h1], axis=1)
    # a subtree is the stretch of nodes behind its root: sums over subtrees and ancestors are differences of running sums
    size, longest = _subtrees(parent, chars)
    end = np.arange(n) + size
    run = np.concatenate([np.zeros((1, own.shape[1])), np.cumsum(own, axis=0)])
    sub = run[end] - run[:n]
    mark = np.stack([minus < -0.5, off > 0, keep > 0, plus > 0.5, hidden > 0, named > 0], axis=1).astype(float)
    left = np.zeros((n + 1, mark.shape[1]))
    np.add.at(left, end, mark)
    above = np.cumsum(mark, axis=0) - mark - np.cumsum(left, axis=0)[:n]  # of the ancestors: against, off tags, keep tags, for, hidden, with words
    worst, best = _from_above(parent, np.minimum(minus, 0), min), _from_above(parent, np.maximum(plus, 0), max)
    up = np.maximum(parent, 0)
    kids = np.bincount(up[parent >= 0], minlength=n).astype(float)
    nth = np.zeros(n)
    seen = np.argsort(up, kind="stable")
    starts = np.searchsorted(up[seen], up[seen], side="left")
    nth[seen] = np.arange(n) - starts
    # siblings of the same tag and words, and the children that are paragraphs or the heading
    look = {x: i for i, x in enumerate(dict.fromkeys(zip(tag, tokens)))}
    kind = up * np.int64(max(len(look), 1)) + np.array([look[x] for x in zip(tag, tokens)], np.int64) if n else np.zeros(0, np.int64)
    _, which, times = np.unique(kind, return_inverse=True, return_counts=True)
    alike = times[which].astype(float)
    beside = np.zeros((n, 2))
    np.add.at(beside, up[parent >= 0], np.stack([para, h1], axis=1)[parent >= 0])
    # where the page's first heading is, in nodes
    where = np.full(len(pages), np.inf)
    at = np.flatnonzero(h1)
    np.minimum.at(where, page_of[at], at.astype(float))
    has = np.isfinite(where[page_of]) if n else np.zeros(0, bool)
    behind = np.where(has, np.sign(np.arange(n) - np.where(has, where[page_of], 0)), 0.0) if n else np.zeros(0)
    whole = sub[first[:-1]][page_of] if n else sub
    up_sub, top = sub[up], (longest[first[:-1]][page_of] if n else longest)
    total, blocks = np.maximum(sub[:, 0], 1), np.maximum(sub[:, 4], 1)
    x = np.stack(
        [
            group, group[up], group[up[up]], plus, minus, named, hidden, *above.T, worst, best,
            plus[up], minus[up], depth, np.log1p(sub[:, 0]), sub[:, 1] / total, sub[:, 2] / np.maximum(sub[:, 3], 1), sub[:, 0] / blocks, np.log1p(sub[:, 4]),
            sub[:, 0] / np.maximum(whole[:, 0], 1), sub[:, 0] / np.maximum(up_sub[:, 0], 1), up_sub[:, 1] / np.maximum(up_sub[:, 0], 1), np.log1p(up_sub[:, 0]), np.log1p(kids[up]),
            nth / np.maximum(kids[up], 1), np.log1p(nth), np.log1p(kids), sub[:, 3] / blocks, sub[:, 0] / np.maximum(sub[:, 5], 1), leaf, off, keep,
            up_sub[:, 0] / np.maximum(up_sub[:, 4], 1), np.log1p(whole[:, 4]),
            np.log1p(alike), alike / np.maximum(kids[up], 1), sub[:, 6], sub[:, 7] / blocks, sub[:, 8], up_sub[:, 8], beside[up, 0], beside[up, 1], beside[up[up], 1],
            behind, np.log1p(longest), longest / np.maximum(top, 1),
        ],
        axis=1,
    )
    return x, parent


def _subtrees(parent: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of nodes, and greatest value, of each node's subtree; children follow their parents."""
    size, most = [1] * len(parent), values.tolist()
    up = parent.tolist()
    for i in range(len(up) - 1, -1, -1):
        if (p := up[i]) >= 0:
            size[p] += size[i]
            if most[i] > most[p]:
                most[p] = most[i]
    return np.array(size, np.int64), np.array(most)


def _from_above(parent: np.ndarray, values: np.ndarray, of) -> np.ndarray:
    """``of`` a node's value and those of all its ancestors."""
    out = values.tolist()
    for i, p in enumerate(parent.tolist()):
        if p >= 0:
            out[i] = of(out[i], out[p])
    return np.array(out)


def decode(logit: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The best set of nodes that holds every chosen node's parent; roots are always in."""
    gain, up = logit.tolist(), parent.tolist()
    for i in range(len(up) - 1, -1, -1):
        if up[i] >= 0 and gain[i] > 0:
            gain[up[i]] += gain[i]
    on = [False] * len(up)
    for i, p in enumerate(up):
        on[i] = p < 0 or on[p] and gain[i] > 0
    return np.array(on, bool)


def extract_pages(sources: list[str], model: Model) -> list[str]:
    pages = [parse(s) for s in sources]
    x, parent = features(pages, model.words)
    on, out, at = decode(model.trees.logit(x), parent), [], 0
    for p in pages:
        out.append("\n".join(t for t, keep in zip(p.text, on[at : at + len(p.tag)]) if t is not None and keep))
        at += len(p.tag)
    return out


# ---------------------------------------------------------------- training pages

#: A main text carries this mark in the composed pages, to label its nodes.
_MARK = "\u2060"

#: Names that parts of composed pages carry.
NAMES = {
    "wrap": "wrap wrapper page container row inner layout grid site",
    "core": "content post-body article-text entry-content main story post entry article prose markdown body-copy inhalt beitrag contenu texte contenido cuerpo",
    "menu": "menu nav navbar main-menu breadcrumb navigation topnav breadcrumbs navegacion hauptmenu",
    "ad": "ad ads ad-slot banner promo sponsored advert advertisement sponsor dfp-ad publicite werbung anuncio publicidad anzeige",
    "side": "sidebar related widget related-posts trending share-social recommended popular most-read seitenleiste barra-lateral voir-aussi mehr",
    "notice": "cookie-notice notice consent alert newsletter popup gdpr modal overlay hinweis avis aviso bandeau",
    "form": "search login subscribe signup contact-form suche recherche buscar anmeldung",
    "comments": "comments comment-list discussion disqus responses replies kommentare commentaires reacciones forum-thread",
    "comment": "comment reply response comment-item kommentar commentaire respuesta",
    "share": "share social toolbar pagination tags pager meta-links teilen partager compartir seiten",
    "legal": "legal copyright promo disclaimer terms impressum mentions-legales derechos",
    "head": "masthead header topbar site-head kopfzeile entete cabecera",
    "foot": "footer copyright site-foot colophon fusszeile pied-de-page pie",
}


def compose(rng: random.Random, names: dict[str, str] = NAMES, opaque: float = 0.0) -> str:
    """One page of a random layout; words of its main text begin with a mark.

    In a share ``opaque`` of the pages names are replaced by letters that mean nothing, each
    name by its own.
    """
    vowels, rest = "aeiou", "bcdfghjklmnprstvwz"
    syllables = lambda low, high: "".join(rng.choice(rest) + rng.choice(vowels) for _ in range(rng.randint(low, high)))
    lexicon = [syllables(1, 4) for _ in range(120)]
    comma, ends = rng.choice((0, 0.04, 0.08, 0.2)), rng.choice(("...", "....!?", "...,", " "))
    hide = rng.random() < opaque
    renamed: dict = {}

    def attr(kind, p=0.9):
        if rng.random() > p:
            return "" if rng.random() < 0.6 else f' class="{syllables(1, 2)}"'
        name = rng.choice(names[kind].split())
        if hide:
            name = renamed.setdefault(name, syllables(1, 2) if rng.random() < 0.5 else rng.choice(rest) + str(rng.randint(1, 99)))
        return f' {rng.choice(("class", "class", "id"))}="{name}"'

    def words(n):
        return [rng.choice(lexicon) for _ in range(n)]

    def sentence(n=None):
        w = words(n or rng.choice((1, 2, 4, 7, 12, 20)))
        w = [x + ("," if rng.random() < comma else "") for x in w]
        return " ".join(w).capitalize() + rng.choice(ends).strip()

    def text(n):
        return " ".join(sentence() for _ in range(n))

    def marked(s):
        return " ".join(_MARK + w for w in s.split(" "))

    def links(n):
        return "".join(f'<li><a href="/x">{" ".join(words(rng.choice((1, 1, 2, 3))))}</a></li>' for _ in range(n))

    def menu():
        inner = f"<ul>{links(rng.randint(2, 9))}</ul>"
        return f"<nav>{inner}</nav>" if rng.random() < 0.6 else f"<div{attr('menu')}>{inner}</div>"

    def thread():
        tag, own = rng.choice((("div", attr("comment")), ("article", attr("comment")), ("li", attr("comment"))))
        by = rng.choice(("<b>{}</b>", "<cite>{}</cite>", "<h4>{}</h4>", "<div>{}</div>", "<a href='#'>{}</a>"))
        say = lambda: rng.choice(("<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "{}")).format(text(rng.randint(1, 5)))
        more = "<a href='#'>" + sentence(1) + "</a>" if rng.random() < 0.4 else ""
        items = "".join(f"<{tag}{own}>{by.format(' '.join(words(rng.randint(1, 3))))}{say()}{more}</{tag}>" for _ in range(rng.randint(1, 7)))
        outer = "ol" if tag == "li" else rng.choice(("section", "div"))
        title = f"<h3>{rng.randint(1, 99)} {sentence(1)}</h3>" if rng.random() < 0.7 else ""
        return f"<section>{title}<ol{attr('comments')}>{items}</ol></section>" if outer == "ol" else f"<{outer}{attr('comments')}>{title}{items}</{outer}>"

    def junk():
        kind = rng.randrange(9)
        if kind <= 1:
            inner = text(rng.randint(1, 3))
            inner = rng.choice((inner, f"<p>{inner}</p>", f"<a href='#'>{inner}</a>", f"<h4>{sentence(2)}</h4><p>{inner}</p><a href='#'>{sentence(2)}</a>"))
            return f"<div{attr('ad', 0.97)}>{inner}</div>"
        if kind == 2:
            return f"<aside{attr('side')}><h3>{sentence(3)}</h3><ul>{links(rng.randint(2, 6))}</ul>{'<p>' + text(2) + '</p>' if rng.random() < 0.5 else ''}</aside>"
        if kind == 3:
            return f"<div{attr('notice', 0.97)}><p>{text(rng.randint(1, 2))}</p>" + (f"<button>{sentence(1)}</button>" if rng.random() < 0.8 else "") + "</div>"
        if kind == 4:
            return f"<form{attr('form')}><label>{sentence(2)}</label><input><p>{sentence()}</p><button>{sentence(1)}</button></form>"
        if kind == 5:
            return f"<div{attr('side', 0.97)}><h4>{sentence(2)}</h4>" + "".join(f"<p>{text(1)} <a href='#'>{sentence(3)}</a></p>" for _ in range(rng.randint(1, 4))) + "</div>"
        if kind == 6:
            return thread()
        if kind == 7:
            return f"<div{attr('share', 0.95)}>" + "".join(f"<a href='#'>{sentence(1)}</a> " for _ in range(rng.randint(2, 6))) + "</div>"
        return f"<div{attr('legal', 0.97)}>{sentence()}</div>"

    def paragraph():
        body = marked(text(rng.choice((1, 1, 2, 3, 6, 12))))
        if rng.random() < 0.2:
            body = f"<b>{body}<br>"
        elif rng.random() < 0.15:
            body += f" <a href='#'>{marked(sentence(3))}</a> {marked(sentence())}"
        return f"<p>{body}" + ("</p>" if rng.random() < 0.85 else "")

    def block():
        r = rng.random()
        if r < 0.76:
            return paragraph()
        if r < 0.84:
            return f"<h2>{marked(sentence(rng.randint(1, 5)))}</h2>"
        if r < 0.91:
            return "<ul>" + "".join(f"<li>{marked(sentence())}</li>" for _ in range(rng.randint(2, 6))) + "</ul>"
        if r < 0.95:
            return f"<blockquote><p>{marked(text(2))}</p></blockquote>"
        if r < 0.98:
            return "<table>" + "".join(f"<tr><td>{marked(sentence(2))}</td><td>{marked(sentence(2))}</td></tr>" for _ in range(3)) + "</table>"
        return f"<div>{marked(text(2))}</div>"

    body = [f"<h1>{marked(sentence())}</h1>"] if rng.random() < 0.94 else []
    for _ in range(rng.choice((1, 1, 2, 4, 8, 14))):
        body.append(block())
        if rng.random() < 0.06:
            body.append(junk())
    if rng.random() < 0.2:  # in sections, which begin with a heading
        tag, cut = rng.choice(("section", "section", "div")), sorted(rng.sample(range(1, len(body)), min(len(body) - 1, rng.randint(1, 3)))) if len(body) > 1 else []
        parts = [body[a:b] for a, b in zip([0, *cut], [*cut, len(body)])]
        body = [f"<{tag}>" + (f"<h2>{marked(sentence(rng.randint(1, 5)))}</h2>" if i else "") + "".join(p) + f"</{tag}>" for i, p in enumerate(parts)]
    inside = "".join(body)
    if rng.random() < 0.2:
        inside += junk()
    wrap = rng.random()
    if wrap < 0.45:
        core = f"<article{attr('core', 0.3)}>{inside}</article>"
    elif wrap < 0.6:
        core = f"<main{attr('core', 0.2)}>{inside}</main>"
    elif wrap < 0.95:
        core = f"<div{attr('core', 0.95)}>{inside}</div>"
    else:
        core = inside
    for _ in range(rng.choice((0, 0, 1, 2))):
        core = f"<{(t := rng.choice(('div', 'div', 'main', 'section')))}{attr('wrap')}>{core}{junk() if rng.random() < 0.4 else ''}</{t}>"
    parts = []
    if rng.random() < 0.4:
        parts.append(f"<header{attr('head')}><a href='/'>{sentence(2)}</a><p>{sentence(4)}</p>{menu() if rng.random() < 0.5 else ''}</header>")
    elif rng.random() < 0.3:
        parts.append(f"<div{attr('head')}><a href='/'>{sentence(2)}</a><p>{sentence(4)}</p></div>")
    if rng.random() < 0.8:
        parts.append(menu())
    parts += [junk() for _ in range(rng.choice((0, 1, 1, 2, 3)))]
    parts.append(core)
    if rng.random() < 0.3:
        parts.append(thread())
    parts += [junk() for _ in range(rng.choice((0, 0, 1, 2)))]
    if rng.random() < 0.7:
        parts.append(f"<footer>&copy; {sentence(rng.randint(1, 12))}{menu() if rng.random() < 0.2 else ''}</footer>")
    elif rng.random() < 0.7:
        parts.append(f"<div{attr('foot', 0.97)}><p>&copy; {sentence()}</p>{menu() if rng.random() < 0.3 else ''}</div>")
    return "<!DOCTYPE html><html><head><title>t</title></head><body>" + "".join(parts) + "</body></html>"


def _labelled(sources: list[str]) -> tuple[list[Page], np.ndarray]:
    """Pages, and of each of their nodes whether it holds main text."""
    pages = [parse(s) for s in sources]
    good = np.array([t is not None and _MARK in t for p in pages for t in p.text], float)
    at = 0
    for p in pages:
        p.text = [t.replace(_MARK, "") if t else t for t in p.text]  # features must not see the mark
        for i in range(len(p.tag) - 1, 0, -1):
            good[at + p.parent[i]] = max(good[at + p.parent[i]], good[at + i])
        at += len(p.tag)
    return pages, good


@lru_cache(maxsize=4)
def train(pages: int = 1500, seed: int = 11) -> Model:
    """Word weights from a third of the composed pages, trees from the others; kept for the process."""
    rng = random.Random(seed)
    words = Words.learn(*_labelled([compose(rng) for _ in range(pages // 3)]))
    rest, good = _labelled([compose(rng, opaque=0.45) for _ in range(pages - pages // 3)])
    return Model(words, boosting.fit(features(rest, words)[0], good, trees=60, depth=5))


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """Main text of every row of ``pages(page_id, url, html, ...)``.

    Returns page_id, url, text, n_chars.  Null or empty html, and a page without main text,
    give an empty text.  Blocks are joined by a line feed in page order; character references
    are decoded and white space inside a block is one space.  Broken markup is read as far as
    HTML implies, in time that grows with the page's length and no faster; repeated rows give
    a row each; an empty table gives an empty result; other columns are ignored.
    """
    rows = pages.select("page_id", "url", "html")
    shared = pages.sparkSession.sparkContext.broadcast(model or train())

    def run(batches):
        m = shared.value
        for batch in batches:
            for b in pieces(batch, 2, 1 << 20):
                got = extract_pages([h or "" for h in b.column(2).to_pylist()], m)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.string()), pa.array([len(t) for t in got], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = dict(rows.dtypes)
    return bounded_batches(rows).mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op1_html_boosted(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    return extract(table(spark, sf_dir, "pages"))
