"""A small tolerant HTML reader: block elements and text blocks as a tree of flat arrays.

Only what text extraction needs: comments, scripts and the like are skipped, unclosed tags
are closed where HTML implies it, inline elements leave no node.  A text block is a maximal
run of inline content; it is a leaf under its block element.
"""

from __future__ import annotations

import html
import re

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img input object".split()) | frozenset(
    "math semantics annotation annotation-xml mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mtable mtr mtd mstyle mspace mpadded mphantom menclose merror mmultiscripts mprescripts".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of a page: up to their end tag or else the end of the page,
TO_END = ("script", "style", "textarea", "title", "iframe")
#: and up to their end tag only; without one, or an svg that ends in ``/>``, nothing but the tag is skipped.
RAW = ("noscript", "template", "svg", "select", "canvas", "audio", "video", "datalist")
#: Start tag -> open elements that it closes, up to the given scope.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<run>" + "|".join(TO_END) + r")(?=[\s/>])[^>]*>(?:.*?(?:</(?P=run)\s*>|\Z))"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?P<own>[^>]*)>"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attr>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attr2>[^>]*)>",
    re.S | re.I,
)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_RUN_END = re.compile(rf"</(?:{'|'.join(TO_END)})\s*>\Z", re.I)
_ATTR = re.compile(r"(class|id|role|style|hidden|aria-hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/>]|\Z)", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPLIT_CASE = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


class Page:
    """Parallel lists, one entry a node, in document order: a node's subtree follows it."""

    __slots__ = ("tag", "parent", "depth", "tokens", "hidden", "text", "link_chars")

    def __init__(self):
        self.tag, self.parent, self.depth, self.tokens, self.hidden, self.text, self.link_chars = ["#root"], [-1], [0], [()], [False], [None], [0]

    def add(self, tag, parent, tokens=(), hidden=False, text=None, link=0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.tokens.append(tokens)
        self.hidden.append(hidden)
        self.text.append(text)
        self.link_chars.append(link)
        return len(self.tag) - 1


def attributes(raw: str) -> tuple[tuple[str, ...], bool]:
    """(words of class, id, role and itemprop, is the element hidden)."""
    words, hidden = [], False
    for m in _ATTR.finditer(raw):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden |= value.lower() == "true"
        else:
            words += _WORDS.findall(_SPLIT_CASE.sub(" ", value).lower())
    return tuple(words), hidden


def parse(source: str) -> Page:
    page, stack = Page(), [("#root", 0)]
    places: dict[str, list[int]] = {}  # of each tag's open elements in the stack: no search ever walks it
    run: list[str] = []  # text of the block that is being read
    linked = 0
    in_link = False

    def flush():
        nonlocal linked
        if run:
            text = _SPACE.sub(" ", "".join(run)).strip(" ")
            if text:
                page.add("#text", stack[-1][1], text=text, link=min(linked, len(text)))
            run.clear()
        linked = 0

    def say(raw: str):
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        run.append(text)
        if in_link:
            linked += len(text)

    def close_to(depth: int):
        flush()
        for tag, _ in stack[depth:]:
            places[tag].pop()
        del stack[depth:]

    def top(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    at = 0
    last = source.rfind(">") + 1  # no tag ends behind; without this bound every unclosed one would be read to the end
    unclosed: set[str] = set()  # tags without an end tag in the rest of the page
    while m := _TOKEN.search(source, at, last):
        if m.start() > at:
            say(source[at : m.start()])
        at = m.end()
        if at == last and (m["run"] and not _RUN_END.search(m[0]) or m[0].startswith("<!--") and not m[0].endswith("-->")):
            at = len(source)  # never closed: the rest of the page belongs to it
            break
        if m["raw"]:
            raw = m["raw"].lower()
            if raw not in unclosed and not (raw == "svg" and m["own"].endswith("/")):
                if end := _RAW_END[raw].search(source, at):
                    at = end.end()
                else:
                    unclosed.add(raw)
            continue
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not (m["end"] or m["end2"])
            elif tag == "br":
                run.append(" ")
            continue
        if m["end"] or m["end2"]:
            if places.get(tag):
                close_to(places[tag][-1])
            else:
                flush()
            in_link = False
            continue
        flush()
        in_link = False
        if stack[-1][0] == "p" and tag not in VOID or tag == "hr" and stack[-1][0] == "p":
            close_to(len(stack) - 1)
        if tag in _CLOSES:
            these, scope = _CLOSES[tag]
            if (at_most := top(these)) > top(scope):
                close_to(at_most)
        if tag in VOID:
            continue
        raw = m["attr"] or m["attr2"] or ""
        tokens, hidden = attributes(raw) if raw else ((), False)
        node = page.add(tag, stack[-1][1], tokens, hidden)
        if not raw.endswith("/"):
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, node))
    if at < len(source):
        say(source[at:].partition("<!--")[0])
    flush()
    return page
