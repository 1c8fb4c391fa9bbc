"""Leaf blocks of a page: text with ancestors, as features for a sequence model."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|template|noscript|iframe|svg|textarea)\b[^>]*?"
    r"(?:/>|>.*?(?:</(?P=raw)\s*[^>]*>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img "
    "math mi mn mo mtext mrow msup msub mfrac msqrt semantics".split()
)
#: An opening tag ends an open element of these kinds first.
_ENDS = {
    "li": ("li", "p"),
    "dt": ("dt", "dd", "p"),
    "dd": ("dt", "dd", "p"),
    "tr": ("td", "th", "tr", "p"),
    "td": ("td", "th", "p"),
    "th": ("td", "th", "p"),
    "option": ("option",),
}
_WALLS = frozenset("ul ol dl table div section article aside nav body main".split())
#: Words in class, id and role attributes, by what they tell.
_KEYS = {
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion banner-ad adsense",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs",
    "foot": "footer foot copyright legal contentinfo colophon",
    "head": "header masthead topbar banner branding logo site-title",
    "side": "sidebar side aside widget related recommended complementary trending popular",
    "talk": "comment comments reply replies discussion respond disqus reader-comments feedback",
    "note": "cookie cookies consent notice alert gdpr modal popup overlay disclaimer paywall",
    "form": "form login signup subscribe newsletter search register",
    "share": "share social sharing tweet follow",
    "main": "article content main post entry story body text article-body post-content",
}
_KEY_OF = {word: key for key, words in _KEYS.items() for word in words.split()}
_MARKED = ("class", "id", "role")
_BLOCKY = frozenset(
    "article main nav header footer aside section form table ul ol figure body div blockquote "
    "p li h1 h2 h3 h4 h5 h6 td th dt dd pre button select option label fieldset dialog figcaption".split()
)


#: Elements that may stand in a head; any other opening tag ends it.
_IN_HEAD = frozenset("head title base link meta style script noscript template".split())
#: Attribute by which pages for training say what is main text; pages of others never have it read.
MARK = "data-crf-label"

_ASIDE = frozenset("nav footer aside form header button select dialog".split())


@dataclass
class Block:
    text: str
    tag: str
    ancestors: frozenset[str]
    keys: frozenset[str]
    linked: int
    label: int | None


class _Open:
    __slots__ = ("tag", "keys", "label")

    def __init__(self, tag: str, rest: str, marked: bool) -> None:
        self.tag = tag
        keys: set[str] = set()
        self.label = None
        if "=" in rest:
            for name, a, b, c in _ATTRIBUTE.findall(rest):
                name, value = name.lower(), a or b or c
                if name in _MARKED:
                    for word in value.lower().split():
                        if word in _KEY_OF:
                            keys.add(_KEY_OF[word])
                        for part in re.split(r"[-_]+", word):
                            if part in _KEY_OF:
                                keys.add(_KEY_OF[part])
                elif marked and name == MARK:
                    self.label = int(value)
        self.keys = keys


def leaf_blocks(page: str, marked: bool = False) -> list[Block]:
    """Text blocks in page order.  Scripts, styles, comments and the head have none.

    Inside a block character references are decoded and white space is one space.
    Broken markup never fails: unclosed elements end with their parents, and a head or title
    ends where an element opens that cannot stand in it.  The labels of ``MARK`` are read only if
    ``marked``.  Open tags and keys are counted, so depth costs nothing.
    """
    blocks: list[Block] = []
    stack: list[_Open] = []
    tags: Counter[str] = Counter()
    above: Counter[str] = Counter()
    buffer: list[str] = []
    linked = 0
    anchors = 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            if text and not tags["head"] and not tags["title"]:
                nearest = next((o.tag for o in reversed(stack) if o.tag not in _INLINE), "")
                around = frozenset(t for t, n in tags.items() if n and t in _BLOCKY)
                keys = frozenset(k for k, n in above.items() if n)
                label = None
                if marked:
                    label = next((o.label for o in reversed(stack) if o.label is not None), None)
                blocks.append(Block(text, nearest, around, keys, linked, label))
            buffer.clear()
        linked = 0

    def end(tag: str) -> None:
        nonlocal anchors
        while tags[tag]:
            o = stack.pop()
            tags[o.tag] -= 1
            above.subtract(o.keys)
            anchors -= o.tag == "a"
            if o.tag == tag:
                return

    last = 0
    for m in _PIECE.finditer(page):
        if m.start() > last:
            piece = page[last : m.start()]
            buffer.append(piece)
            if anchors:
                linked += len(piece)
        last = m.end()
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            buffer.append(" ")
            continue
        block = tag not in _INLINE
        if block:
            flush()
        if m.group("close"):
            end(tag)
            continue
        if tag in _VOID:
            continue
        if block and stack:
            for ended in _ENDS.get(tag, ("p",)):
                for o in reversed(stack):
                    if o.tag == ended:
                        end(ended)
                        break
                    if o.tag in _WALLS:
                        break
            if tag not in _IN_HEAD:
                end("head")
                end("title")
        if m.group("rest").endswith("/"):
            continue
        stack.append(_Open(tag, m.group("rest"), marked))
        tags[tag] += 1
        above.update(stack[-1].keys)
        anchors += tag == "a"
    if last < len(page):
        buffer.append(page[last:])
    flush()
    return blocks


def _bin(value: float, edges: tuple[float, ...]) -> int:
    return sum(value >= e for e in edges)


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that hold, for each block."""
    out = []
    n = len(blocks)
    for i, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        f = ["bias", f"tag={b.tag}", f"words={_bin(words, (3, 8, 20, 50))}"]
        f += [f"in={t}" for t in b.ancestors]
        f += [f"key={k}" for k in b.keys]
        f.append(f"links={_bin(b.linked / max(1, len(b.text)), (0.01, 0.3, 0.7))}")
        f.append(f"stop={b.text[-1] in '.!?:;\"”»…'}")
        f.append(f"commas={_bin(b.text.count(',') / words, (0.01, 0.05))}")
        inside = "article" in b.ancestors or "main" in b.ancestors or "main" in b.keys
        other = not _ASIDE.isdisjoint(b.ancestors) or bool(b.keys - {"main"})
        f.append(f"inside={inside},other={other}")
        if "©" in b.text:
            f.append("copyright")
        f.append(f"place={_bin(i / n, (0.05, 0.25, 0.75, 0.95))}")
        out.append(f)
    return out
