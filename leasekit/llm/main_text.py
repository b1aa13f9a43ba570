"""Operator 1: main text of web pages by tag-path ratios.

A page is read as a sequence of blocks (text between block-level tags), each with its root-to-leaf path of block-level
tags and first class names. For every path, text length, punctuation and linked text are summed over its nodes; a path's
text ratio and punctuation ratio are these sums per node. Both are smoothed over the page's blocks in order (neighbours
weigh less with distance), averaged back per path, scaled, and fused as text x punctuation x unlinked share. Paths whose
fused score reaches ``THRESHOLD`` times the standard deviation of all paths' scores are content paths. The content node is
the deepest element that holds nearly all the score of content blocks. The article is all of the outermost ``article`` around
it, and what is in ``main`` besides; without those, what is around it up to the body. Blocks outside the content node or
``article`` are left out only if their path is mostly links, and, without ``main``, if they lie in a ``div`` at the top of the
page with neither a content path nor a sentence's punctuation.

Elements that are never article text are left out first: scripts, styles, buttons, navigation and the like by their tag
or role, and menus, sidebars, notices, adverts or reader comments by the words of their class or id (of elements that hold
others; a paragraph or heading is not left out for its class). A form is left out if it has under ``FORM_TEXT`` characters of
text for each control to fill in; a page that lies in one form as a whole stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds of elements: fixed values (HTML).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math object select audio video canvas".split())
BLOCK = frozenset(
    "html head body main article section nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol menu li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption address details summary form fieldset legend center dialog hgroup search hr".split()
)
#: Starting one of these ends an open element of the second set, up to the nearest of the third.
ENDS = {
    **dict.fromkeys(BLOCK - {"li", "dt", "dd", "tr", "td", "th", "html", "head", "body", "thead", "tbody", "tfoot"}, (frozenset({"p"}), frozenset({"td", "th", "li", "div", "article"}))),
    "li": (frozenset({"li", "p"}), frozenset({"ul", "ol", "menu"})),
    **dict.fromkeys(("dt", "dd"), (frozenset({"dt", "dd", "p"}), frozenset({"dl"}))),
    **dict.fromkeys(("td", "th"), (frozenset({"td", "th", "p"}), frozenset({"tr", "table"}))),
    "tr": (frozenset({"tr", "td", "th", "p"}), frozenset({"table", "tbody", "thead", "tfoot"})),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "p"}), frozenset({"table"}))),
    "body": (frozenset({"head"}), frozenset()),
}
#: Elements that may be the content node; elements, roles, and words of class names or ids that mark what is not article text.
CONTAINERS = frozenset("body main article section div center td".split())
#: What a container's number says of it, in its last two bits: its own text counts like the page's (section, td), main, article.
KINDS = {"section": 1, "td": 1, "main": 2, "article": 3}
BOILERPLATE = frozenset("head nav aside footer menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer foot sidebar aside ad ads adv advert adverts advertisement advertisements advertising banner sponsor sponsored "
    "promo promotion cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe subscription signup signin login register share "
    "sharing social related recommended recommendations pagination pager toolbar widget widgets comment comments reply replies respond disqus copyright legal skip masthead topbar".split()
)
#: Elements whose class and id words say nothing; what is pressed or names a control; what is filled in.
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th blockquote pre figure figcaption caption address".split())
CAPTIONS = frozenset(("button", "label"))
CONTROLS = frozenset("input select textarea".split())
FORM_TEXT = 200
COMMENTS = frozenset("comment comments reply replies respond disqus".split())
HEADER = frozenset(("header", "masthead", "head"))

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)(>|\Z)""", re.S)
#: A quote that follows = and is never closed in the page opens no value: the tag ends at the next >.
_NAMES = re.compile(r"""([^\s=>/]+)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]+)))?""")
_MARKING = re.compile(r"class|id|role", re.I)
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")
#: Of the paths' standard deviation; weights of a block, its neighbours and theirs; share of score in the content node.
THRESHOLD, KERNEL, SHARE = 0.2, (1.0, 0.6, 0.2), 0.95


def _marked(tag: str, attributes: str) -> tuple[bool, bool, str]:
    """Is the element boilerplate by itself; is it a header; its label in paths."""
    label = tag
    bad, header = tag in BOILERPLATE, tag == "header"
    if attributes and "=" in attributes and _MARKING.search(attributes):
        for m in _NAMES.finditer(attributes):
            kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if kind not in ("class", "id", "role"):
                continue
            if kind == "role":
                bad |= value.lower() in ROLES
                continue
            for k, name in enumerate(value.split()):
                pieces = [p.lower() for p in _PIECES.findall(name)]
                if not pieces:
                    continue
                if k == 0 and kind == "class":
                    label = f"{tag}.{pieces[0]}"
                negated = len(pieces) > 1 and pieces[0] in ("no", "has", "with", "without", "is")
                ends = set() if negated else {pieces[0], pieces[-1]}
                header |= bool(ends & HEADER)
                bad |= tag not in PLAIN and bool(ends & (COMMENTS if tag == "article" else WORDS - HEADER))
    if tag in ("html", "body", "main"):
        bad = header = False
    return bad, header, label


def blocks(html: str) -> list[tuple[str, tuple[int, ...], int, int]]:
    """(text, open containers by number, path number, linked characters) of all blocks outside boilerplate, in page order.
    The page's body (or what stands for it) is container 0; the others are numbered in page order, four apart, plus ``KINDS``."""
    out: list[tuple[str, tuple[int, ...], int, int]] = []
    paths: dict[tuple[int, str], int] = {}
    stack: list[tuple[str, int, int, bool]] = []  # tag, container (0: none), path, inside boilerplate
    elements = 1
    text: list[str] = []
    links, linked = 0, 0
    forms: list[list[int]] = []  # characters and controls of each form
    form, form_of = -1, []  # the open form, and that of each block

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(unescape("".join(text)).split())
            text.clear()
            if joined and form >= 0:
                forms[form][0] += len(joined) - min(linked, len(joined))
            if joined and not (stack and stack[-1][3]):
                form_of.append(form)
                out.append((joined, (0, *(s[1] for s in stack if s[1])), stack[-1][2] if stack else -1, linked))
        linked = 0

    at, end = 0, len(html)
    while at < end:
        m = _TAG.search(html, at)
        if m is None or m.start() > at:
            piece = html[at:m.start() if m else end]
            text.append(piece)
            if links:
                linked += len(piece)
        if m is None:
            break
        at = m.end()
        if m[2] is None or not m[4]:  # comments and the like; a tag cut off by the page's end
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if form >= 0 and not closing and tag in CONTROLS and "hidden" not in m[3].lower():
            forms[form][1] += 1
        if tag in CAPTIONS and not closing:
            if close := re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at):
                at = close.end()
            text.append(" ")
            continue
        if tag in RAW:
            if not closing and not m[3].endswith("/"):
                close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
                at = close.end() if close else end
            text.append(" ")
            continue
        if tag == "br":
            text.append(" ")
        if tag == "a":
            links = 0 if closing else 1
        if tag not in BLOCK:
            continue
        flush()
        if tag == "form":
            if not closing and form < 0:
                forms.append([0, 0])
                form = len(forms) - 1
            elif closing:
                form = -1
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in ENDS:
            closes, walls = ENDS[tag]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in walls:
                    break
                if stack[k][0] in closes:
                    del stack[k:]
                    if tag not in ("tr", "td", "th", "thead", "tbody", "tfoot", "li", "dt", "dd"):
                        break
        if tag == "hr":
            continue
        bad, header, label = _marked(tag, m[3])
        inside = {s[0] for s in stack} & {"article", "main"} if header else ()
        bad |= header and not inside
        parent = stack[-1] if stack else ("", -1, -1, False)
        path = paths.setdefault((parent[2], label), len(paths))
        container = tag in CONTAINERS and tag != "body"
        stack.append((tag, 4 * elements + KINDS.get(tag, 0) if container else 0, path, parent[3] or bad))
        elements += container
        links = 0
    flush()
    return [b for b, f in zip(out, form_of) if f < 0 or forms[f][0] >= FORM_TEXT * max(forms[f][1], 1)]


def content(found: list[tuple[str, tuple[int, ...], int, int]]) -> list[str]:
    """Texts of the blocks that make the article."""
    if len(found) < 2:
        return [b[0] for b in found]
    length = np.array([len(b[0]) for b in found], float)
    marks = np.array([len(_PUNCTUATION.findall(b[0])) for b in found], float)
    linked = np.array([min(b[3], len(b[0])) for b in found], float)
    _, path = np.unique([b[2] for b in found], return_inverse=True)
    nodes = np.bincount(path)
    per = lambda x: np.bincount(path, x) / nodes

    def smooth(x: np.ndarray) -> np.ndarray:
        kernel = np.array([*KERNEL[:0:-1], *KERNEL])
        return np.convolve(x, kernel, "same")[:len(x)] if len(x) >= len(kernel) else x

    text = per(smooth(per(length)[path]))
    point = per(smooth((per(marks) + 0.1)[path]))
    unlinked = 1 - np.bincount(path, linked) / np.bincount(path, length)
    fused = np.sqrt(text / text.max() * point / point.max()) * unlinked
    chosen = fused >= min(THRESHOLD * fused.std(), fused.max())
    weight = np.where(chosen[path], length * fused[path], 0.0)
    inside: dict[int, float] = {}
    for (_, containers, _, _), w in zip(found, weight):
        for c in containers:
            inside[c] = inside.get(c, 0.0) + w
    node = max(c for c, w in inside.items() if w >= SHARE * weight.sum())  # numbered in page order: the deepest
    around = next(b[1] for b in found if node in b[1])
    around = around[:around.index(node) + 1]
    core = next((c for c in around if c & 3 == 3), node)
    # The article without main stands alone; else climb to main, or the body.
    top = next((c for c in around if c & 3 == 2), core if core & 3 == 3 else 0)
    # Elements at the top of the page that have a block on a content path, or with a sentence's punctuation.
    worth = {b[1][1] for k, b in enumerate(found) if len(b[1]) > 1 and (chosen[path[k]] or marks[k])}

    def belongs(k: int) -> bool:
        inside = found[k][1]
        if core and core in inside:
            return True
        if top not in inside or unlinked[path[k]] < 0.5:
            return False
        apart = top == 0 and len(inside) > 1 and inside[1] & 3 == 0 and inside[1] not in around
        return not apart or inside[1] in worth

    return [b[0] for k, b in enumerate(found) if belongs(k)]


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in page order, joined by one space; empty if there is none."""
    return " ".join(content(blocks(html))) if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` (code points) of every row of ``pages``.

    Null or empty html: empty text. Rows stay one to one (repeated rows, null ids and urls too); an empty table gives an
    empty result; further columns are not read. No shuffle.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    found = pages.select("page_id", "url", "html").mapInArrow(read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
