"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host."""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter, OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import pick, settle

RESULT = "page_id long, url string, text string, n_chars long"

# --- a page as nested containers and text blocks ----------------------------------------------

# The inside of a tag. It stops at a `<` outside quotes, where a tag without `>` ends too, so that every page is read in one linear scan.
_INNER = r"(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^<>]*(?:>|(?=<)|\Z)|<svg\b(?:\"[^\"]*\"|'[^']*'|[^'\"<>/]|/(?!>))*+/>"
    rf"|<(?P<raw>script|style|textarea|noscript|template|iframe|svg|title|select)\b{_INNER}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|</?(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>{_INNER})(?:>|(?=<)|\Z)"
    r"|</?(?P<torn>[a-zA-Z][a-zA-Z0-9:-]*+)[^<>]*>?|[^<]+|<",  # a quote that is never closed
    re.DOTALL | re.IGNORECASE,
)
_ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Containers that stand in the wrapper; other elements are running text and only part blocks.
_CONTAINERS = frozenset("html head body div section article main nav aside header footer form fieldset dialog button menu td center".split())

# Other blocks are containers only if their class, id or role say that they are no part of the article.
_BLOCKS = frozenset("ul ol dl table blockquote figure p li dd tr h1 h2 h3 h4 h5 h6 pre address".split())
_IMPLIED = {"p": None, "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]), "tr": frozenset(["tr"])}  # what starts behind ends them; None: any block

# Words in class and id that name what is no article, and words that say the element holds it after all.
_AROUND = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement banner promo sponsor sponsored "
    "cookie cookies consent gdpr notice alert popup modal overlay subscribe newsletter comment comments respond reply replies discussion "
    "disqus share sharing social related recommended breadcrumb breadcrumbs pagination pager widget form search login signup toolbar "
    "copyright legal disclaimer skip".split()
)
_INSIDE = frozenset("content article main post entry story text body".split())
_BESIDE = frozenset("with without has no".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_NEVER = frozenset("head nav aside footer form fieldset dialog button menu".split())
_HEAD_ONLY = frozenset("meta link base".split())  # beside elements without text blocks; any other ends the head
_ARTICLES = frozenset("article main section".split())


class Box:
    """A container or text block of a page: its signature, whether it or one outside it stands around the article, what is inside in page order.

    The signature of a text block starts with `#` and names the element that
    it stands in; `text` is what it says and `linked` how much of it is links.
    """

    __slots__ = ("sig", "tag", "around", "hidden", "in_article", "parent", "children", "text", "linked")

    def __init__(self, sig: str, tag: str, around: bool, parent: Box | None = None):
        self.sig, self.tag, self.around, self.parent = sig, tag, around, parent
        self.hidden = around or (parent is not None and parent.hidden)
        self.in_article = tag in ("article", "main") or (parent is not None and parent.in_article)
        self.children: list[Box] = []
        self.text = ""
        self.linked = 0


def _says_around(named: str) -> bool:
    """Whether a class or id names what is no article.

    Of compound names the last word tells: `post-comments`, `header-content`;
    what comes behind `with` or `has` is only beside it: `text-with-sidebar`.
    """
    for name in named.split():
        words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
        words = words[: next((i for i, w in enumerate(words) if w in _BESIDE), len(words))]
        if words and (words[-1] in _AROUND or (words[-1] not in _INSIDE and _AROUND.intersection(words))):
            return True
    return False


def _box(tag: str, attrs: str, parent: Box) -> Box:
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTR.finditer(attrs)}
    named = f"{found.get('class', '')} {found.get('id', '')}"
    role = found.get("role", "")
    names = sorted({re.sub(r"\w*\d\w*", "N", w) for w in re.split(r"[^a-z0-9]+", named) if w})
    around = tag in _NEVER or role in _ROLES or (tag == "header" and not parent.in_article)
    if tag not in ("html", "body", "main"):
        around = around or _says_around(named)
    if role == "main" or found.get("itemprop") == "articlebody":
        tag = "main"
    return Box(".".join([tag, *names]), tag, around, parent)


def parse(page: str) -> tuple[Box, list[tuple[Box, str]]]:
    """The outermost container and all text blocks in page order, each with its text.

    Unclosed and stray tags are put up with: an end tag closes everything up to
    its start tag, or nothing if there is none. What belongs to the body ends
    the head; the start of an article or section ends elements around the
    article that have no end tag of their own. A tag without `>` ends at the
    next one. Pages of any depth are read in one pass.
    """
    tokens = list(_TOKEN.finditer(page))
    starts: dict[str, list[int]] = {}
    unclosed: set[int] = set()  # tokens that start an element of _NEVER or _BLOCKS and have no end tag
    for i, m in enumerate(tokens):
        tag = (m["tag"] or "").lower()
        if (tag in _NEVER or tag in _BLOCKS) and m[0][1] != "/":
            starts.setdefault(tag, []).append(i)
            unclosed.add(i)
        elif starts.get(tag):
            unclosed.discard(starts[tag].pop())
    root = Box("", "", False)
    boxes, tags, link = [root], [""], 0
    places: dict[str, list[int]] = {"": [0]}  # where elements of a tag are open
    loose: list[int] = []  # where those without an end tag are
    found: list[tuple[Box, str]] = []
    piece: list[str] = []
    linked, element = 0, ""  # of the piece: characters in links, and the block element it stands in

    def block():
        nonlocal piece, linked
        text = " ".join("".join(piece).split())
        if text:
            leaf = Box(f"#{element}", "#", False, boxes[-1])
            leaf.text, leaf.linked = text, linked
            boxes[-1].children.append(leaf)
            found.append((leaf, text))
        piece, linked = [], 0

    def close(at: int):
        while len(boxes) > at:
            boxes.pop()
            places[tags.pop()].pop()
        while loose and loose[-1] >= at:
            loose.pop()

    for number, m in enumerate(tokens):
        token, tag = m[0], m["tag"]
        if tag is None:
            if m["raw"] or m["torn"] or (token[0] == "<" and len(token) > 1):
                continue
            said = html.unescape(token)
            if tags[-1] == "head" and said.strip():
                close(len(boxes) - 1)
            piece.append(said)
            if link:
                linked += len(said.strip())
            continue
        tag = tag.lower()
        end = token[1] == "/"
        if tags[-1] == "head" and not end and tag not in _HEAD_ONLY:
            close(len(boxes) - 1)
        if tag == "a":
            link = 0 if end else 1
        if tag in _INLINE:
            continue
        block()
        if tag in _BLOCKS:
            element = "" if end else tag
        while not end and tags[-1] in _IMPLIED and (_IMPLIED[tags[-1]] is None or tag in _IMPLIED[tags[-1]]):
            close(len(boxes) - 1)
        if not end:
            if m["attrs"].endswith("/") or not (tag in _CONTAINERS or tag in _BLOCKS):
                continue
            if tag in _BLOCKS:
                box = _box(tag, m["attrs"], boxes[-1]) if m["attrs"] else None
                if box is None or not box.around or (number in unclosed and tag not in _IMPLIED):
                    continue
            else:
                if tag in _ARTICLES and loose:
                    close(loose[0])
                    link = 0
                box = _box(tag, m["attrs"], boxes[-1])
            boxes[-1].children.append(box)
            places.setdefault(tag, []).append(len(boxes))
            if tag in _NEVER and number in unclosed:
                loose.append(len(boxes))
            boxes.append(box)
            tags.append(tag)
        elif places.get(tag):
            close(places[tag][-1])
            link = 0
    block()
    return root, found


# --- wrappers ---------------------------------------------------------------------------------


@dataclass
class Wrapper:
    """A container or text block in a host's expression: optional or not, repeated or not, what is inside in page order.

    `pages` counts the pages that have it (at least; a repeated one counts once
    a page), `chars` and `linked` the text of a block. `same` is a hash of a
    block's text that is constant, that is, in more than half of its container's
    pages; any other block is a slot and has none. `template`: found to be no
    part of the article.
    """

    sig: str
    around: bool = False
    optional: bool = False
    repeated: bool = False
    pages: int = 1
    chars: int = 0
    linked: int = 0
    same: str | None = None
    template: bool = False
    children: list[Wrapper] = field(default_factory=list)

    @property
    def block(self) -> bool:
        return self.sig.startswith("#")

    def pack(self) -> list:
        """All nodes in page order, each with the number of those directly inside."""
        rows, open_ = [], [self]
        while open_:
            one = open_.pop()
            rows.append([
                one.sig, one.around, one.optional, one.repeated, one.pages, one.chars, one.linked, one.same, one.template, len(one.children)
            ])
            open_.extend(reversed(one.children))
        return rows

    @staticmethod
    def unpack(rows: list) -> Wrapper:
        done: list[Wrapper] = []
        for *values, inner in reversed(rows):
            children = [done.pop() for _ in range(inner)]
            done.append(Wrapper(*values, children))
        return done[0]

    def expression(self) -> str:
        """The wrapper to read: `#` is a text slot, a quoted hash constant text."""
        return _run(self._expression())

    def _expression(self) -> Iterator:
        inner = []
        for child in self.children:
            inner.append((yield child._expression()))
        whole = f"<{self.sig}>{' '.join(inner)}</>" if not self.block else "#" if self.same is None else f"'{self.same}'"
        mark = ("+" if self.repeated else "") + ("?" if self.optional else "")
        return f"({whole}){mark}" if mark else whole


def _run(step: Iterator):
    """Run a generator that yields generators it needs the value of: recursion without depth."""
    open_, value = [step], None
    while open_:
        try:
            step = open_[-1].send(value)
            open_.append(step)
            value = None
        except StopIteration as done:
            open_.pop()
            value = done.value
    return value


def of_page(box: Box) -> Wrapper:
    """A page as an expression: neighbouring containers of one signature are one repeated group, text is constant."""
    return _run(_of_page(box))


def _said(text: str) -> str:
    return blake2b(text.encode("utf-8", "replace"), digest_size=6).hexdigest()


def _of_page(box: Box) -> Iterator:
    children = []
    for child in () if box.around else box.children:
        if child.tag == "#":
            children.append(Wrapper(child.sig, chars=len(child.text), linked=child.linked, same=_said(child.text)))
        else:
            children.append((yield _of_page(child)))
    return Wrapper(box.sig, box.around, children=(yield _folded(children)))


def _folded(children: list[Wrapper]) -> Iterator:
    """Neighbours as repeated groups: containers of one signature, slots, the same constant text."""
    out: list[Wrapper] = []
    for child in children:
        if out and out[-1].sig == child.sig and out[-1].same == child.same:
            out[-1] = yield _join(out[-1], child, max)
            out[-1].repeated = True
        else:
            out.append(child)
    return out


def join(a: Wrapper, b: Wrapper) -> Wrapper:
    """The expression that covers both. Mismatching texts become a slot, what only one has an optional group."""
    return _run(_join(a, b, int.__add__))


def _join(a: Wrapper, b: Wrapper, counted) -> Iterator:
    """`counted` gives the pages of both: their sum, or for two parts of one expression the larger number."""
    pages = counted(a.pages, b.pages)
    children: list[Wrapper] = []
    for x, y in _aligned(a.children, b.children, a.pages, b.pages):
        one = x or y
        if x is None or y is None:
            one.optional = True
        else:
            one = yield _join(x, y, counted)
        if one.block and pages > 1 and not _firm(one, pages):
            one.same = None
        children.append(one)
    return Wrapper(
        a.sig, a.around or b.around, a.optional or b.optional, a.repeated or b.repeated, pages, a.chars + b.chars,
        a.linked + b.linked, a.same if a.same == b.same else None, False, (yield _folded(children)),
    )


def _firm(block: Wrapper, pages: int) -> bool:
    return block.same is not None and pages > 1 and 2 * block.pages > pages


def _aligned(a: list[Wrapper], b: list[Wrapper], a_pages: int, b_pages: int) -> Iterator[tuple[Wrapper | None, Wrapper | None]]:
    """Pairs in the order of both, and what has no partner.

    Equal beginnings and ends are paired, then what occurs once on either side,
    by a longest increasing sequence, then the gaps between in the same way. What
    is left is paired by signature in order, constant text only with itself.
    Takes no more than n log n steps a round, for any number of children.
    """
    exact = lambda c: (c.sig, c.same)
    x, y = [exact(c) for c in a], [exact(c) for c in b]
    if x == y:
        yield from zip(a, b)
        return
    firm = {exact(c) for side, pages in ((a, a_pages), (b, b_pages)) for c in side if _firm(c, pages)}
    open_ = [(0, len(a), 0, len(b))]
    while open_:
        i, i_end, j, j_end = open_.pop()
        while i < i_end and j < j_end and x[i] == y[j]:
            yield a[i], b[j]
            i, j = i + 1, j + 1
        tail = 0
        while i < i_end - tail and j < j_end - tail and x[i_end - tail - 1] == y[j_end - tail - 1]:
            tail += 1
        if tail:
            open_.append((i_end - tail, i_end, j_end - tail, j_end))
            i_end, j_end = i_end - tail, j_end - tail
        if i == i_end or j == j_end:
            yield from ((c, None) for c in a[i:i_end])
            yield from ((None, c) for c in b[j:j_end])
            continue
        anchors = _anchors(x, i, i_end, y, j, j_end)
        if anchors:
            cuts = [*anchors, (i_end, j_end)]
            open_.extend((p, p_next, q, q_next) for (p, q), (p_next, q_next) in reversed(list(zip(cuts, cuts[1:]))))
            open_.append((i, anchors[0][0], j, anchors[0][1]))
        else:
            yield from _by_signature(a[i:i_end], b[j:j_end], firm)


def _anchors(x: list, i: int, i_end: int, y: list, j: int, j_end: int) -> list[tuple[int, int]]:
    """Places of what occurs once on either side, as many as have one order on both."""
    times_x, times_y = Counter(x[i:i_end]), Counter(y[j:j_end])
    at = {key: q for q, key in enumerate(y[j:j_end], j) if times_y[key] == 1}
    pairs = [(p, at[key]) for p, key in enumerate(x[i:i_end], i) if times_x[key] == 1 and key in at]
    ends: list[int] = []  # the least end of an increasing sequence of each length
    last: list[int] = []  # the pair that has it
    before: list[int] = []
    for n, (_, q) in enumerate(pairs):
        length = bisect_left(ends, q)
        before.append(last[length - 1] if length else -1)
        if length == len(ends):
            ends.append(q)
            last.append(n)
        else:
            ends[length], last[length] = q, n
    chain, n = [], last[-1] if last else -1
    while n >= 0:
        chain.append(pairs[n])
        n = before[n]
    return chain[::-1]


def _by_signature(a: list[Wrapper], b: list[Wrapper], firm: set) -> Iterator[tuple[Wrapper | None, Wrapper | None]]:
    """Pairs of one signature in order; at a mismatch the side goes on whose next match is nearer."""
    kind = lambda c: (c.sig, c.same) if (c.sig, c.same) in firm else c.sig
    x, y = [kind(c) for c in a], [kind(c) for c in b]
    places: tuple[dict, dict] = ({}, {})
    for side, keys in zip(places, (x, y)):
        for n, key in enumerate(keys):
            side.setdefault(key, []).append(n)

    def away(side: dict, key, start: int) -> float:
        found = side.get(key, ())
        n = bisect_left(found, start)
        return found[n] - start if n < len(found) else float("inf")

    i = j = 0
    while i < len(a) and j < len(b):
        if x[i] == y[j]:
            yield a[i], b[j]
            i, j = i + 1, j + 1
            continue
        in_a, in_b = away(places[0], y[j], i), away(places[1], x[i], j)
        if in_a <= in_b and in_a < float("inf"):
            yield a[i], None
            i += 1
        elif in_b < float("inf"):
            yield None, b[j]
            j += 1
        else:
            yield a[i], None
            yield None, b[j]
            i, j = i + 1, j + 1
    yield from ((c, None) for c in a[i:])
    yield from ((None, c) for c in b[j:])


# --- from a wrapper to the article ------------------------------------------------------------

_SHARE = 0.7  # of the text that a container must hold to be the article
_LINKS = 0.8  # of a container's text that makes it a menu
_PAGES, _PAGES_SHARE = 5, 0.8  # pages of a host, and share of them, that have a text which is part of the template
_VARIED = 2  # times as much as all such text a page's other text must be on average: pages that are mostly copies have no template

# Known paths as (place of the outer one, signature), the article's, those left out, and the expression if text of it is left out.
Rule = tuple[list[tuple[int, str]], int, list[int], Wrapper | None]


def _constant(blocks: list[Wrapper], pages: int) -> list[Wrapper]:
    """The blocks that say the same on nearly all pages of a host, if they are little beside what the other blocks say."""
    fixed = [c for c in blocks if c.same is not None and c.pages >= max(_PAGES, _PAGES_SHARE * pages)]
    said = sum(c.chars / c.pages for c in fixed)
    varied = sum(c.chars for c in blocks if c.same is None) / pages
    return fixed if _VARIED * said <= varied else []


def rule(wrapper: Wrapper) -> Rule:
    """Which container is the article, and what in it is not.

    The article is an article or main element with most text, else the innermost
    container with most of the text that is not around it; text that the
    alignment found to be the same on nearly all pages of the host does not
    count. In the article such text is the host's template and left out, unless
    it is much beside the text that varies (see `_constant`). Containers of links
    are left out if no element is named as the article.
    """
    known: dict[tuple[int, str], int] = {(-1, wrapper.sig): 0}
    paths, stats, depth = [(-1, wrapper.sig)], [[0, 0, 0]], [0]  # text, text in links, text that may be an article's
    blocks: list[list[Wrapper]] = [[]]
    open_ = [(wrapper, 0)]
    while open_:
        node, at = open_.pop()
        for child in reversed(node.children):
            if child.around:
                continue
            if child.block:
                blocks[at].append(child)
                continue
            place = known.setdefault((at, child.sig), len(paths))
            if place == len(paths):
                paths.append((at, child.sig))
                stats.append([0, 0, 0])
                blocks.append([])
                depth.append(depth[at] + 1)
            open_.append((child, place))
    every = range(len(paths))
    fixed = {id(c) for c in _constant([c for own in blocks for c in own], wrapper.pages)}
    for i in every:
        for c in blocks[i]:
            own = stats[i]
            own[0], own[1] = own[0] + c.chars, own[1] + c.linked
            own[2] += 0 if id(c) in fixed else c.chars - c.linked
    whole = [max(0, said) for _, _, said in stats]
    for i in reversed(every):  # outer paths come before inner ones
        if i:
            whole[paths[i][0]] += whole[i]

    def within(root: int) -> list[bool]:
        inside = [False] * len(paths)
        for i in every:
            inside[i] = i == root or (i > 0 and inside[paths[i][0]])
        return inside

    named = [i for i in every if i and paths[i][1].split(".")[0] in ("article", "main") and whole[i]]
    if named:
        root = max(named, key=lambda i: (whole[i], -depth[i], -i))
        inside = within(root)
        root = max((i for i in named if inside[i] and whole[i] >= _SHARE * whole[root]), key=lambda i: (depth[i], -i))
    else:
        root = max((i for i in every if whole[i] >= _SHARE * whole[0]), key=lambda i: (depth[i], whole[i], -i))
    inside = within(root)
    drop = [i for i, (chars, linked, _) in enumerate(stats) if inside[i] and i != root and chars and not named and linked >= _LINKS * chars]
    template = _constant([c for i in every if inside[i] for c in blocks[i]], wrapper.pages)
    for c in template:
        c.template = True
    return paths, root, drop, wrapper if template else None


def template_blocks(root: Box, wrapper: Wrapper) -> set[Box]:
    """The text blocks of a page that the alignment with its host's expression puts on template text."""
    found: set[Box] = set()
    open_ = [(root, wrapper)]
    while open_:
        box, node = open_.pop()
        own: list[Wrapper] = []
        members: dict[int, list[Box]] = {}
        for child in box.children:
            if child.around:
                continue
            same = _said(child.text) if child.tag == "#" else None
            if not own or own[-1].sig != child.sig or own[-1].same != same:
                own.append(Wrapper(child.sig, same=same))
            members.setdefault(id(own[-1]), []).append(child)
        inner = [c for c in node.children if not c.around]
        for x, y in _aligned(own, inner, 1, node.pages):
            if x is None or y is None:
                continue
            if not x.block:
                open_.extend((member, y) for member in members[id(x)])
            elif y.template and x.same == y.same:
                found.update(members[id(x)])
    return found


def main_text(page: str, known: Rule | None) -> str:
    """The article's blocks, joined. A page that has no text where its host's rule looks is taken by itself."""
    root, blocks = parse(page)

    def taken(of: Rule) -> str:
        paths, at, drop, wrapper = of
        place = {tuple(path): i for i, path in enumerate(paths)}
        left_out = set(drop)
        state = {root: (0, at == 0, False)}  # per container its path's place, whether it is in the article, whether it is left out
        open_ = [root]
        while open_:
            box = open_.pop()
            here, inside, out = state[box]
            for child in box.children:
                if child.tag != "#":
                    there = place.get((here, child.sig), -1) if here >= 0 else -1
                    state[child] = there, inside or there == at, out or there in left_out
                    open_.append(child)
        template = template_blocks(root, wrapper) if wrapper else ()
        return " ".join(text for box, text in blocks if not box.hidden and state[box.parent][1] and not state[box.parent][2] and box not in template)

    text = taken(known) if known else ""
    return text or taken(rule(of_page(root)))


# --- on Spark ---------------------------------------------------------------------------------

_SALTS = 256
_HELD = 2000  # hosts that a task folds at a time


def host_of(url: Column) -> Column:
    """The host of an address in lower case; a null or odd address has the host ''."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): one expression per host, from all of its pages.

    Each task folds the pages it reads, so a host leaves a task as one row;
    these are joined in two rounds, so that also a host with a third of all
    pages is never gathered from all tasks at once.
    """

    def fold(batches):
        held: dict[str, Wrapper] = {}
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = of_page(parse(page.as_py() or "")[0])
                held[host] = join(held[host], own) if host in held else own
                if len(held) >= _HELD:
                    yield _packed(held)
                    held = {}
        if held:
            yield _packed(held)

    def merge(table: pa.Table) -> pa.Table:
        whole = None
        for packed in sorted(table.column("wrapper").to_pylist()):
            one = Wrapper.unpack(json.loads(packed))
            whole = one if whole is None else join(whole, one)
        return pa.Table.from_batches([_packed({table.column("host")[0].as_py(): whole})])

    schema = "host string, wrapper string"
    parts = pick(pages, "url", "html").select(host_of(F.col("url")).alias("host"), "html").mapInArrow(fold, schema)
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(_SALTS)))
    return salted.groupBy("host", "salt").applyInArrow(merge, schema).groupBy("host").applyInArrow(merge, schema)


def _packed(held: dict[str, Wrapper]) -> pa.RecordBatch:
    texts = [json.dumps(w.pack(), separators=(",", ":")) for w in held.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(texts, pa.string())], ["host", "wrapper"])


def _rule_text(of: Rule) -> str:
    *places, wrapper = of
    return json.dumps([*places, wrapper and wrapper.pack()], separators=(",", ":"))


def _rule(text: str) -> Rule:
    *places, wrapper = json.loads(text)
    return (*places, wrapper and Wrapper.unpack(wrapper))


def rules(host_wrappers: DataFrame) -> DataFrame:
    """(host, rule): where the article is on a host's pages, as JSON."""

    def run(batches):
        for batch in batches:
            found = [_rule_text(rule(Wrapper.unpack(json.loads(w)))) for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["host", "rule"])

    return host_wrappers.mapInArrow(run, "host string, rule string")


def extract(pages: DataFrame) -> DataFrame:
    """Per row of `pages` (page_id, url, html): the main text and its length in code points.

    A null or empty page has an empty text, as has a page of nothing but what
    stands around articles. Pages without a host are one host. Repeated rows and
    null ids are returned like any other, further columns are left out. Pages
    meet their host's rule in a join that Spark broadcasts if the rules are
    small and may split at hosts with many pages if not.
    """
    found = settle(rules(wrappers(pages)), "page-rules")

    def run(batches):
        known: OrderedDict[str, tuple] = OrderedDict()
        for batch in batches:
            texts = []
            for page, packed in zip(batch.column(2), batch.column(3).to_pylist()):
                if packed is not None and packed not in known:
                    known[packed] = _rule(packed)
                    if len(known) > _HELD:
                        known.popitem(last=False)
                texts.append(main_text(page.as_py() or "", known.get(packed)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pick(pages, "page_id", "url", "html").withColumn("host", host_of(F.col("url")))
    return rows.join(found, "host", "left").select("page_id", "url", "html", "rule").mapInArrow(run, RESULT)
