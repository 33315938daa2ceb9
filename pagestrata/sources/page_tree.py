"""One page's markup to element tuples: the only Python code in the data path.

``page_elements`` reads one HTML string and returns one tuple per requested
element, in time that grows with the page and with what is emitted, however
deeply it is nested. It numbers elements in document order (``pre``) and closing order
(``post``), so that ``post + depth`` is the ``pre`` of the last descendant.
Everything that relates elements to each other is done by Spark afterwards.

``_Builder`` makes the tree of a page, ``_Page`` walks it and notes what is asked for.

Tree rules covered: void elements, implied end tags, ``tbody``/``tr``
insertion, table parts outside a table ignored, end tags that match nothing
ignored, raw text elements, comments, entities, markup cut off at the end,
mis-nested formatting elements re-opened, stray table content put in front of
the table. Text is as shown: not what ``hidden``, ``display:none`` or
``visibility`` written on an element hides, and ``pre`` keeps its spaces.
"""

from __future__ import annotations

import codecs
import html as html_lib
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urljoin

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW_TEXT = frozenset("script style iframe noembed noframes noscript xmp".split())
RAW_DECODED = frozenset("title textarea".split())
UNSEEN = frozenset("head title template textarea".split()) | RAW_TEXT
TABLE_PARTS = frozenset("caption colgroup thead tbody tfoot tr td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form header hgroup hr html legend li main menu nav ol p pre "
    "search section summary table tbody thead tfoot tr caption ul".split()
)
SCOPES = frozenset("table td th caption html template".split())
SPECIAL = BLOCKS | SCOPES
# Start tag -> (open elements it ends, elements that stop the search).
_TABLE, _P = frozenset(["table"]), frozenset(["p"])
_ROWS = frozenset("tr td th".split())
_GROUPS = frozenset("thead tbody tfoot caption colgroup".split())
IMPLIED_END = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split()) | SCOPES),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"]) | SCOPES),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"]) | SCOPES),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "tr": (_ROWS | frozenset("caption colgroup".split()), frozenset(["table"])),
    **{tag: (_ROWS | _GROUPS, frozenset(["table"])) for tag in _GROUPS},
}
# Formatting elements, cells that keep them in, elements before which they are not re-opened.
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
MARKERS = frozenset("td th caption".split())
UNFORMATTED = BLOCKS | TABLE_PARTS | RAW_TEXT | frozenset("base col frame frameset head link meta param source template title track".split())
TABLE_CONTEXT = frozenset("table tbody thead tfoot tr".split())
IN_TABLE = TABLE_PARTS | frozenset("script style template form col".split())
#: Formatting elements that wait to be re-opened at most; the oldest are forgotten, as no browser nests deeper.
MOST_FORMATTING = 512
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:;|!|$)", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\s*(?:;|!|$)", re.I)
_KEPT_SPACE = re.compile(r"(?:^|;)\s*white-space\s*:\s*(pre|pre-wrap|break-spaces)\s*(?:;|!|$)", re.I)

P_ENDERS = (BLOCKS | {"hr"}) - {"body", "html", "caption", "tbody", "thead", "tfoot", "tr"}

_ATTRIBUTE = r"""[^\s/>][^\s/>=]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?)?"""
_MARKUP = re.compile(
    rf"<!--(?:-?>|(.*?)(?:--!?>|\Z))"
    rf"|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|{_ATTRIBUTE})*+)(>|\Z)"
    rf"|<(?:[!?]|/(?=[^a-zA-Z]))[^>]*>?",
    re.S,
)
_ATTRS = re.compile(
    r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)?))?"""
)
#: Tags that read the same wherever they stand: every quote in them is closed. Addresses differ too much to be noted.
_REPEATED = re.compile(r"""</?[a-zA-Z][a-zA-Z0-9]*(?: (?:class|align|style|type|alt|src)="[^"<>]*")*\s*>""")
#: Tags noted at most, and their length.
MOST_NOTED, LONGEST_NOTED = 4096, 120
_SOURCE_SPACE = re.compile(r"[ \t\r\n\f]{2,}|[\t\r\n\f]")
# In the text of a page "\n" is a forced line break and "\r" a block edge.
_BREAK, _EDGE = "\n", "\r"
#: Addresses of which a join puts one behind the other.
_ORIGIN = re.compile(r"https?://[A-Za-z0-9.-]+(?=/)")
_PLAIN_PATH = re.compile(r"(?:/[A-Za-z0-9_-]+)+")
#: Shared by all elements without attributes; never changed.
NO_ATTRIBUTES: dict[str, str] = {}
#: Tag of the row that tells that a page has any of the elements asked for in ``presence``.
PAGE = "#page"


def _any_class(cls: str, words: tuple[str, ...]) -> bool:
    return not words or any(word in cls for word in words)


def _merge(a: dict, b: dict) -> dict:
    both = {t: tuple(sorted(set(a[t]) | set(b[t]))) if a[t] and b[t] else () for t in a.keys() & b.keys()}
    return {**a, **b, **both}


@dataclass(frozen=True)
class NodeRequest:
    """What to emit. Each map goes from tag to class substrings (none: every class).

    ``context`` are the enclosing elements that ``anc`` lists, ``paths`` the tags
    whose ``path`` is given, ``attributes`` the attributes kept (None: all), and
    ``presence`` tags of which any gives the page a row with the tag PAGE.
    """

    elements: dict[str, tuple[str, ...]]
    text: dict[str, tuple[str, ...]] = field(default_factory=dict)
    value: dict[str, tuple[str, ...]] = field(default_factory=dict)
    inner_html: dict[str, tuple[str, ...]] = field(default_factory=dict)
    context: dict[str, tuple[str, ...]] = field(default_factory=dict)
    paths: frozenset[str] = frozenset()
    attributes: frozenset[str] | None = frozenset()
    presence: frozenset[str] = frozenset()
    #: What was found out for a tag and class, for all pages.
    wishes: dict[tuple[str, str], _Wish] = field(default_factory=dict, init=False, repr=False, compare=False)

    def __or__(self, other: NodeRequest) -> NodeRequest:
        every = self.attributes is None or other.attributes is None
        return NodeRequest(
            _merge(self.elements, other.elements),
            _merge(self.text, other.text),
            _merge(self.value, other.value),
            _merge(self.inner_html, other.inner_html),
            _merge(self.context, other.context),
            self.paths | other.paths,
            None if every else self.attributes | other.attributes,
            self.presence | other.presence,
        )


class _Text:
    """The visible text of a page, kept as it is shown: spaces collapsed, none beside line ends.

    An element's text is a span of it, so nested elements cost no more than
    the text they give.
    """

    def __init__(self):
        self.pieces: list[str] = []
        self.length = 0
        self.last = _EDGE
        self.space = False  # a space that counts only if text follows

    def add(self, piece: str) -> None:
        if not piece:
            return
        if piece[0] == " ":
            self.space = True
            piece = piece.lstrip(" ")
            if not piece:
                return
        if self.space and self.last not in (_BREAK, _EDGE):
            self.pieces.append(" ")
            self.length += 1
        self.space = piece[-1] == " "
        piece = piece.rstrip(" ")
        self.pieces.append(piece)
        self.length += len(piece)
        self.last = piece[-1]

    def add_kept(self, text: str) -> None:
        """Text whose spaces and line ends are shown as they are."""
        for k, line in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if k:
                self.line_break()
            if line:
                if self.space and self.last not in (_BREAK, _EDGE):
                    line = " " + line
                self.space = False
                self.pieces.append(line)
                self.length += len(line)
                self.last = line[-1]

    def edge(self) -> None:
        self.space = False
        if self.last not in (_BREAK, _EDGE):
            self._end(_EDGE)

    def line_break(self) -> None:
        self.space = False
        self._end(_BREAK)

    def _end(self, char: str) -> None:
        self.pieces.append(char)
        self.length += 1
        self.last = char


def shown(text: str) -> str:
    """A span of a page's text as the element shows it."""
    return text.strip(" \r\n").replace(_EDGE, "\n").replace("\xa0", " ").strip()


def _escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("\xa0", "&nbsp;").replace("<", "&lt;").replace(">", "&gt;")


class _Rule:
    """What the rules above say of one tag, looked up once."""

    __slots__ = ("part", "table", "ends_p", "implied", "context", "heading", "row", "cell", "link", "formatting", "unformatted", "in_table", "void", "special", "scope", "marker", "raw")

    def __init__(self, tag: str):
        self.part, self.table, self.ends_p, self.implied = tag in TABLE_PARTS, tag == "table", tag in P_ENDERS, IMPLIED_END.get(tag)
        self.context = _TABLE if tag not in _ROWS else _GROUPS | _TABLE if tag == "tr" else TABLE_CONTEXT
        self.heading, self.row, self.cell, self.link = tag in HEADINGS, tag in _ROWS, tag in ("td", "th"), tag == "a"
        self.formatting, self.unformatted, self.in_table = tag in FORMATTING, tag in UNFORMATTED, tag in IN_TABLE
        self.void, self.special, self.scope, self.marker = tag in VOID, tag in SPECIAL, tag in SCOPES, tag in MARKERS
        self.raw = tag in RAW_TEXT or tag in RAW_DECODED


_RULES: dict[str, _Rule] = {}
#: Tags as written, with what they say: whether they end an element, its tag, attributes and rule.
_NOTED: dict[str, tuple[bool, str, dict[str, str], _Rule]] = {}


def _rule(tag: str) -> _Rule:
    rule = _RULES.get(tag)
    if rule is None:
        if len(_RULES) >= MOST_NOTED:
            _RULES.clear()
        rule = _RULES[tag] = _Rule(tag)
    return rule


def _attributes(source: str) -> dict[str, str]:
    attrs: dict[str, str] = {}
    for name, double, single, bare in _ATTRS.findall(source):
        value = double or single or bare
        attrs.setdefault(name.lower(), html_lib.unescape(value) if "&" in value else value)
    return attrs


class _Wish:
    """What a request asks of the elements of one tag and class, and how the tag is shown."""

    __slots__ = ("emit", "text", "value", "html", "context", "path", "present", "unseen", "kept", "br", "block", "td", "void")

    def __init__(self, want: NodeRequest, tag: str, cls: str):
        def asks(part: dict[str, tuple[str, ...]]) -> bool:
            return tag in part and _any_class(cls, part[tag])

        self.emit, self.text, self.value = asks(want.elements), asks(want.text), asks(want.value)
        self.html, self.context = asks(want.inner_html), asks(want.context)
        self.path, self.present = tag in want.paths, tag in want.presence
        self.unseen, self.kept, self.br, self.block = tag in UNSEEN, tag == "pre", tag == "br", tag in BLOCKS
        self.td, self.void = tag == "td", tag in VOID


class _Page:
    def __init__(self, request: NodeRequest, url: str):
        self.request, self.base = request, url
        self.wishes = request.wishes
        self.stack: list[_Node] = []
        self.rows: list[tuple] = []
        self.text = _Text()
        self.value: list[str] = []
        self.html: list[str] = []
        self.pre = self.post = self.unseen = self.html_open = 0
        self.value_length = self.html_length = 0
        self.present = self.based = False
        self.veiled = False
        self.kept = 0

    def add_html(self, piece: str) -> None:
        self.html.append(piece)
        self.html_length += len(piece)

    def add_text(self, text: str, raw: bool = False) -> None:
        data = text if raw or "&" not in text else html_lib.unescape(text)
        if self.html_open:
            self.add_html(data if raw else _escape(data))
        if self.request.value:
            self.value.append(data)
            self.value_length += len(data)
        if not self.unseen and not self.veiled:
            if self.kept:
                self.text.add_kept(data)
            else:
                # Looking for characters is much faster than the pattern, which few texts need.
                if "  " in data or "\n" in data or "\t" in data or "\r" in data or "\f" in data:
                    data = _SOURCE_SPACE.sub(" ", data)
                self.text.add(data)

    def push(self, el: _Node) -> None:
        tag, attrs = el.tag, el.attrs
        if self.html_open:
            as_written = "".join(
                ' %s="%s"' % (k, v.replace("&", "&amp;").replace("\xa0", "&nbsp;").replace('"', "&quot;"))
                for k, v in attrs.items()
            )
            self.add_html(f"<{tag}{as_written}>")
        el.cls = cls = attrs.get("class", "") if attrs else ""
        wish = self.wishes.get((tag, cls))
        if wish is None:
            if len(self.wishes) >= MOST_NOTED:
                self.wishes.clear()
            wish = self.wishes[tag, cls] = _Wish(self.request, tag, cls)
        el.wish = wish
        if self.stack:
            up = self.stack[-1]
            el.parent, el.context = up, up if up.wish.context else up.context
        else:
            el.parent = el.context = None
        el.pre = self.pre
        self.pre += 1
        el.veiled = self.veiled
        gone, kept = wish.unseen, wish.kept
        if attrs:
            gone = gone or "hidden" in attrs
            if style := attrs.get("style"):
                gone = gone or bool(_NO_DISPLAY.search(style))
                kept = kept or bool(_KEPT_SPACE.search(style))
                if said := _VISIBILITY.search(style):
                    self.veiled = said[1].lower() != "visible"
        el.gone, el.kept = gone, kept
        self.unseen += gone
        self.kept += kept
        if not self.unseen:
            if wish.br:
                if not self.veiled:
                    self.text.line_break()
            elif wish.block:
                self.text.edge()
        self.html_open += wish.html
        if wish.emit:
            el.marks = (self.text.length, self.value_length, self.html_length)
        if wish.present:
            self.present = True
        self.stack.append(el)

    def pop(self) -> None:
        el = self.stack.pop()
        wish = el.wish
        if wish.emit:
            self.rows.append((el, self.post, len(self.stack), self.text.length, self.value_length, self.html_length))
        self.post += 1
        seen = not self.unseen
        self.unseen -= el.gone
        self.kept -= el.kept
        self.veiled = el.veiled
        self.html_open -= wish.html
        if self.html_open and not wish.void:
            self.add_html(f"</{el.tag}>")
        if seen:
            if wish.td:
                self.text.add(" ")
            elif wish.block:
                self.text.edge()

    def finished(self) -> Iterator[tuple]:
        """Rows of the elements, in closing order, made one at a time."""
        kept = self.request.attributes
        text, value, html = ("".join(x) for x in (self.text.pieces, self.value, self.html))
        # Neighbours in closing order mostly share what is around them.
        inside = within = self
        above, anc = "", []
        for el, post, depth, text_end, value_end, html_end in self.rows:
            wish, attrs, parent = el.wish, el.attrs, el.parent
            text_start, value_start, html_start = el.marks
            if wish.path and parent is not inside:
                inside, above = parent, "".join("/" + e.tag for e in el.chain("parent"))
            if el.context is not within:
                within, anc = el.context, [(e.pre, e.tag, e.cls) for e in el.chain("context")]
            href = attrs.get("href") if attrs else None
            yield (
                el.pre,
                post,
                depth,
                -1 if parent is None else parent.pre,
                el.tag,
                el.cls,
                f"{above}/{el.tag}" if wish.path else None,
                [(k, v) for k, v in attrs.items() if kept is None or k in kept] if attrs else [],
                None if href is None else self.link(href),
                anc,
                shown(text[text_start:text_end]) if wish.text else None,
                value[value_start:value_end] if wish.value else None,
                html[html_start:html_end] if wish.html else None,
            )
        if self.present:
            yield (-1, -1, -1, -1, PAGE, "", None, [], None, [], None, None, None)

    def link(self, href: str) -> str:
        if _PLAIN_PATH.fullmatch(href) and (origin := _ORIGIN.match(self.base)):
            return origin[0] + href
        try:
            return urljoin(self.base, href.strip())
        except ValueError:
            return href

    def walk(self, root: _Node) -> Iterator[tuple]:
        """Note what is asked for, in the order of the page."""
        within: list[tuple[_Node, Iterator]] = [(root, iter(root.children))]
        while within:
            node, children = within[-1]
            for child in children:
                if isinstance(child, str):
                    self.add_text(child, raw=node.tag in RAW_TEXT)
                elif child.tag is None:
                    if self.html_open:
                        self.add_html(f"<!--{child.attrs}-->")
                else:
                    if child.tag == "base" and "href" in child.attrs and not self.based:  # the first one counts, for all links
                        self.base, self.based = self.link(child.attrs["href"]), True
                    self.push(child)
                    within.append((child, iter(child.children)))
                    break
            else:
                within.pop()
                node.children = []  # no cycles are left, so the tree goes with the last row
                if within:
                    self.pop()
        return self.finished()


class _Node:
    """An element; a comment has no tag and its text for attributes."""

    __slots__ = ("tag", "attrs", "parent", "children", "place", "pre", "cls", "context", "marks", "wish", "gone", "veiled", "kept", "rule")

    def __init__(self, tag: str | None, attrs, rule: _Rule | None = None):
        self.tag, self.attrs, self.parent, self.place = tag, attrs, None, -1
        self.rule = rule
        self.children: list[_Node | str] = []

    def chain(self, link: str) -> list[_Node]:
        """The enclosing elements along ``parent`` or ``context``, outermost first, once the page is walked."""
        out, at = [], getattr(self, link)
        while at is not None:
            out.append(at)
            at = getattr(at, link)
        return out[::-1]

    def detach(self) -> None:
        siblings = self.parent.children if self.parent else ()
        for k in range(len(siblings) - 1, -1, -1):  # nearly always the last one
            if siblings[k] is self:
                del siblings[k]
                return


class _Builder:
    """Markup to a tree, by the rules of the HTML standard that change where things are."""

    def __init__(self, comments: bool):
        self.root = _Node("", {})
        self.comments = comments
        self.stack: list[_Node] = []
        #: Where in the stack the elements of a tag are, and those that end formatting: innermost last.
        self.open_at: dict[str, list[int]] = defaultdict(list)
        self.special_at: list[int] = []
        self.scope_at: list[int] = []
        #: Formatting elements that are open or were closed from outside; None for the start of a cell.
        self.formatting: list[_Node | None] = []
        self.tables, self.paragraphs = self.open_at["table"], self.open_at["p"]

    # The stack of open elements.

    def _noted(self, node: _Node, place: int) -> None:
        node.place = place
        self.open_at[node.tag].append(place)
        rule = node.rule
        if rule.special:
            self.special_at.append(place)
            if rule.scope:
                self.scope_at.append(place)

    def pop(self) -> None:
        node = self.stack.pop()
        self.open_at[node.tag].pop()
        rule = node.rule
        if rule.special:
            self.special_at.pop()
            if rule.scope:
                self.scope_at.pop()
        node.place = -1
        if rule.marker:
            while self.formatting and self.formatting.pop() is not None:
                pass

    def close_down_to(self, place: int) -> None:
        while len(self.stack) > place:
            self.pop()

    def innermost(self, tags: frozenset) -> int:
        """Where in the stack the innermost of some tags is, -1 if none is open."""
        if tags is SCOPES:
            return self.scope_at[-1] if self.scope_at else -1
        best = -1
        for tag in tags:
            at = self.open_at.get(tag)
            if at and at[-1] > best:
                best = at[-1]
        return best

    def end_open(self, tags: frozenset, barriers: frozenset) -> None:
        """Close the outermost of ``tags`` that is open inside the nearest barrier."""
        last = self.innermost(tags)
        if last < 0 or last <= (barrier := self.innermost(barriers)):
            return
        found = last
        for tag in tags:
            at = self.open_at.get(tag)
            if at and at[-1] > barrier:
                found = min(found, at[bisect_right(at, barrier)])
        self.close_down_to(found)

    # Where things go.

    def put(self, child: _Node | str, under: _Node | None = None) -> None:
        """Append to an element; what may not be in a table goes in front of it."""
        under = under or (self.stack[-1] if self.stack else self.root)
        if under.tag in TABLE_CONTEXT and self._is_stray(child):
            table = self.stack[self.open_at["table"][-1]]
            under = table.parent
            for k in range(len(under.children) - 1, -1, -1):  # nearly always the last one
                if under.children[k] is table:
                    under.children.insert(k, child)
                    break
        else:
            under.children.append(child)
        if isinstance(child, _Node):
            child.parent = under

    @staticmethod
    def _is_stray(child: _Node | str) -> bool:
        if isinstance(child, str):
            return bool(child.strip(" \t\r\n\f"))
        return child.tag is not None and child.tag not in IN_TABLE

    def insert(self, tag: str, attrs: dict[str, str], rule: _Rule) -> _Node:
        node = _Node(tag, attrs, rule)
        stack = self.stack
        if stack and (rule.in_table or stack[-1].tag not in TABLE_CONTEXT):
            node.parent = up = stack[-1]
            up.children.append(node)
        else:
            self.put(node)
        if not rule.void:
            self._noted(node, len(stack))
            stack.append(node)
            if rule.marker:
                self.formatting.append(None)
        return node

    # Formatting elements.

    def add_formatting(self, node: _Node) -> None:
        """At most three alike since the last cell began."""
        alike = 0
        for k in range(len(self.formatting) - 1, max(-1, len(self.formatting) - 16), -1):
            other = self.formatting[k]
            if other is None:
                break
            if other.tag == node.tag and other.attrs == node.attrs:
                alike += 1
                if alike == 3:
                    del self.formatting[k]
                    break
        self.formatting.append(node)
        if len(self.formatting) > MOST_FORMATTING:
            first = next((k for k, n in enumerate(self.formatting) if n is not None), 0)
            del self.formatting[first]

    def reopen(self) -> None:
        """Open again the formatting elements that were closed from outside."""
        k = len(self.formatting)
        while k and self.formatting[k - 1] is not None and self.formatting[k - 1].place < 0:
            k -= 1
        for k in range(k, len(self.formatting)):
            old = self.formatting[k]
            self.formatting[k] = self.insert(old.tag, old.attrs, old.rule)

    def _forget(self, node: _Node) -> None:
        self.formatting = [n for n in self.formatting if n is not node]

    def end_formatting(self, tag: str) -> bool:
        """The standard's way to end a formatting element; False if it is an end tag like any other."""
        for _ in range(8):
            at = len(self.formatting) - 1
            while at >= 0 and self.formatting[at] is not None and self.formatting[at].tag != tag:
                at -= 1
            if at < 0 or self.formatting[at] is None:
                return False
            node = self.formatting[at]
            if node.place < 0:
                del self.formatting[at]
                return True
            if self.innermost(SCOPES) > node.place:
                return True
            inner = bisect_right(self.special_at, node.place)
            if inner == len(self.special_at):
                self.close_down_to(node.place)
                self._forget(node)
                return True
            self._move_out(node, self.special_at[inner], at)
        return True

    def _move_out(self, node: _Node, place: int, bookmark: int) -> None:
        """Take the block at ``place`` out of a formatting element that ends inside it; what it holds stays formatted."""
        block, low = self.stack[place], node.place
        above = self.stack[low - 1] if low else self.root
        kept: list[_Node] = []  # open elements between the two, as copies, innermost first
        last = block
        for n, k in enumerate(range(place - 1, low, -1)):
            old = self.stack[k]
            listed = next((j for j, f in enumerate(self.formatting) if f is old), -1)
            if listed >= 0 and n >= 3:
                del self.formatting[listed]
                bookmark -= listed < bookmark
                listed = -1
            old.place = -1
            if listed < 0:
                continue
            copy = _Node(old.tag, old.attrs, old.rule)
            self.formatting[listed] = copy
            if last is block:
                bookmark = listed + 1
            last.detach()
            copy.children.append(last)
            last.parent = copy
            kept.append(copy)
            last = copy
        last.detach()
        self.put(last, above)
        copy = _Node(node.tag, node.attrs, node.rule)
        copy.children, block.children = block.children, [copy]
        for child in copy.children:
            if isinstance(child, _Node):
                child.parent = copy
        copy.parent = block
        listed = next(j for j, f in enumerate(self.formatting) if f is node)
        del self.formatting[listed]
        self.formatting.insert(bookmark - (listed < bookmark), copy)
        node.place = -1
        rest = [*kept[::-1], block, copy, *self.stack[place + 1 :]]
        for at in [*self.open_at.values(), self.special_at, self.scope_at]:
            del at[bisect_right(at, low - 1) :]
        del self.stack[low:]
        for one in rest:
            self._noted(one, len(self.stack))
            self.stack.append(one)

    # Tokens.

    def text(self, text: str) -> None:
        if self.formatting and not (self.stack and self.stack[-1].tag in TABLE_CONTEXT and not text.strip(" \t\r\n\f")):
            self.reopen()
        if self.stack and self.stack[-1].tag not in TABLE_CONTEXT:
            self.stack[-1].children.append(text)
        else:
            self.put(text)

    def start(self, tag: str, attrs: dict[str, str], rule: _Rule) -> None:
        in_table = self.tables
        if rule.part and not in_table:
            return
        if rule.table and in_table and self.innermost(MARKERS) < in_table[-1]:
            self.close_down_to(in_table[-1])  # a table directly in a table ends that one
        if rule.ends_p and self.paragraphs:
            self.end_open(_P, SCOPES)
        if rule.implied:
            self.end_open(*rule.implied)
        if rule.part and self.stack[-1].tag not in rule.context:  # what stands in front of the table is over
            self.close_down_to(self.innermost(rule.context) + 1)
        if rule.heading and self.stack and self.stack[-1].tag in HEADINGS:
            self.pop()
        elif rule.row:
            top = self.stack[-1].tag
            if top == "table":
                self.insert("tbody", NO_ATTRIBUTES, _rule("tbody"))
                top = "tbody"
            if rule.cell and top in ("tbody", "thead", "tfoot"):
                self.insert("tr", NO_ATTRIBUTES, _rule("tr"))
        elif rule.link:
            self._end_link()
        if self.formatting and not rule.unformatted:
            self.reopen()
        node = self.insert(tag, attrs, rule)
        if rule.formatting:
            self.add_formatting(node)

    def _end_link(self) -> None:
        """A link ends the one before it."""
        k = len(self.formatting) - 1
        while k >= 0 and self.formatting[k] is not None and self.formatting[k].tag != "a":
            k -= 1
        if k < 0 or self.formatting[k] is None:
            return
        node = self.formatting[k]
        self.end_formatting("a")
        self._forget(node)
        if node.place >= 0:  # a scope is in between: it stays where it is, but is open no more
            rest = self.stack[node.place + 1 :]
            low = node.place
            for at in [*self.open_at.values(), self.special_at, self.scope_at]:
                del at[bisect_right(at, low - 1) :]
            del self.stack[low:]
            node.place = -1
            for one in rest:
                self._noted(one, len(self.stack))
                self.stack.append(one)

    def end(self, tag: str, rule: _Rule) -> None:
        if tag == "br":
            self.start("br", NO_ATTRIBUTES, rule)
            return
        if tag in ("body", "html"):
            return
        top = self.stack[-1] if self.stack else None
        if rule.formatting:
            if top is not None and top.tag == tag and self.formatting and self.formatting[-1] is top:
                self.formatting.pop()  # nothing was opened in it since
                self.pop()
                return
            if self.end_formatting(tag):
                return
        elif top is not None and top.tag == tag:
            self.pop()
            return
        if not self.open_at[tag]:
            return
        place = self.open_at[tag][-1]
        if tag in TABLE_PARTS or tag == "table":
            stop = self.innermost(_TABLE)
        elif tag in BLOCKS:
            stop = self.innermost(SCOPES)
        else:
            stop = self.special_at[-1] if self.special_at else -1
        if stop <= place:
            self.close_down_to(place)

    def build(self, html: str) -> _Node:
        pos, size, search = 0, len(html), _MARKUP.search
        while pos < size:
            at = html.find("<", pos)
            stop = html.find(">", at) + 1 if at >= 0 else 0
            raw = html[at:stop] if 0 < stop - at <= LONGEST_NOTED else ""
            token = _NOTED.get(raw)
            if token is not None:
                if at > pos:
                    self.text(html[pos:at])
                pos = stop
                end, tag, attrs, rule = token
            else:
                m = search(html, pos)
                if m is None:
                    self.text(html[pos:])
                    break
                if m.start() > pos:
                    self.text(html[pos : m.start()])
                pos = m.end()
                comment, end, tag, source, closed = m.groups()
                if tag is None:
                    if self.comments and comment is not None:
                        self.put(_Node(None, comment))
                    continue
                if not closed:
                    break
                tag = tag.lower()
                rule = _rule(tag)
                attrs = _attributes(source) if source and not end else NO_ATTRIBUTES
                if raw and pos == stop and _REPEATED.fullmatch(raw):
                    if len(_NOTED) >= MOST_NOTED:
                        _NOTED.clear()
                    _NOTED[raw] = bool(end), tag, attrs, rule
            if end:
                self.end(tag, rule)
                continue
            self.start(tag, attrs, rule)
            if tag == "pre" and html.startswith("\n", pos):
                pos += 1
            if rule.raw:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, pos)
                stop = close.start() if close else size
                if stop > pos:
                    self.put(html[pos:stop])
                pos = stop
        return self.root


def page_elements(html: str, url: str, request: NodeRequest) -> Iterator[tuple]:
    """Requested elements of one page, in closing order. The page is read before the first row comes."""
    return _Page(request, url).walk(_Builder(bool(request.inner_html)).build(html))


_DECLARED = re.compile(rb"<meta[^>]+charset\s*=\s*[\"']?\s*([a-zA-Z0-9_-]+)", re.I)
_MARKS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))


def decode(page: bytes, charset: str | None = None) -> str:
    """Markup as text: by byte order mark, given or declared charset, UTF-8, else windows-1252.

    Browsers read the Latin-1 names as windows-1252; bytes without a meaning
    there become replacement characters, so every page can be read.
    """
    for mark, name in _MARKS:
        if page.startswith(mark):
            return page[len(mark) :].decode(name, "replace")
    declared = _DECLARED.search(page, 0, 2048)
    for name in (charset, declared and declared[1].decode(), "utf-8"):
        if name:
            name = "cp1252" if name.lower() in ("iso-8859-1", "latin1", "latin-1", "us-ascii", "ascii") else name
            try:
                return page.decode(name)
            except (LookupError, UnicodeDecodeError, ValueError):
                continue
    return page.decode("cp1252", "replace")
