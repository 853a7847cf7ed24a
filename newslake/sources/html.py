"""The one per-row Python helper: a small element tree and CSS-like matching for irregular HTML.

Only what extraction rules need: tags, ``.class``, ``#id``, ``[attr="v"]`` (also ``^=`` and ``*=``),
descendant and child combinators, comma lists, and `` >> `` to search on inside the first match.
"""

import contextlib
import re
from bisect import bisect_right
from html.parser import HTMLParser

# Elements without an end tag, and elements whose text is not page text.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
NOT_TEXT = frozenset("script style template rt rp".split())


class Node:
    """``place`` numbers the elements of a page in document order; descendants are those up to ``last``."""

    __slots__ = ("tag", "attrs", "parent", "children", "place", "last", "index")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []


class Index:
    """The elements of a page by tag, class and id, each list in document order; made in one walk."""

    def __init__(self, root):
        self.all, self.named = [], {}
        stack = [(root, iter(root.children))]
        root.place, root.index = 0, self
        while stack:
            node, children = stack[-1]
            child = next((c for c in children if not isinstance(c, str)), None)
            if child is None:
                node.last = len(self.all)
                stack.pop()
                continue
            self.all.append(child)
            child.place, child.index = len(self.all), self
            names = [("tag", child.tag), ("id", child.attrs.get("id"))]
            for name in names + [("cls", c) for c in set(child.attrs.get("class", "").split())]:
                self.named.setdefault(name, []).append(child)
            stack.append((child, iter(child.children)))

    def below(self, node, tests):
        """Descendants of ``node`` that may pass ``tests``: the shortest of the lists that the tests name."""
        pools = [self.named.get((op, value), []) for _, op, value in tests if op in ("tag", "cls", "id")]
        pool = min(pools, key=len) if pools else self.all
        first = bisect_right(pool, node.place, key=_place)
        return pool[first:bisect_right(pool, node.last, key=_place)]


def _place(node):
    return node.place


class _TreeBuilder(HTMLParser):
    """Start tags nest, an end tag closes up to its nearest open namesake, a stray one is ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("", {}, None)
        self.text = []

    def flush(self):
        if self.text:
            self.here.children.append("".join(self.text))
            self.text = []

    def handle_data(self, data):
        self.text.append(data)

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_starttag(self, tag, attrs):
        self.flush()
        node = Node(tag, {name: value or "" for name, value in attrs}, self.here)
        self.here.children.append(node)
        if tag not in VOID:
            self.here = node

    def handle_endtag(self, tag):
        self.flush()
        node = self.here
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.here = node.parent


def parse(html):
    builder = _TreeBuilder()
    builder.feed(html)
    builder.close()
    builder.flush()
    Index(builder.root)
    return builder.root


@contextlib.contextmanager
def parsed(html):
    """The tree of a page, taken apart at the end: its elements name one another, so they would else stay, with their texts,
    until the next full round of the garbage collector."""
    root = parse(html)
    try:
        yield root
    finally:
        for node in (root, *root.index.all):
            node.parent, node.children, node.index = None, (), None


def walk(node, skip=()):
    """Descendant elements and text in document order, without recursion and without ``skip``."""
    stack = [iter(node.children)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif isinstance(child, str):
            yield child
        elif child not in skip:
            yield child
            stack.append(iter(child.children))


def hidden_below(node):
    """Descendants whose text is not page text."""
    return {n for tag in NOT_TEXT for n in node.index.below(node, [("tag", "tag", tag)])}


def strings(node, skip=()):
    """Text nodes of ``node``, each stripped, empty ones left out."""
    hidden = set(skip)
    if node.tag not in NOT_TEXT:
        hidden |= hidden_below(node)
    return [s for s in (t.strip() for t in walk(node, hidden) if isinstance(t, str)) if s]


_PIECE = re.compile(
    r'(?P<child>\s*>\s*)|(?P<space>\s+)|\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)'
    r'|\[(?P<attr>[\w-]+)(?P<op>[\^*]?=)"(?P<value>[^"]*)"\]|(?P<tag>[\w-]+)'
)
_compiled = {}


def _compile(selector):
    """``selector`` as a list of chains; a chain is [(is_child_of_previous, tests), ...]."""
    if selector not in _compiled:
        chains = []
        for part in selector.split(","):
            chain = [(False, [])]
            for m in _PIECE.finditer(part.strip()):
                kind = m.lastgroup
                if kind in ("child", "space"):
                    chain.append((kind == "child", []))
                elif kind == "value":
                    chain[-1][1].append((m["attr"], m["op"], m["value"]))
                else:
                    chain[-1][1].append((kind, kind, m[kind]))
            chains.append(chain)
        _compiled[selector] = chains
    return _compiled[selector]


def _passes(node, tests):
    for name, op, wanted in tests:
        if op == "tag":
            ok = node.tag == wanted
        elif op == "cls":
            ok = wanted in node.attrs.get("class", "").split()
        else:
            value = node.attrs.get(name)
            if value is not None and name == "class" and op == "=":
                value = " ".join(value.split())
            ok = value is not None and (
                value == wanted if op in ("=", "id")
                else value.startswith(wanted) if op == "^=" else wanted in value
            )
        if not ok:
            return False
    return True


def _fits(node, chain):
    """Does ``node`` end a path that fits ``chain``?"""
    candidates, (is_child, tests) = [node], chain[-1]
    if not _passes(node, tests):
        return False
    for step in range(len(chain) - 2, -1, -1):
        found = []
        for c in candidates:
            up = c.parent
            while up is not None:
                if _passes(up, chain[step][1]) and up.tag and up not in found:
                    found.append(up)
                if is_child:
                    break
                up = up.parent
        if not found:
            return False
        candidates, is_child = found, chain[step][0]
    return True


def select(node, selector):
    """Descendants of ``node`` that match, in document order."""
    scope, _, rest = selector.partition(" >> ")
    found = {}
    for chain in _compile(scope):
        for candidate in node.index.below(node, chain[-1][1]):
            if candidate.place not in found and _fits(candidate, chain):
                found[candidate.place] = candidate
    hits = [found[place] for place in sorted(found)]
    if not rest:
        return hits
    return select(hits[0], rest) if hits else []


def select_one(node, selector):
    return next(iter(select(node, selector)), None)
