"""One page of HTML to the nodes the caller asked for: the only per-page Python step.

Tags and attribute names come out lower case, attributes double-quoted, text escaped, void tags without an
end tag. Elements whose end tag may be left out are closed by their successor; an end tag nobody opened is
dropped. Nodes are numbered in document order, so the nodes inside a node are ``pre < x <= end``.
"""

from __future__ import annotations

import re
from html import escape, unescape

import pyarrow as pa

# fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(["script", "style"])
BLOCK = frozenset(
    "address article aside blockquote center div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu "
    "nav ol p pre section table ul".split()
)
CELL_SCOPE = frozenset(["table", "td", "th"])
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th body html".split())
# start tag: (open elements it closes, elements that end the search)
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "table"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["table"])),
    "th": (frozenset(["td", "th"]), frozenset(["table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
}
PARAGRAPH = (frozenset(["p"]), frozenset(["table", "td", "th", "caption", "button", "object"]))

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.S,
)
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)


def attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in ATTR.findall(source):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def attr_text(value: str) -> str:
    return escape(value, quote=False).replace('"', "&quot;")


RAW_END = {name: re.compile("</" + name, re.I) for name in RAW}
#: Tags that a parser remembers, and the characters of the longest one.
TAGS, TAG_LENGTH = 20_000, 300


class Tag:
    """What a tag's text says, wherever it stands: start tags by name, attributes, markup and the tests they pass."""

    __slots__ = ("name", "end", "source", "attrs", "markup", "tested", "known", "keep", "passed", "closes", "void")

    def __init__(self, name: str, end: bool, source: str, wanted, tags: frozenset | None):
        self.name, self.end, self.source, self.markup = name, end, source, None
        self.tested = not end and (tags is None or name in tags)
        #: the tests do not ask where the tag stands
        self.known = not self.tested or getattr(wanted, "by_tag", False)
        self.attrs = (attributes(source) if source else {}) if self.tested else None
        self.keep = wanted(name, self.attrs, None) if self.tested and self.known else 0
        self.passed = wanted.passed if self.keep and getattr(wanted, "tests", 0) else ()
        self.closes = CLOSES.get(name) or (PARAGRAPH if name in BLOCK else None)
        self.void = name in VOID

    def written(self) -> str:
        if self.markup is None:
            if self.attrs is None:
                self.attrs = attributes(self.source) if self.source else {}
            self.markup = "<" + self.name + "".join([f' {k}="{attr_text(v)}"' for k, v in self.attrs.items()]) + ">"
        return self.markup


class PageNodes:
    """Nodes of one page that pass ``wanted(tag, attrs, path)``: 0 skips, 1 keeps, 2 keeps with its markup.

    ``wanted.tags``, where there is one, names the tags it may keep: attributes of other tags are not read. ``wanted.paths`` names those whose
    tag path is read; other nodes have none. ``hits`` has, per test, the places in ``nodes`` of the nodes that pass it (``wanted.passed``). Markup is written only while a node that keeps it is open, or for the whole page with ``with_html``.
    ``wanted.seen``, where there is one, holds what was found of the tags of earlier pages (``wanted.by_tag``: their places do not matter).

    Time and memory grow with the page, however deep it is nested: an open element knows its name and its parent's number, and where
    the innermost open element of a name stands is known by name.
    """

    def __init__(self, html: str, wanted, with_html: bool = True):
        self.wanted, self.tags, self.paths = wanted, getattr(wanted, "tags", None), getattr(wanted, "paths", None)
        self.writing = int(with_html)
        self.out: list[str] = []
        self.nodes: list[list] = []
        self.hits: list[list[int]] = [[] for _ in range(getattr(wanted, "tests", 0))]
        self.pre = 0
        # open elements: tag, pre, child counts, start in out, kept node, keep its markup
        self.open: list[tuple] = [("", 0, {}, 0, None, False)]
        #: places in ``open`` of the open elements of a name
        self.places: dict[str, list[int]] = {}
        seen = getattr(wanted, "seen", None)
        seen = {} if seen is None else seen
        # a text has no attributes: what passes is the same for all
        self.text = seen.get("#text") or seen.setdefault("#text", Tag("#text", False, "", wanted, self.tags))
        self._read(html, seen)
        self._close_to(1)

    def _read(self, html: str, seen: dict[str, Tag]) -> None:
        # one loop with names of its own: a page has thousands of tags, and a call costs as much as what is done for one
        wanted, tags, paths, places, opened, nodes, hits, out = (
            self.wanted, self.tags, self.paths, self.places, self.open, self.nodes, self.hits, self.out)
        text, cells = self._text, False
        # no tag ends after the last bracket
        pos, end, limit = 0, len(html), html.rfind(">") + 1
        while pos < limit:
            for token in TOKEN.finditer(html, pos, limit):
                start, stop = token.span()
                if start > pos:
                    text(html[pos:start])
                pos = stop
                whole = token[0]
                tag = seen.get(whole)
                if tag is None:
                    slash, name, source = token.groups()
                    if name is None:
                        if whole.startswith("<!--") and not whole.endswith("-->"):
                            return
                        continue
                    tag = Tag(name.lower(), bool(slash), source, wanted, tags)
                    if len(whole) <= TAG_LENGTH:
                        if len(seen) >= TAGS:
                            seen.clear()
                        seen[whole] = tag
                name = tag.name
                if tag.end:
                    at = places.get(name)
                    if at and (name in TABLE_PARTS or not cells or at[-1] >= self._innermost(CELL_SCOPE)):
                        self._close_to(at[-1])
                    continue
                if tag.closes is not None:
                    self._close_first(*tag.closes)
                parent, level = opened[-1], len(opened)
                self.pre = pre = self.pre + 1
                nth = parent[2][name] = parent[2].get(name, 0) + 1
                keep, passed, node = tag.keep, tag.passed, None
                if tag.tested and (keep or not tag.known):
                    path = self._path(name, name) if paths is None or name in paths else None
                    if not tag.known:
                        keep = wanted(name, tag.attrs, path)
                        passed = wanted.passed if hits and keep else ()
                    if keep:
                        for test in passed:
                            hits[test].append(len(nodes))
                        node = [pre, pre, parent[1], level, name, nth, path, tag.attrs, None, None]
                        nodes.append(node)
                begin = len(out)
                if self.writing or keep == 2:
                    out.append(tag.written())
                if tag.void:
                    if keep == 2:
                        node[9] = out[-1] if self.writing else out.pop()
                    continue
                if keep == 2:
                    self.writing += 1
                at = places.get(name)
                if at is None:
                    places[name] = [level]
                    cells = cells or name in CELL_SCOPE
                else:
                    at.append(level)
                opened.append((name, pre, {}, begin, node, keep == 2))
                if name in RAW:
                    found = RAW_END[name].search(html, pos)
                    stop = found.start() if found else end
                    text(html[pos:stop], raw=True)
                    pos = stop
                    break
            else:
                break
        if pos < end:
            text(html[pos:].partition("<!--")[0])

    def _path(self, tag: str, name: str) -> str | None:
        """The names of the open elements and ``name``, where a test reads them."""
        if self.paths is not None and tag not in self.paths:
            return None
        return "/".join([e[0] for e in self.open] + [name])

    def _text(self, data: str, raw: bool = False) -> None:
        if not raw and "&" in data:
            data = unescape(data)
        if not data:
            return
        self.pre = pre = self.pre + 1
        parent, tag = self.open[-1], self.text
        if (node := parent[4]) is not None:
            if node[8] is None:
                node[8] = [data]
            else:
                node[8].append(data)
        if tag.tested and (tag.keep or not tag.known):
            path = self._path("#text", "text()") if self.paths is None or "#text" in self.paths else None
            if tag.known or self.wanted("#text", {}, path):
                if self.hits:
                    for test in tag.passed if tag.known else self.wanted.passed:
                        self.hits[test].append(len(self.nodes))
                self.nodes.append([pre, pre, parent[1], len(self.open), "#text", 1, path, {}, data, None])
        if self.writing:
            self.out.append(data if raw or not ("&" in data or "<" in data or ">" in data) else escape(data, quote=False))

    def _innermost(self, names: frozenset) -> int:
        """Place of the innermost open element of these names; 0 without one."""
        best, places = 0, self.places
        for name in names:
            at = places.get(name)
            if at and at[-1] > best:
                best = at[-1]
        return best

    def _close_first(self, closers: frozenset, barrier: frozenset) -> None:
        at = self._innermost(closers)
        if at and at > self._innermost(barrier):
            self._close_to(at)

    def _close_to(self, depth: int) -> None:
        opened, places, out = self.open, self.places, self.out
        while len(opened) > depth:
            tag, _, _, begin, node, markup = opened.pop()
            places[tag].pop()
            if self.writing:
                out.append("</" + tag + ">")
            if node is not None:
                node[1] = self.pre
                if node[8] is not None:
                    node[8] = "".join(node[8])
                if markup:
                    node[9] = "".join(out[begin:])
                    self.writing -= 1
                    if not self.writing:
                        out.clear()

    @property
    def html(self) -> str:
        return "".join(self.out)


# a node test as plain values: tag, attribute (None: any; "@path": the tag path), operation, value, with markup, with the tag path
Spec = tuple[str, str | None, str, str, bool, bool]


def passes(spec: Spec, attrs: dict[str, str], path: str | None) -> bool:
    _, attr, op, value = spec[:4]
    if attr is None:
        return True
    actual = path if attr == "@path" else attrs.get(attr)
    if actual is None:
        return False
    if op == "eq":
        return actual == value
    if op == "starts":
        return actual.startswith(value)
    return actual.endswith(value) if op == "ends" else value in actual


def wanted_by(specs: list[Spec], marked: bool = False):
    """The ``wanted`` function of a list of node tests; ``marked``: it tells in ``wanted.passed`` which tests the last node passed."""
    by_tag: dict[str, list[tuple[int, Spec]]] = {}
    for i, spec in enumerate(specs):
        by_tag.setdefault(spec[0], []).append((i, spec))

    def wanted(tag: str, attrs: dict[str, str], path: str) -> int:
        best = 0
        for _, spec in by_tag.get(tag, ()):
            if best < 2 and passes(spec, attrs, path):
                best = 2 if spec[4] else 1
        return best

    def wanted_marked(tag: str, attrs: dict[str, str], path: str) -> int:
        passed = wanted_marked.passed = [i for i, spec in by_tag.get(tag, ()) if passes(spec, attrs, path)]
        return max((2 if specs[i][4] else 1 for i in passed), default=0)

    if marked:
        wanted, wanted_marked.tests = wanted_marked, len(specs)
    wanted.tags = frozenset(by_tag)
    wanted.paths = frozenset(spec[0] for spec in specs if spec[1] == "@path" or any(spec[5:]))
    wanted.by_tag = all(spec[1] != "@path" for spec in specs)
    wanted.seen = {}
    return wanted


NODE_ARROW = [
    pa.field("pre", pa.int32()), pa.field("end", pa.int32()), pa.field("parent", pa.int32()),
    pa.field("level", pa.int32()), pa.field("tag", pa.string()), pa.field("nth", pa.int32()),
    pa.field("path", pa.string()), pa.field("attrs", pa.map_(pa.string(), pa.string())),
    pa.field("text", pa.string()), pa.field("outer", pa.string()),
]


def attr_column(found: tuple[dict[str, str], ...]) -> pa.Array:
    """Attributes of nodes as one map column."""
    offsets, total = [0], 0
    for attrs in found:
        total += len(attrs)
        offsets.append(total)
    keys, values = [k for attrs in found for k in attrs], [v for attrs in found for v in attrs.values()]
    return pa.MapArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string()))


def node_column(parsed: list[list[list]]) -> pa.Array:
    """Node lists of a batch of pages as one list-of-struct column."""
    offsets, total = [0], 0
    for page in parsed:
        total += len(page)
        offsets.append(total)
    columns = list(zip(*(node for page in parsed for node in page))) or [()] * len(NODE_ARROW)
    fields = [attr_column(values) if field.name == "attrs" else pa.array(values, type=field.type) for field, values in zip(NODE_ARROW, columns)]
    struct = pa.StructArray.from_arrays(fields, fields=NODE_ARROW)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)


def hit_column(parsed: list[list[list[int]]]) -> pa.Array:
    """Hit lists of a batch of pages as one list-of-lists column."""
    lists = [hits for page in parsed for hits in page]
    outer, inner = [0], [0]
    for page in parsed:
        outer.append(outer[-1] + len(page))
    for hits in lists:
        inner.append(inner[-1] + len(hits))
    flat = pa.array([at for hits in lists for at in hits], pa.int32())
    return pa.ListArray.from_arrays(pa.array(outer, pa.int32()), pa.ListArray.from_arrays(pa.array(inner, pa.int32()), flat))


def batch_parser(specs: list[Spec] | dict[str, list[Spec]], keep: list[str], with_html: bool, step: int = 32, marked: bool = False):
    """Function over record batches for ``mapInArrow``; a few pages at a time, so that memory stays flat."""

    def run(batches):
        per_site = {s: wanted_by(v) for s, v in specs.items()} if isinstance(specs, dict) else None
        common = wanted_by(specs if per_site is None else [], marked)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                column = {name: part.column(i) for i, name in enumerate(part.schema.names)}
                sites = column["site"].to_pylist() if per_site is not None else None
                done = [
                    PageNodes(text or "", common if sites is None else per_site.get(sites[i], common), with_html)
                    for i, text in enumerate(column["__html"].to_pylist())
                ]
                out = {name: column[name] for name in keep}
                out["nodes"] = node_column([d.nodes for d in done])
                if marked:
                    out["hits"] = hit_column([d.hits for d in done])
                if with_html:
                    out["norm_html"] = pa.array([d.html for d in done], pa.string())
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return run
