"""Pages to node lists, and selections on them.

``parse_nodes`` keeps one row per page with the wanted nodes in an array. A page's nodes never leave its row
until they are exploded, so child, descendant and positional selections are array expressions inside the scan
stage and need no shuffle, however the pages are spread over sites.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagegrain.functions import htmlnodes
from pagegrain.schemas import NODE

TEXT = "#text"
# the parse step travels with its tasks: executors need no installed copy of this package
cloudpickle.register_pickle_by_value(htmlnodes)


@dataclass(frozen=True)
class Test:
    """A node test. ``attr`` None tests the tag alone; ``@path`` tests the tag path from the page root.

    Nodes have a ``path`` only where a test of their tag reads it or asks for it with ``path``: a page that nests deeply has long ones.
    """

    tag: str
    attr: str | None = None
    op: str = "eq"
    value: str = ""
    markup: bool = False
    path: bool = False

    @property
    def spec(self) -> htmlnodes.Spec:
        return (self.tag, self.attr, self.op, self.value, self.markup, self.path)

    def sql(self, node: str) -> str:
        """The same test as SQL on a node struct."""
        same_tag = f"{node}.tag = {literal(self.tag)}"
        if self.attr is None:
            return same_tag
        actual = f"{node}.path" if self.attr == "@path" else f"try_element_at({node}.attrs, {literal(self.attr)})"
        return f"({same_tag} AND coalesce({attr_pred(actual, self.op, self.value)}, false))"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def attr_pred(actual: str, op: str, value: str) -> str:
    """Attribute or text predicate in SQL: equality, prefix, suffix or substring."""
    forms = {"eq": "{0} = {1}", "starts": "startswith({0}, {1})", "ends": "endswith({0}, {1})", "has": "contains({0}, {1})"}
    return forms[op].format(actual, literal(value))


def tags(*names: str) -> list[Test]:
    return [Test(n) for n in names]


def parse_nodes(pages: DataFrame, tests: Iterable[Test] | dict[str, Iterable[Test]], keep: Iterable[str],
                html: str = "html", with_html: bool = False, marked: bool = False) -> DataFrame:
    """``keep`` columns plus ``nodes`` (and ``norm_html`` when asked), one row per page.

    With ``marked`` there is also ``hits``: per test, the places in ``nodes`` of the nodes that pass it. Selections on ``tested(tests)`` read them
    instead of going through all nodes once per test.

    Only nodes that pass a test are returned: the test list is the projection that keeps the stage narrow.
    With a dictionary the tests depend on the page's ``site``.
    """
    keep = list(keep)
    by_site = isinstance(tests, dict)
    sent = list(dict.fromkeys(keep + (["site"] if by_site else [])))
    source = pages.select(*sent, F.col(html).alias("__html"))
    schema = T.StructType([source.schema[c] for c in keep]).add("nodes", T.ArrayType(NODE))
    if marked:
        schema = schema.add("hits", T.ArrayType(T.ArrayType(T.IntegerType())))
    if with_html:
        schema = schema.add("norm_html", T.StringType())
    specs = {k: [t.spec for t in v] for k, v in tests.items()} if by_site else [t.spec for t in tests]
    return source.mapInArrow(htmlnodes.batch_parser(specs, keep, with_html, marked=marked), schema)


class Nodes(str):
    """SQL text of a node list. Selections nest lambdas several deep; as text they cost one call to build."""

    #: Places of tests in the column ``hits``, for all nodes of a page that was parsed with ``marked``.
    places: dict[tuple, int] = {}

    @property
    def col(self) -> Column:
        return F.expr(self)


ALL = Nodes("nodes")


def tested(tests: Iterable[Test]) -> Nodes:
    """All nodes of pages that were parsed with these tests, ``marked``."""
    nodes = Nodes("nodes")
    nodes.places = {t.spec[:4]: i for i, t in enumerate(tests)}
    return nodes


def let(value: str, name: str, body: str) -> str:
    """Evaluate ``value`` once and use it as ``name`` in nested lambdas."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def select(nodes: Nodes, *tests: Test) -> Nodes:
    """Nodes that pass any of the tests, each once, in document order."""
    found = [nodes.places[t.spec[:4]] for t in tests if t.spec[:4] in nodes.places]
    if nodes.places and len(found) == len(tests):
        hits = [f"get(hits, {i})" for i in found]
        at = hits[0] if len(hits) == 1 else f"array_sort(array_distinct(concat({', '.join(hits)})))"
        return Nodes(f"transform({at}, h -> get(nodes, h))")
    if len(tests) == 1 and (tests[0].tag, None, "eq", "") in nodes.places:
        nodes = select(nodes, Test(tests[0].tag))
    return Nodes(f"filter({nodes}, n -> {' OR '.join(t.sql('n') for t in tests)})")


def where(nodes: Nodes, condition: str) -> Nodes:
    """Nodes ``n`` for which a SQL condition holds."""
    return Nodes(f"filter({nodes}, n -> {condition})")


#: Ancestors up to which each node is compared with all of them.
FEW = 16


def descendants(ancestors: Nodes, nodes: Nodes) -> Nodes:
    """The nodes that lie inside one of the ancestors (interval test, each node once).

    Many ancestors are merged with the nodes: in the order of their numbers, a node lies inside one if the largest end of the ancestors
    before it reaches it. Running maxima are taken by blocks of about the square root of the entries. Without ancestors the nodes are not looked at.
    """
    inside = "filter(below, d -> exists(up, a -> d.pre > a.pre AND d.pre <= a.end))"
    marks = ("array_sort(concat(transform(up, a -> struct(a.pre AS p, 1 AS k, a.end AS e, 0 AS i)), "
             "transform(below, (d, i) -> struct(d.pre AS p, 0 AS k, 0 AS e, i AS i))))")
    reached = "greatest(get(before, j div s), array_max(slice(ends, (j div s) * s + 1, j % s + 1)))"
    found = f"filter(marks, (m, j) -> m.k = 0 AND {reached} >= m.p)"
    picked = f"transform(array_sort(transform({found}, m -> m.i)), i -> get(below, i))"
    blocks = "transform(sequence(0, (size(ends) - 1) div s), b -> array_max(slice(ends, b * s + 1, s)))"
    merged = let(marks, "marks", let("transform(marks, m -> m.e)", "ends", let("CAST(ceil(sqrt(size(ends))) AS INT)", "s", let(
        blocks, "tops", let("transform(tops, (x, b) -> array_max(slice(tops, 1, b)))", "before", picked)))))
    met = let(nodes, "below", f"if(size(up) <= {FEW} OR size(below) = 0, {inside}, {merged})")
    return Nodes(let(ancestors, "up", f"if(size(up) = 0, up, {met})"))


def children(parents: Nodes, nodes: Nodes) -> Nodes:
    """The nodes whose parent is one of ``parents``; without parents the nodes are not looked at."""
    inside = let("transform(over, a -> a.pre)", "up", f"filter({nodes}, d -> array_contains(up, d.parent))")
    return Nodes(let(parents, "over", f"if(size(over) = 0, over, {inside})"))


def nth_child(nodes: Nodes, tag: str, n: int) -> Nodes:
    """The n-th (from 1) among its siblings of the same tag."""
    return where(nodes, f"n.tag = {literal(tag)} AND n.nth = {n}")


def part(nodes: Nodes, start: int, count: int = 1) -> Nodes:
    """Slice of a node list, from 1."""
    return Nodes(f"slice({nodes}, {start}, {count})")


def values(nodes: Nodes, attr: str | None = None) -> Column:
    """Attribute values, or texts, in document order; nodes without one are left out."""
    picked = "n.text" if attr is None else f"try_element_at(n.attrs, {literal(attr)})"
    return F.expr(f"filter(transform({nodes}, n -> {picked}), v -> v IS NOT NULL)")


def count(nodes: Nodes) -> Column:
    return F.expr(f"size({nodes})")


def under(nodes: Nodes, *path: Test) -> Nodes:
    """Descendant chain: the nodes of the last test below those of the one before, and so on."""
    current = select(nodes, path[0])
    for t in path[1:]:
        current = descendants(current, select(nodes, t))
    return current


def texts_under(nodes: Nodes, *path: Test) -> Column:
    """All text nodes below the end of a descendant chain."""
    return values(descendants(under(nodes, *path), select(nodes, Test(TEXT))))


def own_texts(nodes: Nodes, *path: Test) -> Column:
    """Text nodes that are children of the end of a descendant chain."""
    return values(children(under(nodes, *path), select(nodes, Test(TEXT))))


def explode_nodes(docs: DataFrame) -> DataFrame:
    """Node table: one row per node."""
    rest = [c for c in docs.columns if c != "nodes"]
    return docs.select(*rest, F.explode("nodes").alias("node")).select(*rest, "node.*")


def pick(arr: Column, i: int) -> Column:
    """List element; negative positions count from the end; null when out of range."""
    return F.get(arr, F.lit(i)) if i >= 0 else F.try_element_at(arr, F.lit(i))


def zip_explode(df: DataFrame, **lists: str | Column) -> DataFrame:
    """Parallel lists to rows by position (``pos`` from 0); a shorter list gives nulls."""
    named = [(F.col(c) if isinstance(c, str) else c).alias(k) for k, c in lists.items()]
    base = df.select("*", F.struct(*named).alias("__lists"))
    zipped = F.arrays_zip(*[F.col("__lists." + k).alias(k) for k in lists])
    out = base.select(*df.columns, F.posexplode(zipped).alias("pos", "__item"))
    return out.select(*df.columns, "pos", *[F.col("__item")[k].alias(k) for k in lists])


def simple_blocks(df: DataFrame, tag: str, html: str = "html") -> DataFrame:
    """Blocks of a tag that does not nest, straight from the markup: no Python stage.

    Rows: the other columns, ``pos`` and ``block``.
    """
    rest = [c for c in df.columns if c != html]
    pattern = f"(?is)<{tag}[\\s>].*?</{tag}>"
    return df.select(*rest, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(0)))
                     .alias("pos", "block"))
