"""What keeps the work of a query in proportion to its tables."""

import pytest
from pyspark.sql import functions as F

from pagegrain.checks import base, menus, products, relations, site_jobs, streams
from pagegrain.functions import htmlnodes
from pagegrain.operators import nodes as N
from pagegrain.plans import navigation

PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def write_part(spark, folder, keys):
    rows = [(k, f"n{k}", f"Brand#{k % 3}", f"t{k % 5}", k % 7, k / 4) for k in keys]
    spark.createDataFrame(rows, PART).coalesce(1).write.parquet(f"{folder}/part.parquet")
    return str(folder)


@pytest.mark.parametrize("pages", [
    lambda s, d: menus.part_pages(s, d, "raise", "<p>[[p_partkey]]</p>"),
    lambda s, d: base.dealt_parts(s, d)])
def test_small_files_are_dealt(spark, tmp_path, pages):
    folder = write_part(spark, tmp_path, range(5000))
    made = pages(spark, folder)
    assert made.count() == 5000
    tasks = made.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks >= min(2 * spark.sparkContext.defaultParallelism, 20)


def test_menus_are_read_once(spark):
    """No window reaches from every row to the page's end: that would be read again for each link."""
    page = '<div id="navigation"><ul class="menu-category x"><li class="shoes"><ul><li class="a"><span>Categories</span><ul>' + "".join(
        f'<li class="shoes-{i}"><b>x</b><a href="/{i}">n</a></li>' for i in range(50)) + "</ul></li></ul></li></ul></div>"
    pages = spark.createDataFrame([(1, "us", page)], "page_id int, country_code string, html string")
    found = navigation.tory_categories(pages)
    assert sorted(r["link"] for r in found.collect()) == sorted(f"/{i}" for i in range(50))
    assert "currentrow$(), unboundedfollowing$()" not in found._jdf.queryExecution().toString().lower()


def test_label_lists_are_bounded_by_sizes(spark):
    entries = spark.range(3000).select(
        F.lit("b").alias("p_brand"), (F.col("id") % 4).alias("p_size"), F.struct(F.col("id").alias("pos"), F.concat(F.lit("x"), "id").alias("label")).alias("e"))
    assert [(r["pos"], r["label"]) for r in relations.first_labels(entries).first()["l"]] == [(i, f"x{i}") for i in range(4)]


def test_selections_read_hits(spark):
    """Selections on marked pages give the same nodes as the tests on every node, and go through no node that fails them."""
    pages = ["", "plain", '<div class="a b"><p>x<b class="b">y</b></p><div class="b"><img src="1"><img class="b"></div></div><p class="b">z</p>', "<div><div class=b>" * 40 + "t"]
    given = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    tests = [N.Test("div"), N.Test("div", "class", "has", "b", path=True), N.Test("img"), N.Test("p", "class", "eq", "b", markup=True), N.Test(N.TEXT)]
    wanted = [[tests[1]], [tests[0], tests[1]], [tests[3], tests[2]], [N.Test("img", "src", "eq", "1")], [N.Test("b")], [N.Test(N.TEXT)]]

    def found(nodes, marked):
        docs = N.parse_nodes(given, tests, ["page_id"], marked=marked)
        chain = N.under(nodes, tests[1], tests[2])
        return docs.select("page_id", *[F.expr(f"transform({N.select(nodes, *w)}, n -> struct(n.pre, n.end, n.tag, n.path, n.outer))").alias(f"c{i}") for i, w in enumerate(wanted)],
                           F.expr(f"transform({chain}, n -> n.pre)").alias("chain")).orderBy("page_id").collect()

    assert found(N.tested(tests), True) == found(N.ALL, False)
    assert "filter(" not in N.select(N.tested(tests), tests[1])


def test_streamed_jobs_of_many_parts(spark, tmp_path):
    """Parts whose numbers are more than a day's seconds apart: the stream still tells the listed jobs of each listing."""
    folder = write_part(spark, tmp_path, [*range(20, 60), *range(200020, 200060)])
    key = lambda r: tuple(r)
    assert sorted(map(key, streams.l1_pentair(spark, folder).collect())) == sorted(map(key, site_jobs.k_pentair(spark, folder).collect()))


def test_streamed_events_land_in_many_files(spark, tmp_path, monkeypatch):
    """The files of a span of days grow with the events, and the first event of each key stays the same."""
    rows = spark.range(1200).select(
        F.col("id").alias("event_id"), F.expr("timestamp_seconds(1704067200 + (id * 7919 % 2591000)) AS ts").cast("timestamp_ntz"), (F.col("id") % 9).alias("user_id"),
        F.concat(F.lit("t"), F.col("id") % 2).alias("event_type"), F.lit(1.0).alias("value"), F.concat(F.lit("p"), "id").alias("props"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(streams, "PER_FILE", 50)
    roots = []
    monkeypatch.setattr(streams, "scratch_path", lambda s, label: roots.append(str(tmp_path / label)) or roots[-1])
    key = lambda r: (r["event_type"], r["user_id"], r["event_id"], r["props"])
    assert sorted(map(key, streams.l2_first(spark, str(tmp_path)).collect())) == sorted(map(key, relations.h1_first_seen(spark, str(tmp_path)).collect()))
    assert len(list((tmp_path / "first" / "in").glob("*.parquet"))) > 6 * 3


def test_streamed_products_open_few_stores(spark, tmp_path, monkeypatch):
    """A partition of the state has one store per operator, there are no more partitions than the pages need, and pages of all kinds arrive in every file."""
    folder, progress, wait = write_part(spark, tmp_path, range(500)), [], streams.L.wait
    monkeypatch.setattr(streams, "scratch_path", lambda s, label: str(tmp_path / label))
    monkeypatch.setattr(streams.L, "wait", lambda query: (wait(query), progress.extend(query.recentProgress)))
    got = streams.l1_products(spark, folder).where("item_kind = 'full'").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, products.k_tory(spark, folder).where("item_kind = 'full'").collect()))
    stores = [[o.numStateStoreInstances for o in p.stateOperators] for p in progress if p.stateOperators]
    assert stores and all(of_one == [2] * 9 for of_one in stores)
    kinds = spark.read.parquet(f"{tmp_path}/products/all").where("page_type <> 'listing'").groupBy(F.input_file_name()).agg(F.count_distinct("page_type").alias("n")).collect()
    assert [r["n"] for r in kinds] == [4, 4]


def test_tags_are_read_once(monkeypatch):
    """What a start tag says is found once, however many pages show it; a page's own tags are read as they come."""
    read, attributes = [], htmlnodes.attributes
    monkeypatch.setattr(htmlnodes, "attributes", lambda source: read.append(source) or attributes(source))
    wanted = htmlnodes.wanted_by([("a", "class", "eq", "x", False, False), ("p", None, "eq", "", False, False)], marked=True)
    for i in range(50):
        page = htmlnodes.PageNodes(f"<p class=k><a class=x>1</a><a class=y>2</a><a class=x href={i}>3</a></p>", wanted)
        assert [n[4] for n in page.nodes] == ["p", "a", "a"] and page.hits == [[1, 2], [0]] and page.nodes[2][7] == {"class": "x", "href": str(i)}
        assert page.html == f'<p class="k"><a class="x">1</a><a class="y">2</a><a class="x" href="{i}">3</a></p>'
    assert len(read) == 3 + 50
    path = htmlnodes.wanted_by([("a", "@path", "eq", "/p/a", False, False)])
    assert [len(htmlnodes.PageNodes("<a>1</a><p><a>2</a>", path).nodes) for _ in range(2)] == [1, 1]


def test_tags_of_pages_are_forgotten(monkeypatch):
    monkeypatch.setattr(htmlnodes, "TAGS", 10)
    wanted = htmlnodes.wanted_by([("a", None, "eq", "", False, False)])
    for i in range(30):
        assert htmlnodes.PageNodes(f"<a href={i}><a title={'x' * 400}>", wanted).nodes[0][7] == {"href": str(i)}
    assert len(wanted.seen) <= 10


def test_selections_without_ancestors_look_at_no_node(spark):
    """Pages of another layout cost nothing: where nothing encloses, no node is compared."""
    docs = N.parse_nodes(spark.createDataFrame([(1, "<p>x</p>")], "page_id int, html string"), [N.Test("div"), N.Test("p"), N.Test(N.TEXT)], ["page_id"])
    none, loud = N.select(N.ALL, N.Test("div")), N.Nodes("transform(nodes, n -> if(n.pre > 0, raise_error('looked at'), n))")
    row = docs.select(N.descendants(none, loud).col.alias("below"), N.children(none, loud).col.alias("kids"),
                      N.values(N.children(N.select(N.ALL, N.Test("p")), N.select(N.ALL, N.Test(N.TEXT)))).alias("texts")).first()
    assert row == ([], [], ["x"])
