"""From the pages a crawl has to the pages it wants next: start requests, menus, overviews and pagers of each
site, as tables. Everything is a narrow transform of the page table but the country lookups, whose dimensions
are fixed lists of the job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from pagegrain.functions import text as X
from pagegrain.functions.catalog import subcat_label
from pagegrain.functions.markup import script_var
from pagegrain.functions.urls import absolute_url, country_from_url, listing_page_url
from pagegrain.operators import filters as E
from pagegrain.operators import frontier as B
from pagegrain.operators import nodes as N
from pagegrain.operators.joins import delivery_regions, with_dims
from pagegrain.operators.quality import reject_rows
from pagegrain.plans import intermix, tory, vitamins
from pagegrain.plans.offer_rules import RULES

T_ = N.Test
# Pager selectors and rules, menu selectors, url bases.
PAGERS = {
    "cardsnagger": ([T_("ul", "class", "eq", "PagingList"), T_("li"), T_("a")], None, "last",
                    "http://buy.cardsnagger.com/buy/?sort=alphaasc&page="),
    "raise": ([T_("nav", "class", "eq", "pagination pagination-centered"), T_("li"), T_("a")], None, "first",
              "https://www.raise.com/buy-gift-cards?page="),
    "pandacashback": ([T_("div", "class", "eq", "pagination"), T_("a")], "href", "page=", "http://www.pandacashback.com/"),
    "rebategiant": ([T_("div", "class", "eq", "pages"), T_("a")], "href", "pg=", "http://www.rebategiant.com"),
}
TOP_PAGER, TOP_BASE = T_("div", "class", "eq", "pagination-nav-comments", markup=True), "http://www.topcashback.com"
GRANNY_CELLS, GRANNY_BASE = [T_("div", "class", "eq", "content"), T_("tr"), T_("td")], "http://www.giftcardgranny.com"
MENU_BOX, MENU = T_("div", "class", "eq", "leftCategoryNavContainer"), T_("ul", "class", "eq", "sf-menu")
LOOKS, LOOK_ACTION = T_("div", "id", "starts", "DirectoryViewWrapper"), T_("div", "class", "eq", "dirAction")
LOOK_ALL, LOOK_NAME = T_("div", "id", "starts", "viewAll"), T_("div", "class", "eq", "productSubCategoryName")
LOOK_URL = "http://www.intermixonline.com/trendlooksandproducts.do?subCategoryId="
MASTER, REPORT = T_("div", "id", "eq", "master"), T_("div", "id", "starts", "STR")
DIRECTORY, DIRECTORY_ITEM = T_("div", "id", "eq", "nDiv"), T_("div", "class", "starts", "directoryProduct")
NAVIGATION, CATEGORY_MENU = T_("div", "id", "eq", "navigation"), T_("ul", "class", "starts", "menu-category")
JP_NAV, JP_PAGER = T_("div", "id", "eq", "gNav"), T_("div", "class", "eq", "pagerArea")
JP_PAGES = T_("ul", "class", "starts", "pageList")
FLAG = T_("div", "class", "eq", "flag-container")


def letter_seeds(spark: SparkSession) -> DataFrame:
    """One url per letter of the sites that list by letter: site, letter, url."""
    rows = [(r.site, *r.letters) for r in RULES if r.letters]
    return B.letter_urls(spark.createDataFrame(rows, "site string, base string, digit_token string, upper boolean"))


def pagers_of(pages: DataFrame, site: str) -> DataFrame:
    """The texts or links of one site's pagers: page_id, url, pager."""
    path, attr, _, _ = PAGERS[site]
    docs = N.parse_nodes(pages.where(F.col("site") == site), [*path, T_(N.TEXT)], ["page_id", "url"])
    if site == "raise":
        items = N.nth_child(N.under(N.ALL, *path[:2]), "li", 4)
        pager = N.values(N.children(N.children(items, N.select(N.ALL, path[2])), N.select(N.ALL, T_(N.TEXT))))
    else:
        pager = N.own_texts(N.ALL, *path) if attr is None else N.values(N.under(N.ALL, *path), attr)
    return docs.select("page_id", "url", pager.alias("pager"))


def unlikely_pagers(pages: DataFrame, site: str, most: int) -> DataFrame:
    """Pagers of a site that show more than ``most`` pages, with the number: page_id, url, stage, reason."""
    return B.page_rejects(pagers_of(pages, site), "page_id", "url", B.last_page(F.col("pager"), PAGERS[site][2]), most)


def numbered_pages(pages: DataFrame, site: str, most: int | None = None) -> DataFrame:
    """Listing urls 1..last of one site's pagers: page_id, page, url. The links of the two link pagers keep
    their own prefix up to the page number. Pagers above ``most`` are left to ``unlikely_pagers``."""
    _, attr, rule, base = PAGERS[site]
    staged = pagers_of(pages, site)
    prefix = F.lit(base)
    if attr is not None:
        link = F.try_element_at("pager", F.lit({"page=": -2, "pg=": -3}[rule]))
        prefix = F.concat(prefix, F.regexp_extract(link, f"(?is)^.*?{rule}", 0))
    numbered = B.page_urls_known(staged.withColumn("__prefix", prefix).withColumnRenamed("url", "page_url"),
                                 F.col("__prefix"), F.col("pager"), rule, most)
    if site != "pandacashback":
        return numbered.select("page_id", "page", "url")
    # a letter with one page is its own listing
    single = staged.where(F.size("pager") == 0).select("page_id", F.lit(1).alias("page"), "url")
    return numbered.select("page_id", "page", "url").unionByName(single)


def linked_pages(pages: DataFrame) -> DataFrame:
    """Listing urls of the pager that gives links only: page_id, pos, url. Without a pager the page itself."""
    docs = N.parse_nodes(pages.where(F.col("site") == "topcashback"), [TOP_PAGER], ["page_id", "url"])
    third = F.get(F.transform(N.select(N.ALL, TOP_PAGER).col, lambda n: n["outer"]), F.lit(2))
    links = F.regexp_extract_all(third, F.lit('(?is)<a href="(.*?)"'), F.lit(1))
    links = F.transform(F.coalesce(links, F.array()), lambda x: X.decode_amp(x))
    urls = F.transform(B.pages_from_links(links), lambda x: F.concat(F.lit(TOP_BASE), x))
    return docs.select("page_id", F.posexplode(F.when(F.size(links) > 0, urls).otherwise(F.array("url"))).alias("pos", "url"))


def store_links(pages: DataFrame) -> DataFrame:
    """Store pages of the two-level gift-card listing: page_id, pos, url."""
    *outer, cell = GRANNY_CELLS
    tests = [*outer, T_(cell.tag, markup=True)]
    docs = N.parse_nodes(pages.where(F.col("site") == "giftcardgranny"), tests, ["page_id"])
    blocks = docs.select("page_id", F.posexplode(N.under(N.ALL, *GRANNY_CELLS).col).alias("pos", "n"))
    link = X.quoted(X.find(F.col("n.outer"), 'href=".*?</a>'))
    return blocks.select("page_id", "pos", absolute_url(link, GRANNY_BASE).alias("url")).where("url IS NOT NULL")


def intermix_starts(spark: SparkSession, countries: Iterable[str] | None = None) -> DataFrame:
    """Country start requests: ``countries`` (None: every country of the table) with their currency, the US in any case."""
    dims = spark.createDataFrame(list(intermix.CURRENCIES.items()), "country_code string, currency string").withColumn("language", F.lit("en"))
    return B.country_requests(spark, dims, intermix.COUNTRY_PAGE, countries, ("us", "USD", "en"))


def menu_nodes(pages: DataFrame, tests: list[N.Test], keep: list[str]) -> DataFrame:
    """The menu's nodes as rows, in document order inside a page. A page's menu meets in one task, which reads it a fixed number of
    times whatever its length: intervals nest, so what encloses a node is found from running values."""
    return N.explode_nodes(N.parse_nodes(pages, tests, keep))


def in_order(start: int, end: int) -> WindowSpec:
    """The page's nodes from ``start`` to ``end`` rows around the present one."""
    return Window.partitionBy("page_id").orderBy("pre").rowsBetween(start, end)


def enclosing(found: Column, value: Column) -> Column:
    """``value`` of the last node so far where ``found`` holds, if it encloses this node. Such nodes must not nest."""
    last = F.last(F.when(found, F.struct(F.col("end").alias("end"), value.alias("value"))), ignorenulls=True).over(in_order(Window.unboundedPreceding, 0))
    return F.when(last["end"] >= F.col("pre"), last["value"])


def next_after(found: Column, value: Column) -> Column:
    """``value`` of the first node from this one on where ``found`` holds. Read backwards, it is the last so far: a window that reaches
    from each row to the page's end would be read again for every row."""
    back = Window.partitionBy("page_id").orderBy(F.desc("pre")).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(F.when(found, value), ignorenulls=True).over(back)


def inside_any(found: Column) -> Column:
    """Is the node inside one where ``found`` holds? Of intervals that nest, the one that ends last tells."""
    return F.coalesce(F.max(F.when(found, F.col("end"))).over(in_order(Window.unboundedPreceding, -1)) >= F.col("pre"), F.lit(False))


def parent_tag() -> Column:
    return F.element_at(F.split("path", "/"), -2)


def intermix_categories(pages: DataFrame) -> DataFrame:
    """Menu of the home pages, top entries and sub-entries: page_id, pos, category, sub_category, category_id,
    link."""
    nodes = menu_nodes(pages, [MENU_BOX, MENU, T_("li"), T_("div"), T_("a", path=True)], ["page_id"])
    is_menu = (F.col("tag") == "ul") & (F.try_element_at("attrs", F.lit("class")) == "sf-menu")
    boxed = nodes.withColumn("boxed", inside_any((F.col("tag") == "div") & (F.try_element_at("attrs", F.lit("class")) == "leftCategoryNavContainer")))
    menus = boxed.withColumn("menu", enclosing(is_menu & F.col("boxed"), F.col("pre")))
    is_top = (F.col("tag") == "li") & (F.col("parent") == F.col("menu"))
    tops = menus.withColumn("top", enclosing(is_top, F.col("pre"))).where("top IS NOT NULL")
    mine = Window.partitionBy("page_id", "top")
    heads = tops.withColumn("head", F.min_by(F.struct("pre", "end", "attrs"), F.when((F.col("tag") == "div") & (F.col("parent") == F.col("top")), F.col("pre"))).over(mine))
    entry = F.struct("text", F.try_element_at("attrs", F.lit("href")).alias("link"))
    is_own = (F.col("tag") == "a") & (F.col("parent") == F.col("head.pre"))
    named = heads.withColumn("own", F.min_by(entry, F.when(is_own, F.col("pre"))).over(mine))
    is_sub = (F.col("tag") == "a") & F.contains("path", F.lit("/ul/li/")) & (F.col("pre") > F.col("head.end"))
    # the row of the top entry stands for its own link
    sub = F.when(F.col("pre") == F.col("top"), "").when(is_sub, F.col("text"))
    first = F.col("pre") == F.col("top")
    rows = named.where((first | is_sub) & E.followed_category(F.col("own.link"))).select(
        "page_id", F.col("top"), F.col("own.text").alias("category"), sub.alias("sub_category"),
        F.when(first, F.replace(F.try_element_at("head.attrs", F.lit("id")), F.lit("tnc_"), F.lit(""))).otherwise(F.try_element_at("attrs", F.lit("id"))).alias("category_id"),
        F.when(first, F.col("own.link")).otherwise(F.try_element_at("attrs", F.lit("href"))).alias("link"))
    pos = (F.dense_rank().over(Window.partitionBy("page_id").orderBy("top")) - 1).alias("pos")
    return rows.select("page_id", pos, "category", "sub_category", "category_id", "link").where(E.followed_subcategory(F.col("sub_category")))


def intermix_overviews(pages: DataFrame, most: int | None = None) -> DataFrame:
    """Listing urls of the overview pages by their kind: page_id, kind, label, url.

    Pages carry their category path; its second level decides about look pages, the content about the rest. Overviews that show more
    than ``most`` pages give none (see ``unlikely_overviews``). The
    category id comes from the page's script, else from the url's ``cat`` parameter.
    """
    tests = [LOOKS, LOOK_ACTION, LOOK_ALL, LOOK_NAME, MASTER, REPORT, DIRECTORY, DIRECTORY_ITEM, T_("a"), T_(N.TEXT)]
    docs = N.parse_nodes(pages, tests, ["page_id", "url", "category_path"], with_html=True)
    label = F.coalesce(F.get("category_path", F.lit(1)), F.lit(""))
    looks = N.values(N.under(N.ALL, LOOKS, LOOK_ACTION, LOOK_ALL), "id")
    reports = N.values(N.descendants(N.under(N.ALL, MASTER, REPORT), N.select(N.ALL, T_("a"))), "href")
    staged = docs.select(
        "page_id", "url",
        E.page_kind(label, N.count(N.under(N.ALL, MASTER, REPORT)) > 0, N.count(N.under(N.ALL, DIRECTORY, DIRECTORY_ITEM)) > 0).alias("kind"),
        B.shown_pages(F.col("norm_html")).alias("shown"),
        F.coalesce(script_var(F.col("norm_html"), *intermix.CATEGORY_VARS), F.regexp_extract("url", "[?&]cat=([^&]*)", 1)).alias("id"),
        F.transform(looks, lambda x: F.regexp_extract(x, "viewAll_(.*)", 1)).alias("look_ids"),
        F.transform(N.texts_under(N.ALL, LOOKS, LOOK_NAME), X.clean).alias("look_names"), reports.alias("reports"))

    def entries(kind: str, urls: Column, labels: Column | None = None, count: Column | None = None) -> Column:
        named = F.arrays_zip(urls.alias("u"), (F.transform(urls, lambda u: F.lit("")) if labels is None else labels).alias("l"))
        last = F.lit(1).cast("bigint") if count is None else count.cast("bigint")
        return F.when(F.col("kind") == kind, F.transform(named, lambda z: F.struct(z["u"].alias("url"), z["l"].alias("label"), last.alias("last"))))

    look_urls = F.transform("look_ids", lambda i: F.concat(F.lit(LOOK_URL), i, F.lit("&ajaxRequest=true")))
    report_urls = F.transform("reports", lambda u: absolute_url(F.replace(u, F.lit("\n"), F.lit("")), intermix.BASE_URL, force=False))
    report_names = F.transform("reports", lambda u: F.replace(F.regexp_extract(u, ".*/(.*?)\\.", 1), F.lit("+"), F.lit(" ")))
    # directories and grids are one entry here, and one row per page below
    stem = F.concat(F.substring_index("url", "?", 1), F.lit("?filterCategoryId="), "id", F.lit("&page="))
    numbered = {kind: B.page_count(F.lit(kind), F.col("shown")) for kind in ("directory", "grid")}
    every = F.coalesce(entries("looks", look_urls, F.col("look_names")), entries("report", report_urls, report_names),
                       entries("directory", F.array(stem), None, numbered["directory"]), entries("grid", F.array(F.lit("")), None, numbered["grid"]))
    rows = staged.select("page_id", "kind", "id", F.explode(every).alias("e")).select("page_id", "kind", "id", "e.*")
    paged = B.page_rows(rows, F.col("last"), most)
    url = F.when(F.col("kind") == "directory", F.concat("url", F.col("page").cast("string"))).when(
        F.col("kind") == "grid", listing_page_url(intermix.AJAX_URL, F.col("id"), F.col("page"))).otherwise(F.col("url"))
    return paged.select("page_id", "kind", "label", url.alias("url"))


def intermix_report_pages(pages: DataFrame, most: int | None = None) -> DataFrame:
    """Listing urls of the trend-report pages: page_id, page, url."""
    found = script_var(F.col("html"), "id=\"DirGridCat_(.*?)\"")
    rows = pages.select("page_id", found.alias("id"), B.shown_pages(F.col("html")).alias("shown")).where("id IS NOT NULL")
    count = B.page_count(F.lit("report"), F.col("shown"))
    return B.page_rows(rows, count, most).select(
        "page_id", "page", listing_page_url(intermix.AJAX_URL, F.col("id"), F.col("page")).alias("url"))


def unlikely_overviews(pages: DataFrame, most: int) -> DataFrame:
    """Overview and report pages whose links show more than ``most`` pages, with the number: page_id, url, stage, reason."""
    return B.page_rejects(pages, "page_id", "url", B.shown_pages(F.col("html")), most)


def _shop_links(pages: DataFrame) -> DataFrame:
    """Country links of the shipping page: page_id, url, country_code, currency, language."""
    spark = pages.sparkSession
    docs = N.parse_nodes(pages, [FLAG, T_("a")], ["page_id"])
    links = N.values(N.descendants(N.select(N.ALL, FLAG), N.select(N.ALL, T_("a"))), "href")
    rows = docs.select("page_id", F.explode(links).alias("url")).withColumn("country_code", country_from_url(F.col("url")))
    dims = spark.createDataFrame([(c, tory.CURRENCIES[c], tory.LANGUAGES[c]) for c in tory.CURRENCIES],
                                 "country_code string, currency string, language string")
    return with_dims(rows, dims, "country_code")


def tory_starts(pages: DataFrame) -> DataFrame:
    """Country start requests from the shipping page: country_code, currency, language, url; a country outside
    the tables has null currency (see ``unknown_countries``)."""
    return _shop_links(pages).select("country_code", "currency", "language", "url")


def unknown_countries(pages: DataFrame) -> DataFrame:
    """Country links of the shipping page whose country is outside the tables: page_id, url, stage, and the code as the reason."""
    return reject_rows(_shop_links(pages), "page_id", "url", {"country": F.col("currency").isNull()}, F.concat(F.lit("unknown country "), F.coalesce("country_code", F.lit(""))))


def tory_regions(pages: DataFrame) -> DataFrame:
    """Delivery regions of the shipping page: column 1 is served by the US shop, column 2 by the EU shop."""
    spark = pages.sparkSession
    column = T_("div", "class", "eq", "column")
    docs = N.parse_nodes(pages, [column, FLAG, T_("div")], ["page_id"])
    parts = []
    for region, n in (("us", 1), ("eu", 2)):
        nth = N.part(N.select(N.ALL, column), n)
        names = N.values(N.descendants(N.descendants(nth, N.select(N.ALL, FLAG)), N.select(N.ALL, T_("div"))), "class")
        parts.append(docs.select(F.lit(region).alias("region"), F.lit(tory.CURRENCIES[region]).alias("currency"),
                                 F.explode(names).alias("country_name")))
    codes = spark.createDataFrame(list(tory.DELIVERY_CODES.items()), "country_name string, country_code string")
    return delivery_regions(parts[0].unionByName(parts[1]), codes)


def tory_categories(pages: DataFrame) -> DataFrame:
    """Menu entries of the main pages: page_id, category, sub_category (array), link. Categories without a
    sub-menu give their own links."""
    tests = [NAVIGATION, CATEGORY_MENU, T_("ul"), T_("li", path=True), T_("span"), T_("a")]
    nodes = menu_nodes(pages, tests, ["page_id", "country_code"])
    heads = F.array(*[F.lit(c) for c in tory.CATEGORIES if c != "home"])
    style, name = F.try_element_at("attrs", F.lit("class")), F.try_element_at("attrs", F.lit("id"))
    boxed = nodes.withColumn("boxed", inside_any((F.col("tag") == "div") & (name == "navigation")))
    menus = boxed.withColumn("in_menu", inside_any((F.col("tag") == "ul") & F.startswith(style, F.lit("menu-category")) & F.col("boxed")))
    # entries are list items of the menu that name a category; what stands in them belongs to them
    is_head = (F.col("tag") == "li") & F.col("in_menu") & F.array_contains(heads, style)
    heads_ = menus.withColumn("head", is_head & ~inside_any(is_head))
    owned = heads_.withColumn("top", enclosing(F.col("head"), F.struct("pre", style.alias("category")))).where("top IS NOT NULL")
    # a list item is a group when a span right below it says so
    is_title = (F.col("tag") == "span") & F.contains(F.coalesce("text", F.lit("")), F.lit("Categories"))
    family = F.when(F.col("tag") == "span", F.col("parent")).otherwise(F.col("pre"))
    titled = owned.withColumn("titled", F.max(is_title).over(Window.partitionBy("page_id", family)))
    is_item = (F.col("tag") == "li") & (F.col("pre") > F.col("top.pre")) & (parent_tag() == "ul") & (F.col("parent") > F.col("top.pre"))
    grouped = titled.withColumn("grouped", inside_any((F.col("tag") == "li") & F.col("titled")))
    anchor = next_after(F.col("tag") == "a", F.struct("pre", "text", F.try_element_at("attrs", F.lit("href")).alias("link")))
    kinds = grouped.withColumns({"leaf": is_item & F.col("grouped"), "item": is_item, "next": anchor})
    mine = Window.partitionBy("page_id", "top.pre")
    chosen = kinds.withColumns({"leaves": F.max("leaf").over(mine), "items": F.max("item").over(mine)}).where(
        F.when(F.col("leaves"), F.col("leaf")).when(F.col("items"), F.col("item")).otherwise(F.col("tag") == "a"))
    first_a = F.when(F.col("next.pre") <= F.col("end"), F.col("next"))
    text = F.when(F.col("tag") == "a", "").otherwise(F.coalesce(style, first_a["text"], F.lit("")))
    label = subcat_label(X.strip_ws(text), F.col("top.category"), F.col("country_code"))
    return chosen.select("page_id", F.col("top.category").alias("category"), label.alias("sub_category"), X.strip_ws(first_a["link"]).alias("link")).where(
        F.col("link").isNotNull() & E.followed_label(F.coalesce(F.get("sub_category", F.lit(0)), F.lit(""))))


def japan_categories(pages: DataFrame) -> DataFrame:
    """Menu entries of the Japanese shop: page_id, category, sub_category, link. The i-th category owns the i-th
    menu box and every link with its name in the path."""
    docs = N.parse_nodes(pages, [JP_NAV, T_("div", "id", "starts", "menu", path=True), T_("li"), T_("a", path=True)], ["page_id"])
    # each link once, with the (few) menu boxes at hand
    staged = docs.select("page_id", F.explode(N.under(N.ALL, JP_NAV, T_("li"), T_("a")).col).alias("n"),
                         N.under(N.ALL, JP_NAV, T_("div", "id", "starts", "menu")).col.alias("boxes"))
    href = F.try_element_at("n.attrs", F.lit("href"))
    owned = "exists(boxes, b -> try_element_at(b.attrs, 'id') = '{0}' AND n.pre > b.pre AND n.pre <= b.end AND contains(substr(n.path, length(b.path) + 1), '/li/'))"
    categories = F.array_compact(F.array(*[
        F.when(F.contains(href, F.lit(f"/{category}/")) | F.expr(owned.format(menu)), F.lit(category)) for category, menu in tory.JAPAN_MENUS]))
    rows = staged.where(href.isNotNull()).select("page_id", F.explode(categories).alias("category"), F.col("n.text").alias("label"), href.alias("link"))
    return rows.select("page_id", "category", X.clean(F.col("label")).alias("sub_category"),
                       absolute_url(X.strip_ws(F.col("link")), tory.JAPAN, force=False).alias("link"))


def japan_pages(pages: DataFrame) -> DataFrame:
    """Distinct pager urls of the Japanese listings: page_id, url."""
    docs = N.parse_nodes(pages, [JP_PAGER, JP_PAGES, T_("li"), T_("a")], ["page_id"])
    links = F.array_distinct(N.values(N.under(N.ALL, JP_PAGER, JP_PAGES, T_("li"), T_("a")), "href"))
    return docs.select("page_id", F.explode(links).alias("l")).select(
        "page_id", absolute_url(F.col("l"), tory.JAPAN, force=False).alias("url"))


def vitamin_links(pages: DataFrame) -> DataFrame:
    """Item lists of the letter pages (second news cell) and the brand names of the index: page_id, kind, value."""
    tests = [vitamins.CELL, vitamins.ITEM_CELL, T_("tr"), T_("td"), T_("a")]
    docs = N.parse_nodes(pages, tests, ["page_id"])
    anchors = N.select(N.ALL, T_("a"))
    news = N.select(N.ALL, vitamins.ITEM_CELL)
    second = N.Nodes(N.let(news, "c", "filter(c, n -> size(filter(c, m -> m.parent = n.parent AND m.pre < n.pre)) = 1)"))
    cells = N.children(N.descendants(second, N.select(N.ALL, T_("tr"))), N.select(N.ALL, T_("td")))
    items = N.values(N.children(cells, anchors), "href")
    in_index = N.descendants(N.select(N.ALL, vitamins.CELL), anchors)
    brands = N.values(N.where(in_index, f"rlike(try_element_at(n.attrs, 'href'), {N.literal(vitamins.BRAND_LINK)})"))
    value = F.concat(F.transform(items, lambda x: F.struct(F.lit("item").alias("kind"), x.alias("value"))),
                     F.transform(F.array_sort(F.array_distinct(brands)), lambda x: F.struct(F.lit("brand").alias("kind"), x.alias("value"))))
    return docs.select("page_id", F.explode(value).alias("e")).select("page_id", "e.kind", "e.value")


def vitamin_letters(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, vitamins.LETTER_URL + c) for c in B.ALPHABET], "letter string, url string")
