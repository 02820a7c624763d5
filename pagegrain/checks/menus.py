"""Checks of the site navigation (families B and F on site-shaped pages built from the part table)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.checks.base import check, dealt_parts
from pagegrain.plans import navigation as V

LONG = "bigint"


def sql_template(template: str) -> Column:
    """A page template whose [[...]] places are SQL expressions."""
    pieces = [p for part in template.split("[[") for p in part.split("]]", 1)] if "[[" in template else [template]
    out = []
    for i, piece in enumerate(pieces):
        literal = "'" + piece.replace("\\", "\\\\").replace("'", "\\'") + "'"
        out.append(f"CAST({piece} AS STRING)" if i % 2 else literal)
    return F.expr("concat(" + ", ".join(out) + ")")


def part_pages(spark: SparkSession, sf_dir: str, site: str, template: str, url: str = "http://p.example/[[p_partkey]]") -> DataFrame:
    return dealt_parts(spark, sf_dir).select(
        F.col("p_partkey").alias("page_id"), F.lit(site).alias("site"), sql_template(url).alias("url"), sql_template(template).alias("html"),
        F.lit("us").alias("country_code"), "p_name", "p_size")


@check("n1_countries", """
SELECT p_partkey AS page_id, 'http://www.x.com/' || c AS url, 'country' AS stage, 'unknown country ' || lower(c) AS reason
FROM part, unnest([CASE p_partkey % 3 WHEN 0 THEN 'ZZ' ELSE 'uk' END, 'xx']) AS t(c) WHERE c <> 'uk'""")
def n1_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries of the shipping page that no table knows."""
    code = F.when(F.col("p_partkey") % 3 == 0, "ZZ").otherwise("uk")
    flag = lambda c: F.concat(F.lit('<div class="flag-container"><a href="http://www.x.com/'), c, F.lit('">x</a></div>'))
    pages = dealt_parts(spark, sf_dir).select(F.col("p_partkey").alias("page_id"), F.concat(flag(code), flag(F.lit("xx"))).alias("html"))
    return V.unknown_countries(pages)


@check("b2_site_pagers", """
WITH n AS (SELECT p_partkey, CASE WHEN p_partkey % 97 = 1 THEN 1200 ELSE 0 END + p_size % 6 + 1 AS n FROM part)
SELECT p_partkey AS page_id, CAST(page AS BIGINT) AS page, base || page AS url
FROM n, unnest(['http://buy.cardsnagger.com/buy/?sort=alphaasc&page=', 'https://www.raise.com/buy-gift-cards?page=',
  'http://www.pandacashback.com/r.php?a=1&page=', 'http://www.rebategiant.com/s.html?pg=']) AS b(base), unnest(range(1, n + 1)) AS p(page)
UNION ALL SELECT p_partkey, 1, 'http://one.example/' || p_partkey FROM part""")
def b2_site_pagers(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = "[[CASE WHEN p_partkey % 97 = 1 THEN 1200 ELSE 0 END + p_size % 6 + 1]]"
    shapes = {
        "cardsnagger": f'<ul class="PagingList"><li><a>1</a></li><li><a>{last}</a></li></ul>',
        "raise": f'<nav class="pagination pagination-centered"><ul><li><a>x</a></li><li><a>y</a></li><li><a>9</a></li><li><a>{last} pages</a></li></ul></nav>',
        "pandacashback": f'<div class="pagination"><a href="r.php?a=1&amp;page=2">2</a><a href="r.php?a=1&amp;page={last}">l</a><a href="n">next</a></div>',
        "rebategiant": f'<div class="pages"><a href="/s.html?pg={last}">l</a><a href="n">next</a><a href="e">end</a></div>',
    }
    parts = [V.numbered_pages(part_pages(spark, sf_dir, s, t), s) for s, t in shapes.items()]
    parts.append(V.numbered_pages(part_pages(spark, sf_dir, "pandacashback", "<p>none</p>", "http://one.example/[[p_partkey]]"), "pandacashback"))
    return reduce(DataFrame.unionByName, parts).withColumn("page", F.col("page").cast(LONG))


@check("b4_site_links", """
SELECT p_partkey AS page_id, CAST(pos AS BIGINT) AS pos, 'http://www.topcashback.com/s/?l=' || p_size || '&page=' || (pos + 1) AS url
FROM part, unnest(range(0, 3)) AS t(pos) WHERE p_size % 2 = 0
UNION ALL SELECT p_partkey, 0, 'http://p.example/' || p_partkey FROM part WHERE p_size % 2 = 1""")
def b4_site_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = '<li><a href="/s/?l=[[p_size]]&amp;page={0}">{0}</a></li>'
    box = '<div class="pagination-nav-comments">{0}</div>'
    with_pager = "".join(box.format(x) for x in ("a", "b", "<ul>" + link.format(3) + link.format(2) + link.format(3) + "</ul>"))
    pages = part_pages(spark, sf_dir, "topcashback", with_pager).withColumn(
        "html", F.when(F.col("p_size") % 2 == 0, F.col("html")).otherwise("<p>one page</p>"))
    return V.linked_pages(pages).withColumn("pos", F.col("pos").cast(LONG))


@check("b5_store_links", """
SELECT p_partkey AS page_id, CAST(pos AS BIGINT) AS pos, 'http://www.giftcardgranny.com/' || CASE pos WHEN 0 THEN p_name ELSE p_brand END || '/' AS url
FROM part, unnest([0, 2]) AS t(pos)""")
def b5_store_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = ('<div class="content"><table><tr><td><a href="/[[p_name]]/">x</a></td><td>none</td></tr><tr><td><a href="/[[p_brand]]/">y</a></td></tr></table></div>'
            '<table><tr><td><a href="/outside/">z</a></td></tr></table>')
    return V.store_links(part_pages(spark, sf_dir, "giftcardgranny", html)).withColumn("pos", F.col("pos").cast(LONG))


@check("b3_overviews", """
WITH k AS (SELECT *, CASE p_size % 4 WHEN 0 THEN 'looks' WHEN 1 THEN 'report' WHEN 2 THEN 'directory' ELSE 'grid' END AS kind FROM part)
SELECT p_partkey AS page_id, kind, p_name AS label, 'http://www.intermixonline.com/trendlooksandproducts.do?subCategoryId=' || p_partkey || '&ajaxRequest=true' AS url FROM k WHERE kind = 'looks'
UNION ALL SELECT p_partkey, kind, 'Spring ' || p_size, 'http://www.intermixonline.com/a/Spring+' || p_size || '.htm' FROM k WHERE kind = 'report'
UNION ALL SELECT p_partkey, kind, '', 'http://p.example/' || p_partkey || '?filterCategoryId=c' || p_partkey || '&page=' || i FROM k, unnest(range(1, CASE WHEN p_partkey % 3 = 0 THEN 16 + p_size ELSE 14 END)) AS t(i) WHERE kind = 'directory'
UNION ALL SELECT p_partkey, kind, '', 'http://www.intermixonline.com/categoryproductviewall.do?subCategoryCode=' || (1000 + p_partkey) || '&ajaxRequest=true&page=' || i FROM k, unnest(range(1, CASE WHEN p_partkey % 3 = 0 THEN 16 + p_size ELSE 11 END)) AS t(i) WHERE kind = 'grid'""")
def b3_overviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    looks = ('<div id="DirectoryViewWrapper1"><div class="productSubCategoryName">\n[[p_name]]</div><div class="dirAction"><div id="viewAll_[[p_partkey]]">all</div></div></div>')
    report = '<div id="master"><div id="STR1"><a href="/a/Spring+[[p_size]].htm">x</a></div></div>'
    directory = '<div id="nDiv"><div class="directoryProductRow2">x</div></div>'
    grid = "<script>CurrentCat=[[1000 + p_partkey]];</script>"
    pages = part_pages(spark, sf_dir, "intermix", "", "http://p.example/[[p_partkey]]?cat=c[[p_partkey]]")
    kind = F.col("p_size") % 4
    pager = F.when(F.col("page_id") % 3 == 0, sql_template('<a href="?a=1&amp;page=2">2</a><a href="?a=1&amp;page=[[15 + p_size]]">last</a>')).otherwise("")
    html = F.when(kind == 0, sql_template(looks)).when(kind == 1, sql_template(report)).when(kind == 2, F.concat(F.lit(directory), pager)).otherwise(F.concat(sql_template(grid), pager))
    pages = pages.withColumn("p_partkey", F.col("page_id")).withColumn("html", html).withColumn(
        "category_path", F.array(F.lit("how we style"), F.when(kind == 0, "Chic This Week").otherwise("Other")))
    return V.intermix_overviews(pages)


@check("b11_menus", """
SELECT 'intermix' AS site, p_partkey AS page_id, p_type AS category, '' AS sub_category, '/c/' || p_partkey AS link FROM part
UNION ALL SELECT 'intermix', p_partkey, p_type, p_name, '/s/' || p_partkey FROM part
UNION ALL SELECT 'tory', p_partkey, 'shoes', p_name, '/t/' || p_partkey FROM part
UNION ALL SELECT 'tory', p_partkey, 'shoes', 'x', '/r' FROM part, unnest(range(0, 1000)) AS t(i) WHERE p_partkey % 100 = 1
UNION ALL SELECT 'intermix', p_partkey, p_type, 'More', '/m' FROM part, unnest(range(0, 1000)) AS t(i) WHERE p_partkey % 100 = 1
UNION ALL SELECT 'tory', p_partkey, 'watches', '', '/w/' || p_partkey FROM part
UNION ALL SELECT 'japan', p_partkey, 'clothing', p_name, 'http://www.toryburch.jp/j/' || p_partkey FROM part
UNION ALL SELECT 'japan', p_partkey, 'shoes', p_brand, 'http://www.toryburch.jp/x/shoes/' || p_partkey FROM part""")
def b11_menus(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = ('<div class="leftCategoryNavContainer"><ul class="sf-menu"><li><div id="tnc_[[p_partkey]]"><a href="/c/[[p_partkey]]">[[p_type]]</a></div>'
            '<ul><li><a id="s1" href="/s/[[p_partkey]]">[[p_name]]</a></li><li><a id="s2" href="/s/0">Spring Look Book</a></li>[[CASE WHEN p_partkey % 100 = 1 THEN repeat(\'<li><a id="s3" href="/m">More</a></li>\', 1000) ELSE \'\' END]]</ul></li>'
            '<li><div id="tnc_9"><a href="/designer/1">Designers</a></div></li></ul></div>')
    tory = ('<div id="navigation"><ul class="menu-category x"><li class="shoes"><ul><li><span>Categories</span><ul><li class="shoes-[[p_name]]"><a href="/t/[[p_partkey]]">n</a></li>[[CASE WHEN p_partkey % 100 = 1 THEN repeat(\'<li class="shoes-x"><a href="/r">r</a></li>\', 1000) ELSE \'\' END]]</ul></li>'
            '<li><span>Looks</span><ul><li><a href="/no">no</a></li></ul></li></ul></li><li class="watches"><a href="/w/[[p_partkey]]">Watches</a></li>'
            '<li class="home"><a href="/h">Home</a></li></ul></div>')
    japan = ('<div id="gNav"><div id="menu2"><ul><li><a href="/j/[[p_partkey]]">[[p_name]]</a></li></ul></div><ul><li><a href="/x/shoes/[[p_partkey]]">[[p_brand]]</a></li></ul></div>')
    cols = ["site", "page_id", "category", "sub_category", "link"]
    a = V.intermix_categories(part_pages(spark, sf_dir, "intermix", home)).withColumn("site", F.lit("intermix"))
    b = V.tory_categories(part_pages(spark, sf_dir, "toryburch", tory)).withColumn("site", F.lit("tory")).withColumn(
        "sub_category", F.array_join("sub_category", "|"))
    c = V.japan_categories(part_pages(spark, sf_dir, "toryburch", japan)).withColumn("site", F.lit("japan"))
    return a.select(*cols).unionByName(b.select(*cols)).unionByName(c.select(*cols))
