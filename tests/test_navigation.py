"""Start requests, delivery regions and link lists that come from fixed lists or single pages."""

import time

from pagegrain.plans import navigation as V
from pagegrain.plans import jobs


def page(spark, html, site="x", page_type="listing", url="http://p.example/1"):
    return spark.createDataFrame([(1, site, page_type, url, "us", html)],
                                 "page_id bigint, site string, page_type string, url string, country_code string, html string")


def test_letter_seeds(spark):
    rows = V.letter_seeds(spark).collect()
    assert len(rows) == 5 * 27
    urls = {r.url for r in rows}
    assert "http://www.befrugal.com/coupons/stores/num" in urls
    assert "http://mrrebates.com/merchants/all_merchants_tabbed.asp?letter=z" in urls
    assert "http://www.pandacashback.com/retailers.php?letter=0-9" in urls


def test_vitamin_letters(spark):
    assert V.vitamin_letters(spark).count() == 26


def test_country_starts(spark):
    some = V.intermix_starts(spark, ["gb", "jp", "us"]).collect()
    assert sorted((r.country_code, r.currency) for r in some) == [("gb", "GBP"), ("jp", "JPY"), ("us", "USD")]
    every = {r.country_code: r.currency for r in V.intermix_starts(spark).collect()}
    assert len(every) > 90 and every["fr"] == "EUR"


def test_menus_are_read_in_linear_time(spark):
    """Eight times the links take far less than the 64-fold time of a quadratic plan."""
    def menu(n):
        items = "".join(f'<li class="shoes-s{i}"><a href="/t/{i}">n</a></li>' for i in range(n))
        return f'<div id="navigation"><ul class="menu-category x"><li class="shoes"><ul><li><span>Categories</span><ul>{items}</ul></li></ul></li></ul></div>'

    def seconds(n):
        pages = page(spark, menu(n)).cache()
        assert V.tory_categories(pages).count() == n
        start = time.perf_counter()
        V.tory_categories(pages).count()
        return time.perf_counter() - start

    small = seconds(500)
    assert seconds(4000) < 12 * small + 4


SHIPPING = ('<div id="content"><div class="column"><div class="flag-container"><a href="http://www.x.com/us"><div class="canada">c</div></a>'
            '<div class="india">i</div></div></div><div class="column"><div class="flag-container"><a href="http://www.x.com/EU/"><div class="spain">s</div></a>'
            "</div></div></div>")


def test_shop_starts_and_regions(spark):
    starts = sorted((r.country_code, r.currency, r.language) for r in V.tory_starts(page(spark, SHIPPING)).collect())
    assert starts == [("eu", "EUR", "en"), ("us", "USD", "en")]
    regions = sorted((r.region, r.currency, r.countries) for r in V.tory_regions(page(spark, SHIPPING)).collect())
    assert regions == [("eu", "EUR", ["es"]), ("us", "USD", ["ca", "in"])]


def test_japan_pager_links_are_distinct(spark):
    html = '<div class="pagerArea"><ul class="pageList x"><li><a href="/l?p=2">2</a></li><li><a href="/l?p=2">2</a></li><li><a href="http://o/3">3</a></li></ul></div>'
    assert [r.url for r in V.japan_pages(page(spark, html)).collect()] == ["http://www.toryburch.jp/l?p=2", "http://o/3"]


def test_vitamin_links(spark):
    html = ('<table><tr><td valign="top"><a href="http://b.com/x">Beta</a><a href="http://a.com/">Alpha</a><a href="/local">no</a></td></tr></table>'
            '<table><tr><td class="newsText"><table><tr><td><a href="/first">f</a></td></tr></table></td>'
            '<td class="newsText"><table><tr><td><a href="/second">s</a></td></tr></table></td></tr></table>')
    got = [(r.kind, r.value) for r in V.vitamin_links(page(spark, html)).collect()]
    assert got == [("item", "/second"), ("brand", "Alpha"), ("brand", "Beta")]


def test_report_pages(spark):
    rows = V.intermix_report_pages(page(spark, '<div id="DirGridCat_77">x</div>')).collect()
    assert len(rows) == 9 and rows[0].url.endswith("subCategoryCode=77&ajaxRequest=true&page=1")


def test_job_links_need_a_result_page(spark):
    html = "Search results <a href=jobdetails.aspx?id=1&amp;x=2>a</a>"
    assert [r.url for r in jobs.brassring_links(page(spark, html)).collect()] == ["https://sjobs.brassring.com/TGWebHost/jobdetails.aspx?id=1&x=2"]
    assert jobs.brassring_links(page(spark, html.replace("Search", ""))).count() == 0


def test_overviews_whose_pager_shows_a_part(spark):
    """A next link, a window of numbers or an unrelated link do not make an overview shorter than the usual number of its kind."""
    def pages_of(html):
        given = page(spark, html, url="http://p.example/1?cat=c1").selectExpr("*", "array('how we style', 'Other') AS category_path")
        return V.intermix_overviews(given).count()

    grid, directory = "<script>CurrentCat=5;</script>", '<div id="nDiv"><div class="directoryProductRow2">x</div></div>'
    for link, more in (('<a href="?page=2">next</a>', 0), ('<a href="?page=1">x</a>', 0), ("", 0), ('<a href="?page=2">2</a><a href="?page=20">last</a>', 20)):
        assert pages_of(grid + link) == max(10, more) and pages_of(directory + link) == max(13, more)
        assert V.intermix_report_pages(page(spark, 'id="DirGridCat_7"' + link)).count() == max(9, more)
