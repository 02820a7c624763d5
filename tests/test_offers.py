"""One hand-written block per site, negative variants and rejects."""

import pytest

from pagegrain.plans.offer_rules import BY_SITE, RULES
from pagegrain.plans.offers import extract_all_offers, extract_offers, offer_rejects

PCT, ABS, UNKNOWN = "Percentage Cash Back", "Absolute Cash Back", "unknown"
CASES = [
    ("abcgiftcards", '<div id="indexCategories"><div class="categoryListBoxContents"><a href="https://a.example/acme" title="Acme &amp; Co "><img src="a.png"></a><br>Acme<br>12% OFF<b></b></div></div>',
     [("Acme & Co", "12%", "https://a.example/acme", PCT)]),
    ("befrugal", '<table><tr class="storeTable-row1"><td><a href="acme">Acme &amp; Co</a></td><td><p class="c">$5.00</p></td></tr>'
     '<tr class="storeTable-row2"><td><a href="beta">Beta</a></td><td></td></tr></table>',
     [("Acme & Co", "$5.00", "http://www.befrugal.com/crumbs/acme", ABS), ("Beta", "NA", "http://www.befrugal.com/crumbs/beta", UNKNOWN)]),
    ("bigcrumbs", '<div class="listingItem listingItemRetailer"><h2><a href="r.do?id=1">Acme</a></h2></div>',
     [("Acme", "", "http://www.bigcrumbs.com/crumbs/r.do?id=1", "")]),
    ("cactus", '<table><tr class=" body-content"><td class="n"><a href="/acme">Acme coupons</a></td><td class="c">4% back</td></tr></table>',
     [("Acme", "4% back", "http://www.couponcactus.com/acme", PCT)]),
    ("cardcash", '<div id="merchants_list"><div class="categoryListBoxContents"><a href="http://c.example/acme" title="Acme &amp; Co"></a><br>Acme<br>7% OFF<i></i></div></div>',
     [("Acme &amp; Co", "7%", "http://c.example/acme", PCT)]),
    ("cardpool", '<table class="bottom merchants_grid"><tr><td><a href="/acme"><span class="merchant_link_name_text">Acme Gift Cards (3)</span></a><span class="merchant_discount">10% Off</span></td>'
     '<td><a href="/b"><span class="merchant_link_name_text">Gone (0)</span></a></td></tr></table>',
     [("Acme ", "10%", "http://www.cardpool.com/acme", PCT)]),
    ("cardsnagger", '<ul class="ProductList "><li><a href="/p/1">x</a><div class="ProductDetails"><a href="/p/1">$25 Acme Gift Card</a></div><strike class="RetailPriceValue">$25.00</strike> $20.00<br></li></ul>',
     [("$25 Acme", "20.0%", "/p/1", PCT)]),
    ("ebates", '<table id="moreStoresTable"><tr><td class="storeName"><a href="/acme.htm">Acme Coupons\n</a></td><td><a href="x" target="_blank">6% Cash Back</a></td></tr>'
     '<tr><td class="storeName"><a href="/a.htm">A\n</a></td></tr></table>',
     [("Acme", "6% Cash Back", "http://www.ebates.com/acme.htm", PCT)]),
    ("fatwallet", '<table><tr class="storeListRow last"><td class="storeListStoreName">Beta</td><td><a href="/go/2">Shop</a></td></tr></table>',
     [("Beta", "offers only", "http://fatwallet.com/go/2", UNKNOWN)]),
    ("giftcardgranny", '<div class="alert_header"><h1>Acme Gift Cards</h1></div><table><tbody><tr><td class="save">5%</td></tr><tr><td class="save">12.5%</td></tr></tbody></table>',
     [("Acme", "12.5%", "http://p.example/1", PCT)]),
    ("giftcards", '<div id="promo-bar-other"><div class="cat-selection card-img-holder"><a href="/acme">Acme Gift Cards</a><span class="card-details-text">9% discount</span><span class="card-details-text">(4) in stock</span></div></div>',
     [("Acme", "9%", "http://www.giftcards.com/acme", PCT)]),
    ("giftcardspread", '<span><li><a href="acme"><img src="i.png"></a><a href="acme">Acme (2)</a><span class="off">11 % OFF</span></li></span>',
     [("Acme", "11%", "https://giftcardspread.com/acme", PCT)]),
    ("giftcardzen", '<ul id="merchants-to-sell"><li><a href="/acme"><span class="name">Acme Gift Cards</span><span class="off">13% Off</span></a></li></ul>',
     [("Acme", "13%", "http://www.giftcardzen.com/acme", PCT)]),
    ("mrrebates", '<table><tr class="odd"><td><a href="/go?id=1"><b>Acme &amp; Co</b></a></td><td class="r">$2.50</td></tr></table>',
     [("Acme & Co", "$2.50", "http://mrrebates.com/go?id=1", ABS)]),
    ("pandacashback", '<div class="featuerd_box"><a href="../acme.php">Acme </a><span class="price_tag">5% Cash Back</span></div>',
     [("Acme", "5%", "http://www.pandacashback.com/acme.php", PCT)]),
    ("raise", '<div class="row-fluid"><ul><li class="product-source"><a href="/acme"><div class="name">Acme Gift Cards (Online Only)</div></a><div class="info">(7) up to 15% Off</div></li></ul></div>',
     [("Acme ", "15%", "http://www.raise.com/acme", PCT)]),
    ("rebategiant", '<div class="box list"><table><tr><td><a href="http://r.example/1">Acme &amp; Co</a></td><td><strong>$1.00</strong></td></tr><tr><td>none</td></tr></table></div>',
     [("Acme & Co", "$1.00", "http://r.example/1", ABS)]),
    ("rescue", '<div class="tab-pane"><ul><li><a href="/acme" title="Acme &amp; Co (Not iTunes)">x</a><span>6%</span></li></ul></div>',
     [("Acme  Co", "6%", "http://www.giftcardrescue.com/acme", PCT)]),
    ("savingswatch", '<div id="catlistline"><a href="/s/1">Acme</a><span class="rebate"><a href="/s/1">up to 4%</a></span></div>',
     [("Acme", "up to 4%", "http://www.savingswatch.com/s/1", PCT)]),
    ("topcashback", '<div class="offerlist-container"><div class="offerlist-description"><a href="/acme"><span class="offerlist-description-title">Acme Cashback</span></a></div><span class="rate">2.1%</span></div>',
     [("Acme", "2.1%", "http://www.topcashback.com/acme", PCT)]),
]


def pages(spark, cases):
    rows = [(i, site, "http://p.example/1", html) for i, (site, html, *_) in enumerate(cases)]
    return spark.createDataFrame(rows, "page_id bigint, site string, url string, html string").coalesce(1)


def test_every_site_has_a_case():
    assert {c[0] for c in CASES} == set(BY_SITE)


@pytest.fixture(scope="module")
def offers(spark, tmp_path_factory):
    found = extract_all_offers(pages(spark, CASES), str(tmp_path_factory.mktemp("blocks")), RULES).collect()
    return sorted((r.site, r.store_name, r.cash_back, r.url, r.category) for r in found)


@pytest.mark.parametrize("site,html,expected", CASES, ids=[c[0] for c in CASES])
def test_site(offers, site, html, expected):
    assert [o[1:] for o in offers if o[0] == site] == sorted(expected)


def test_unreadable_block_is_a_reject_and_not_an_offer(spark):
    rule = BY_SITE["cactus"]
    one_cell = [("cactus", '<table><tr class=" body-content"><td class="n"><a href="/a">A coupons</a></td></tr></table>')]
    assert extract_offers(pages(spark, one_cell), [rule]).collect() == []
    assert [(r.page_id, r.stage) for r in offer_rejects(pages(spark, one_cell), [rule]).collect()] == [(0, "cash_back")]


def test_result_does_not_depend_on_partitioning(spark):
    rule = BY_SITE["befrugal"]
    html = CASES[1][1]
    many = spark.range(50).selectExpr("id AS page_id", "'befrugal' AS site", "'u' AS url", f"'{html}' AS html")
    one, eight = (sorted(extract_offers(many.repartition(n), [rule]).collect()) for n in (1, 8))
    assert one == eight and len(one) == 100


def test_site_job_has_no_shuffle(spark):
    plan = extract_offers(pages(spark, CASES), [BY_SITE["raise"]])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
