"""Site-shaped pages built from the part table, and the offers they must give.

Pages hold at most 40 parts. Links are ``p_partkey``, names ``p_name & p_partkey``, cash back is ``p_size`` as a
percentage or dollars, and every seventh part has none.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.checks.base import dealt_parts, table

PER_PAGE = 40


@dataclass(frozen=True)
class Shape:
    """Markup of one site with {n} name, {c} cash, {k} key, {s} stock, and what must come out (SQL)."""

    open: str
    block: str
    close: str
    url: str
    bare: str | None = None
    name: str = "p_name || ' & ' || p_partkey"
    cash: str = "{c}"
    no_cash: tuple[str, str] = ("", "unknown")
    where: str = "true"
    dollars: bool = True


IN_STOCK = "p_partkey % 5 <> 0"
BARE_OR_IN_STOCK = "(p_partkey % 5 <> 0 OR p_partkey % 7 = 0)"

SHAPES: dict[str, Shape] = {
    "abcgiftcards": Shape(
        '<div id="indexCategories">',
        '<div class="categoryListBoxContents"><a href="https://a.example/s/{k}" title="{n} "><img src="a.png"></a><br>x<br>{c} OFF<b></b></div>',
        "</div>", "https://a.example/s/",
        bare='<div class="categoryListBoxContents"><a href="https://a.example/s/{k}" title="{n} "></a></div>'),
    "befrugal": Shape(
        "<table>", '<tr class="storeTable-row1"><td><a href="s/{k}">{n}</a></td><td><p class="c">{c}</p></td></tr>', "</table>",
        "http://www.befrugal.com/crumbs/s/", bare='<tr class="storeTable-row2"><td><a href="s/{k}">{n}</a></td><td></td></tr>',
        no_cash=("NA", "unknown")),
    "bigcrumbs": Shape(
        "<div>", '<div class="listingItem listingItemRetailer"><h2><a href="s/{k}">{n}</a></h2><div class="crumbEarner">'
        '<span class="amount">{c}</span></div></div>', "</div>", "http://www.bigcrumbs.com/crumbs/s/",
        bare='<div class="listingItem listingItemRetailer"><h2><a href="s/{k}">{n}</a></h2></div>', no_cash=("", "")),
    "cactus": Shape(
        "<table>", '<tr class="spon body-content"><td class="n"><a href="/s/{k}">{n} coupons</a></td><td class="c">{c} back</td></tr>',
        "</table>", "http://www.couponcactus.com/s/", bare='<tr class=" body-content"><td><a href="/s/{k}">{n} coupons</a></td></tr>',
        cash="{c} back"),
    "cardcash": Shape(
        '<div id="merchants_list">',
        '<div class="categoryListBoxContents"><a href="http://c.example/s/{k}" title="{n}"></a><br>x<br>{c} OFF<i></i></div>', "</div>",
        "http://c.example/s/", bare='<div class="categoryListBoxContents"><a href="http://c.example/s/{k}" title="{n}"></a></div>',
        name="p_name || ' &amp; ' || p_partkey"),
    "cardpool": Shape(
        '<table class="bottom merchants_grid"><tr>',
        '<td><a href="/s/{k}"><span class="merchant_link_name_text">{n} Gift Cards ({s})</span></a><span class="merchant_discount">{c} Off</span></td>',
        "</tr></table>", "http://www.cardpool.com/s/", name="p_name || ' & ' || p_partkey || ' '",
        bare='<td><a href="/s/{k}"><span class="merchant_link_name_text">{n} Gift Cards ({s})</span></a></td>', where=IN_STOCK),
    "ebates": Shape(
        '<table id="moreStoresTable">',
        '<tr><td class="storeName"><a href="/s/{k}">{n} Coupons\n</a></td><td><a href="x" target="_blank">{c} Cash Back</a></td></tr>',
        "</table>", "http://www.ebates.com/s/", bare='<tr><td class="storeName"><a href="/s/{k}">{n} Coupons\n</a></td></tr>',
        cash="{c} Cash Back", no_cash=("", "")),
    "fatwallet": Shape(
        "<table>", '<tr class="storeListRow even"><td class="storeListStoreName">{n}</td><td><span class="storeListCashbackSaleText">{c}</span></td>'
        '<td><a href="/s/{k}">Shop</a></td></tr>', "</table>", "http://fatwallet.com/s/",
        bare='<tr class="storeListRow last"><td class="storeListStoreName">{n}</td><td><a href="/s/{k}">Shop</a></td></tr>',
        no_cash=("offers only", "unknown")),
    "giftcards": Shape(
        '<div id="promo-bar-other">',
        '<div class="cat-selection card-img-holder"><a href="/s/{k}">{n} Gift Cards</a><span class="card-details-text">{c} discount</span>'
        '<span class="card-details-text">({s}) in stock</span></div>', "</div>", "http://www.giftcards.com/s/",
        bare='<div class="cat-selection cat_promo_priority card-img-holder"><a href="/s/{k}">{n} Gift Cards</a></div>',
        where=BARE_OR_IN_STOCK),
    "giftcardspread": Shape(
        "<span>", '<li><a href="s/{k}"><img src="i.png"></a><a href="s/{k}">{n} ({s})</a><span class="off">{c} OFF</span></li>', "</span>",
        "https://giftcardspread.com/s/", bare='<li><a href="s/{k}"><img src="i.png"></a><a href="s/{k}">{n} ({s})</a></li>'),
    "giftcardzen": Shape(
        '<ul id="merchants-to-sell">', '<li><a href="/s/{k}"><span class="name">{n} Gift Cards</span><span class="off">{c} Off</span></a></li>',
        "</ul>", "http://www.giftcardzen.com/s/", bare='<li><a href="/s/{k}"><span class="name">{n} Gift Cards</span></a></li>'),
    "mrrebates": Shape(
        "<table>", '<tr class="odd"><td><a href="/s/{k}"><b>{n}</b></a></td><td class="r">{c}</td></tr>', "</table>", "http://mrrebates.com/s/",
        bare='<tr class="even"><td><a href="/s/{k}"><b>{n}</b></a></td></tr>', no_cash=("", "")),
    "pandacashback": Shape(
        "<div>", '<div class="featuerd_box"><a href="../s/{k}">{n} </a><span class="price_tag">{c} Cash Back</span></div>', "</div>",
        "http://www.pandacashback.com/s/", bare='<div class="featuerd_box"><a href="../s/{k}">{n} </a></div>', no_cash=("NA", "unknown")),
    "raise": Shape(
        '<div class="row-fluid"><ul>',
        '<li class="product-source"><a href="/s/{k}"><div class="name">{n} Gift Cards (Online Only)</div></a><div class="info">({s}) up to {c} Off</div></li>',
        "</ul></div>", "http://www.raise.com/s/", name="p_name || ' & ' || p_partkey || ' '",
        bare='<li class="product-source"><a href="/s/{k}"><div class="name">{n} Gift Cards (Online Only)</div></a></li>',
        where=BARE_OR_IN_STOCK, dollars=False),
    "rebategiant": Shape(
        '<div class="box list"><table>', '<tr><td><a href="http://r.example/s/{k}"> {n}  </a></td><td><strong>{c}</strong></td></tr>', "</table></div>",
        "http://r.example/s/", bare='<tr><td>no link</td></tr>', where="p_partkey % 7 <> 0"),
    "rescue": Shape(
        '<div class="tab-pane"><ul>', '<li><a href="/s/{k}" title="{n} (Not iTunes)">x</a><span>{c}</span></li>', "</ul></div>",
        "http://www.giftcardrescue.com/s/", bare='<li><a href="/s/{k}" title="{n} (Not iTunes)">x</a></li>',
        name="p_name || '  ' || p_partkey"),
    "savingswatch": Shape(
        "<div>", '<div id="catlistline"><a href="/s/{k}">{n}</a><span class="rebate"><a href="/s/{k}">up to {c}</a></span></div>', "</div>",
        "http://www.savingswatch.com/s/", bare='<div id="catlistline"><a href="/s/{k}">{n}</a></div>', cash="up to {c}"),
    "topcashback": Shape(
        "<div>", '<div class="offerlist-container"><div class="offerlist-description"><a href="/s/{k}"><span class="offerlist-description-title">{n} Cashback'
        '</span></a></div><span class="rate">{c}</span></div>', "</div>", "http://www.topcashback.com/s/",
        bare='<div class="offerlist-container"><div class="offerlist-description"><a href="/s/{k}"><span class="offerlist-description-title">{n} Cashback'
        "</span></a></div></div>", no_cash=("NA", "unknown")),
}

RETAIL = Shape(
    '<ul class="ProductList ">',
    '<li><a href="/p/{k}">x</a><div class="ProductDetails"><a href="/p/{k}">${r} {p} Gift Card</a></div><strike class="RetailPriceValue">${r}.00</strike> ${d}.00<br></li>',
    "</ul>", "/p/",
    bare='<li><a href="/p/{k}">x</a><div class="ProductDetails"><a href="/p/{k}">${r} {p} Card</a></div><em>${d}</em></li>')


def _values() -> dict[str, Column]:
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    retail = F.when(F.col("p_size") % 2 == 0, 16).otherwise(20)
    return {
        "n": F.concat(F.col("p_name"), F.lit(" &amp; "), key), "k": key, "s": (F.col("p_partkey") % 5).cast("string"),
        "c": F.when(F.col("p_partkey") % 2 == 0, F.concat(size, F.lit("%"))).otherwise(F.concat(F.lit("$"), size)),
        "p": F.col("p_name"), "r": retail.cast("string"), "d": (F.col("p_partkey") % 16).cast("string"),
    }


def render(template: str) -> Column:
    """A template with {x} places as one concatenation."""
    values = _values()
    pieces = re.split(r"\{([a-z])\}", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)])


def listing_pages(spark: SparkSession, sf_dir: str, site: str, shape: Shape) -> DataFrame:
    """Pages (page_id, site, url, html) of at most 40 blocks each."""
    block = render(shape.block)
    if shape.bare is not None:
        block = F.when(F.col("p_partkey") % 7 == 0, render(shape.bare)).otherwise(block)
    rows = table(spark, sf_dir, "part").select(
        F.floor(F.col("p_partkey") / PER_PAGE).alias("page_id"), F.struct("p_partkey", block.alias("b")).alias("row"))
    pages = rows.groupBy("page_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: r["b"]), "")
    return pages.select(
        "page_id", F.lit(site).alias("site"), F.concat(F.lit(f"http://{site}.example/"), F.col("page_id")).alias("url"),
        F.concat(F.lit("<html><body>" + shape.open), body, F.lit(shape.close + "</body></html>")).alias("html"))


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One store page per part with several discounts."""
    html = F.concat(
        F.lit('<div class="alert_header"><h1>'), _values()["n"], F.lit(' Gift Cards</h1></div><table><tbody><tr><td class="save">0.5%</td></tr>'
              '<tr><td class="save">'), F.col("p_size").cast("string"), F.lit('.25%</td></tr><tr><td class="x">99%</td></tr></tbody></table>'))
    return dealt_parts(spark, sf_dir).select(
        F.col("p_partkey").alias("page_id"), F.lit("giftcardgranny").alias("site"),
        F.concat(F.lit("http://g.example/"), "p_partkey").alias("url"), html.alias("html"))


def expected(site: str, shape: Shape) -> str:
    """SQL over part for the offers of a site."""
    sign = "'$' || p_size" if shape.dollars else "CAST(p_size AS VARCHAR)"
    text = f"CASE WHEN p_partkey % 2 = 0 THEN p_size || '%' ELSE {sign} END"
    cash = " || ".join(f"({text})" if p == "{c}" else f"'{p}'" for p in re.split(r"(\{c\})", shape.cash) if p)
    odd = "Absolute Cash Back" if shape.dollars else "unknown"
    bare = "false" if shape.bare is None else "p_partkey % 7 = 0"
    return f"""
SELECT {shape.name} AS store_name, CASE WHEN {bare} THEN '{shape.no_cash[0]}' ELSE {cash} END AS cash_back,
  '{shape.url}' || p_partkey AS url,
  CASE WHEN {bare} THEN '{shape.no_cash[1]}' WHEN p_partkey % 2 = 0 THEN 'Percentage Cash Back' ELSE '{odd}' END AS category,
  '{site}' AS site
FROM part WHERE {shape.where}"""


EXPECTED_RETAIL = """
SELECT '$' || r || ' ' || p_name AS store_name, CAST(round((r - d) / r * 100, 2) AS VARCHAR) || '%' AS cash_back, '/p/' || p_partkey AS url,
  'Percentage Cash Back' AS category, 'cardsnagger' AS site
FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN 16.0::DOUBLE ELSE 20.0::DOUBLE END AS rd, CASE WHEN p_size % 2 = 0 THEN 16 ELSE 20 END AS r,
      (p_partkey % 16)::DOUBLE AS d FROM part)"""

EXPECTED_BEST = """
SELECT p_name || ' & ' || p_partkey AS store_name, CASE WHEN p_size < 1 THEN '0.5' ELSE p_size || '.25' END || '%' AS cash_back,
  'http://g.example/' || p_partkey AS url, 'Percentage Cash Back' AS category, 'giftcardgranny' AS site FROM part"""
