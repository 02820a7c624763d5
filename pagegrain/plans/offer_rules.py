"""The site rules of the offer jobs.

A rule names the blocks of a page and gives, per output field, a short chain of column functions. A site is
added by adding a rule.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagegrain.functions import price as P
from pagegrain.functions import text as X
from pagegrain.functions.urls import drop_parent_dots
from pagegrain.operators.nodes import Test

Step = Callable[[Column], Column]


def chain(*steps: Step) -> Step:
    def run(c: Column) -> Column:
        for step in steps:
            c = step(c)
        return c

    return run


def find(pattern: str) -> Step:
    return lambda c: X.find(c, pattern)


def nth(pattern: str, n: int) -> Step:
    return lambda c: X.find_nth(c, pattern, n)


def drop(*words: str, cap: int | None = 2) -> Step:
    return lambda c: X.drop_words(c, words, cap)


def drop_all(*words: str) -> Step:
    return drop(*words, cap=None)


def amp(cap: int | None = None) -> Step:
    return lambda c: X.decode_amp(c, cap)


def cut_end(suffix: str) -> Step:
    return lambda c: X.drop_suffix(c, suffix)


def cut_start(prefix: str) -> Step:
    return lambda c: X.drop_prefix(c, prefix)


inner, quoted, trim, amp_twice = X.inner_text, X.quoted, X.trim_one, X.decode_amp_twice

CLASSIFY = None


@dataclass(frozen=True)
class OfferRule:
    """How one site's blocks become offers.

    The anchor pattern guards link and name: without it both are empty. ``link_from`` and ``name_from`` replace
    the anchor by a pattern of their own on the block; the ``_in_block`` flags make a chain start from the whole
    block instead of from what its guard matched. Cash alternatives are (guard pattern, steps) in order;
    ``no_cash`` is (text, category) when none matches, category ``CLASSIFY`` meaning the usual classes. A step
    that finds nothing after its guard did makes the row a reject.
    """

    site: str
    hosts: tuple[str, ...]
    blocks: tuple[Test, ...]
    within: tuple[Test, ...] = ()
    base: str = ""
    anchor: str = '<a href.*?</a>'
    link_from: str | None = None
    link: Step = quoted
    name_from: str | None = None
    name: Step = inner
    cash: tuple[tuple[str, Step], ...] = ()
    no_cash: tuple[str, str | None] = ("", CLASSIFY)
    stock_from: str | None = None
    stock: Step | None = None
    link_in_block: bool = False
    name_in_block: bool = False
    cash_in_block: bool = False
    needs_anchor: bool = False
    min_name: int = 0
    aux: tuple[Test, ...] = ()
    aux_text: str = ""
    custom: str | None = None
    letters: tuple[str, str, bool] | None = field(default=None)  # listing url, digit token, upper case

    @property
    def tests(self) -> list[Test]:
        """Everything the parse stage has to return for this site."""
        with_markup = [Test(t.tag, t.attr, t.op, t.value, markup=True) for t in self.blocks]
        texts = [Test("#text", "@path", "ends", self.aux_text)] if self.aux_text else []
        return with_markup + list(self.within) + list(self.aux) + texts


def _div(value: str) -> Test:
    return Test("div", "class", "eq", value)


def _tr(value: str) -> Test:
    return Test("tr", "class", "eq", value)


HREF = 'href=".*?</a>'
A_HREF = "<a href.*?>"
AFTER_SECOND_BR = "<br>.*?<br>.*?<"

# Selectors, patterns, url bases and phrases each site's markup is read with.
RULES: tuple[OfferRule, ...] = (
    OfferRule(
        "abcgiftcards", ("abcgiftcards.com",),
        within=(Test("div", "id", "eq", "indexCategories"),), blocks=(_div("categoryListBoxContents"),),
        anchor=HREF, name=chain(find('title=".*?"'), find('".*?"'), amp(2), drop_all('"'), trim),
        cash=((AFTER_SECOND_BR, chain(cut_start("<br>"), inner, drop("OFF"), trim)),
              ("</br.*?<", chain(inner, drop("OFF"), trim))),
    ),
    OfferRule(
        "befrugal", ("befrugal.com",), blocks=(_tr("storeTable-row1"), _tr("storeTable-row2")),
        base="http://www.befrugal.com/crumbs/", name=chain(inner, amp_twice),
        cash=(("<p.*?</p>", inner),), no_cash=("NA", "unknown"),
        letters=("http://www.befrugal.com/coupons/stores/", "num", True),
    ),
    OfferRule(
        "bigcrumbs", ("bigcrumbs.com",), blocks=(_div("listingItem listingItemRetailer"),),
        base="http://www.bigcrumbs.com/crumbs/", name=chain(inner, amp_twice),
        cash=(('<div class="crumbEarner">.*?</div>', chain(find('class="amount">.*?<'), inner)),),
        no_cash=("", ""), letters=("http://www.bigcrumbs.com/crumbs/retailers.do?startsWith=", "0", True),
    ),
    OfferRule(
        "cactus", ("couponcactus.com",), blocks=(_tr("spon body-content"), _tr(" body-content")),
        base="http://www.couponcactus.com", anchor=HREF, name=chain(inner, amp_twice, cut_end(" coupons")),
        cash_in_block=True, cash=(("<td .*?</td>", chain(nth("<td .*?</td>", 1), inner)),),
    ),
    OfferRule(
        "cardcash", ("cardcash.com",),
        within=(Test("div", "id", "eq", "merchants_list"),), blocks=(_div("categoryListBoxContents"),),
        anchor=HREF, name=chain(find('title=".*?"'), quoted, trim),
        cash=((AFTER_SECOND_BR, chain(cut_start("<br>"), inner, drop("OFF"), cut_end(" "))),
              ("</br2>.*?<", chain(inner, drop("OFF"), cut_end(" ")))),
    ),
    OfferRule(
        "cardpool", ("cardpool.com",),
        within=(Test("table", "class", "eq", "bottom merchants_grid"),), blocks=(Test("td"),),
        base="http://www.cardpool.com", anchor=HREF,
        name=chain(find('class="merchant_link_name_text".*?<'), find(">.*?\\("), drop("Gift Cards"), amp(),
                   drop("("), drop_all(">", "<"), trim, drop_all('"')),
        cash=(('class="merchant_discount">.*?<', chain(inner, drop("Off"), cut_end(" "))),),
        stock_from=HREF, stock=chain(find('class="merchant_link_name_text".*?<'), inner, X.in_parens),
    ),
    OfferRule(
        "cardsnagger", ("cardsnagger.com",),
        within=(Test("ul", "class", "eq", "ProductList "),), blocks=(Test("li"),),
        anchor=HREF, aux=(_div("ProductDetails"),), aux_text="/a/text()", custom="retail",
        name=chain(drop("Gift Card"), drop_all("Card"), trim),
        cash=(('class="RetailPriceValue">.*?<', chain(inner, drop_all('"', "$"), trim)),),
    ),
    OfferRule(
        "ebates", ("ebates.com",), within=(Test("table", "id", "eq", "moreStoresTable"),), blocks=(Test("tr"),),
        base="http://www.ebates.com", anchor='class="storeName".*?</td>',
        link=chain(find("href=.*?<"), find("href=.*?>"), drop_all(">", "href=", '"')),
        name=chain(find("href=.*?<"), inner, amp_twice, find(".*?\n"), drop("Coupons"), drop_all("\n\n"),
                   drop("\n"), drop_all("\r"), cut_end("  "), cut_end(" ")),
        cash=(('target="_blank">.*?<', inner),), no_cash=("", ""), min_name=2,
    ),
    OfferRule(
        "fatwallet", ("fatwallet.com",),
        blocks=(_tr("storeListRow"), _tr("storeListRow even"), _tr("storeListRow even last"),
                _tr("storeListRow last")),
        base="http://fatwallet.com", link_from=A_HREF, name_from='class="storeListStoreName">.*?<',
        name=chain(inner, amp_twice),
        cash=(('class="storeListCashbackText">.*?<', inner), ('class="storeListCashbackSaleText">.*?<', inner)),
        no_cash=("offers only", CLASSIFY),
    ),
    OfferRule(
        "giftcardgranny", ("giftcardgranny.com",), within=(_div("alert_header"),), blocks=(Test("h1"),),
        aux=(Test("td", "class", "eq", "save"), Test("tbody")), aux_text="/td/text()", custom="best",
        name=chain(drop("Gift Cards"), drop_all("<"), trim),
    ),
    OfferRule(
        "giftcards", ("giftcards.com",), within=(Test("div", "id", "eq", "promo-bar-other"),),
        blocks=(_div("cat-selection card-img-holder"), _div("cat-selection cat_promo_priority card-img-holder")),
        base="http://www.giftcards.com", anchor=HREF,
        name=chain(inner, drop("Gift Cards"), amp(), trim),
        cash=(('class="card-details-text".*?<', chain(inner, drop("discount"), cut_end(" "))),),
        stock_from='class="card-details-text".*?<',
        stock=chain(nth('class="card-details-text".*?<', 1), inner, X.in_parens),
    ),
    OfferRule(
        "giftcardspread", ("giftcardspread.com",), within=(Test("span"),), blocks=(Test("li"),),
        base="https://giftcardspread.com/", anchor=HREF, name_in_block=True,
        name=chain(find('href=".*</a>'), cut_start("href"), find('href=".*</a>'), find(">.*?\\("), drop("("),
                   drop_all(">"), amp(2), drop_all('"'), trim),
        cash=(("<span .*?</span>", chain(inner, drop("OFF"), trim, drop(" "))),),
    ),
    OfferRule(
        "giftcardzen", ("giftcardzen.com",), within=(Test("ul", "id", "eq", "merchants-to-sell"),),
        blocks=(Test("li"),), base="http://www.giftcardzen.com", anchor=HREF, name_in_block=True,
        name=chain(find('class="name">.*?<'), inner, drop("Gift Cards"), amp(), trim),
        cash=(('class="off".*?<', chain(inner, drop("Off"), cut_end(" "))),),
    ),
    OfferRule(
        "mrrebates", ("mrrebates.com",), blocks=(_tr("even"), _tr("odd")), base="http://mrrebates.com",
        link_from=A_HREF, name_from="<b>.*?</b>", name=chain(drop("</b>"), drop_all("<b>"), amp_twice),
        cash=(('class="r">.*?<', inner),), no_cash=("", ""),
        letters=("http://mrrebates.com/merchants/all_merchants_tabbed.asp?letter=", "#", False),
    ),
    OfferRule(
        "pandacashback", ("pandacashback.com",), blocks=(_div("featuerd_box"),),
        base="http://www.pandacashback.com", anchor='<a href=".*?</a>', link=chain(quoted, drop_parent_dots),
        name=chain(inner, amp_twice, cut_end(" ")),
        cash=(('class="price_tag">.*?<', chain(inner, cut_end(" Cash Back"))),), no_cash=("NA", "unknown"),
        letters=("http://www.pandacashback.com/retailers.php?letter=", "0-9", True),
    ),
    OfferRule(
        "raise", ("raise.com",), within=(_div("row-fluid"),), blocks=(Test("li", "class", "eq", "product-source"),),
        base="http://www.raise.com", anchor=HREF,
        name=chain(find('class="name".*?<'), inner, drop("Gift Cards"), drop_all("(In Store Only)"), amp(2),
                   drop_all("(Online Only)"), drop("(In Store Use Only)"), cut_start(" "), trim),
        cash=(('class="info">.*?<', chain(find(">.*?<"), find("\\).*?<"), find("[0-9].*?<"), drop("<"),
                                          drop_all(")"), drop("Off"), cut_end(" "))),),
        stock_from='class="info">.*?<', stock=chain(find('class="info">.*?<'), X.in_parens),
    ),
    OfferRule(
        "rebategiant", ("rebategiant.com",), within=(_div("box list"),), blocks=(Test("tr"),),
        anchor="<a href=.*?</a>", link=chain(quoted, drop_all(">>")),
        name=chain(inner, amp(2), cut_start(" "), cut_end("  "), cut_end(" ")),
        cash=(("<strong>.*?</strong>", inner),), no_cash=("", ""), needs_anchor=True,
    ),
    OfferRule(
        "rescue", ("giftcardrescue.com",), within=(_div("tab-pane"),), blocks=(Test("li"),),
        base="http://www.giftcardrescue.com", anchor=HREF,
        name=chain(find('title=".*?"'), find('".*?"'), drop("(Not iTunes)"), drop_all("&amp;"), drop_all('"'), trim),
        cash=(("<span>.*?<", inner),),
    ),
    OfferRule(
        "savingswatch", ("savingswatch.com",), blocks=(Test("div", "id", "eq", "catlistline"),),
        base="http://www.savingswatch.com", anchor="<a href=.*?</a>", link_in_block=True,
        link=chain(find('<a href=".*?"'), quoted),
        name=chain(inner, amp_twice),
        cash=(('class="rebate">.*?</a>', chain(find("href=.*?</a>"), inner)),),
    ),
    OfferRule(
        "topcashback", ("topcashback.com",), blocks=(_div("offerlist-container"),),
        base="http://www.topcashback.com", link_from='class="offerlist-description">.*?</a>', link_in_block=True,
        link=chain(find("<a href=.*?>"), quoted), name_from='class="offerlist-description-title".*?<',
        name=chain(inner, amp_twice, cut_end(" "), drop_all(" Cashback")),
        cash=(('class="rate">.*?<', inner),), no_cash=("NA", "unknown"),
        letters=("http://www.topcashback.com/search/merchants/?letter=", "0", True),
    ),
)

BY_SITE = {r.site: r for r in RULES}


def retail_discount(block: Column, name: Column) -> Column:
    """Discount of the two-price blocks: struck-out price and the next value, else the amount in the name and
    the emphasised price. Null where one of them is missing or no number."""
    tidy = chain(inner, drop_all('"', "$"), trim)
    struck = 'class="RetailPriceValue">.*?<'
    retail = tidy(X.find(block, struck))
    paid = tidy(X.find(X.find(block, struck + ".*?>.*?<"), "<.*?<"))
    named = chain(drop_all('"', "$"), trim)(X.find(name, "\\$.*[0-9]"))
    emphasised = tidy(X.find(block, "<em>.*?</em>"))
    pct = F.when(retail.isNotNull(), P.discount_pct(P.to_number(retail), P.to_number(paid))).otherwise(
        P.discount_pct(P.to_number(named), P.to_number(emphasised)))
    return F.when(named.isNotNull(), pct)
