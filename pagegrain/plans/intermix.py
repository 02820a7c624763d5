"""Fashion products with colour swatches and a menu object per page.

Sightings from listing pages, facts from detail pages, images from image-set pages. The menu object, the
swatches and the sizes of a product come from one page, so they are put together inside its row; only
sightings, details and images are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagegrain.functions import text as X
from pagegrain.functions.catalog import base_sku_from_scene, brand_text, image_list
from pagegrain.functions.markup import parse_any, parse_js, script_var, size_item, stock_flag
from pagegrain.functions.price import availability, first_non_empty
from pagegrain.functions.urls import absolute_url, schemeless
from pagegrain.operators import nodes as N
from pagegrain.operators.filters import sellable
from pagegrain.operators.joins import drop_ignored, spread_nulls
from pagegrain.operators.nested import object_values, swatch_rows, variant_entries, with_color_sku
from pagegrain.operators.options import has_price, size_names, skus_of
from pagegrain.operators.quality import Facts, reject_rows, with_failed
from pagegrain.operators.sets import first_sightings, mini_and_full
from pagegrain.operators.windows import newest, newest_row
from pagegrain.schemas import PRODUCTS, conform
from pagegrain.session import scratch_path

T_ = N.Test
# Url bases, selectors, script patterns and the country to currency table.
BASE_URL = "http://www.intermixonline.com"
IMAGE_BASE = "http://intermix.scene7.com/is/image/"
IMAGE_QUERY = "?req=imageset,javascript"
GENDER = "women"
AJAX_URL = "http://www.intermixonline.com/categoryproductviewall.do?subCategoryCode="
MENU_CALL = "buildDependentOptionMenuObjects\\((.*?)\\)"
MENU = (
    "struct<aOptionTypes:struct<`1`:struct<options:map<string,struct<sOptionName:string,iOptionPk:string>>>>,"
    "aOptionSkus:map<string,struct<iSkuPk:string,skuPrice:string,inStock:string,"
    "skuOptions:struct<`0`:struct<iOptionPk:string>,`1`:struct<iOptionPk:string>>>>>"
)
CATEGORY_VARS = ("CurrentCat=([0-9]{2,8})", "currentSubCategoryCode\\s*=\\s*[\"']([^\"']*)[\"']")
LOOK_BOX, LOOK_ROW = T_("div", "id", "starts", "nDiv"), T_("div", "class", "eq", "directoryProductRow2")
GRID_BOX, THUMB = T_("div", "id", "starts", "all"), T_("div", "class", "eq", "thumbdiv")
THUMB_INFO, THUMB_HEAD = T_("div", "class", "eq", "thumbInfo"), T_("div", "class", "eq", "thumbheader")
BOX = T_("div", "class", "eq", "contentContainer")
NAME, BRAND = T_("div", "itemprop", "eq", "name"), T_("div", "itemprop", "eq", "brand")
PRICE_BOX, WAS = T_("div", "class", "eq", "productPrice"), T_("span", "class", "eq", "pricewas")
SALE, SINGLE = T_("span", "class", "eq", "pricesale"), T_("span", "id", "eq", "productPricing")
DESC_BOX, DESC = T_("div", "id", "eq", "productDesc"), T_("div", "itemprop", "eq", "description")
KEYWORDS = T_("meta", "name", "eq", "keywords")
BADGE, ALERT = T_("div", "class", "eq", "productName badgeIds"), T_("span", "class", "eq", "messagealert")
FLYOUT = T_("div", "id", "eq", "flyoutLargeImage_id")
RIGHT, SWATCH = T_("div", "class", "starts", "pdpRight"), T_("img", "class", "starts", "swatch")
CURRENCIES = {
    "AG": "USD", "AW": "USD", "AU": "AUD", "AT": "EUR", "BH": "BHD", "BD": "BDT", "BB": "BBD", "BE": "EUR",
    "BZ": "BZD", "BM": "USD", "BO": "BOB", "BR": "USD", "BN": "USD", "BG": "BGN", "KH": "KHR", "CA": "CAD",
    "KY": "KYD", "CL": "CLP", "CN": "CNY", "CO": "COP", "CR": "CRC", "HR": "HRK", "CY": "EUR", "CZ": "CZK",
    "DK": "DKK", "DM": "USD", "DO": "DOP", "EC": "USD", "EG": "EGP", "SV": "USD", "EE": "EUR", "FI": "EUR",
    "FR": "EUR", "GF": "EUR", "DE": "EUR", "GI": "GBP", "GR": "EUR", "GD": "USD", "GP": "EUR", "GT": "GTQ",
    "GG": "GBP", "HN": "HNL", "HK": "HKD", "HU": "HUF", "IS": "EUR", "IN": "INR", "ID": "IDR", "IE": "EUR",
    "IL": "ILS", "IT": "EUR", "JM": "JMD", "JP": "JPY", "JE": "GBP", "JO": "JOD", "KR": "KRW", "KW": "KWD",
    "LV": "EUR", "LI": "CHF", "LT": "LTL", "LU": "EUR", "MO": "GKD", "MV": "MVR", "MT": "EUR", "MQ": "EUR",
    "MX": "MXN", "MC": "EUR", "MS": "USD", "NL": "EUR", "NZ": "NZD", "NI": "NIO", "NO": "NOK", "OM": "OMR",
    "PK": "PKR", "PA": "PAB", "PY": "PYG", "PE": "PEN", "PH": "PHP", "PL": "PLN", "PT": "EUR", "QA": "QAR",
    "RO": "RON", "RU": "RUB", "RE": "EUR", "KN": "USD", "LC": "USD", "SA": "SAD", "SG": "SGD", "SK": "EUR",
    "SI": "EUR", "ZA": "ZAR", "ES": "EUR", "LK": "LKR", "SE": "SEK", "CH": "CHF", "TW": "TWD", "TH": "THB",
    "TT": "USD", "TR": "TRY", "TC": "USD", "AE": "AED", "GB": "GBP", "US": "USD",
}
COUNTRY_PAGE = BASE_URL + "/basket.do?method=updateCountry&loc=landing"

IDS = ["page_id", "url", "referer", "country_code", "language", "currency", "category_path", "fetched_at"]
DETAIL_IDS = ["country_code", "url", "page_id", "fetched_at"]
LISTING_TESTS = [LOOK_BOX, LOOK_ROW, GRID_BOX, THUMB, THUMB_INFO, THUMB_HEAD, T_("a"), T_("img")]
DETAIL_TESTS = [BOX, NAME, BRAND, PRICE_BOX, WAS, SALE, SINGLE, DESC_BOX, DESC, KEYWORDS, BADGE, ALERT, FLYOUT, RIGHT,
                T_("img", "class", "starts", "swatch", markup=True), T_("a"), T_("img"), T_(N.TEXT)]


def sightings(pages: DataFrame) -> DataFrame:
    """One row per product link of a listing page, with its key and category path."""
    docs = N.parse_nodes(pages, LISTING_TESTS, IDS, marked=True)
    nodes = N.tested(LISTING_TESTS)
    anchors = N.select(nodes, T_("a"))
    look_links = N.children(N.under(nodes, LOOK_BOX, LOOK_ROW), anchors)
    staged = docs.select(
        *IDS, N.values(look_links, "href").alias("look"),
        N.values(N.children(look_links, N.select(nodes, T_("img"))), "id").alias("look_ids"),
        N.values(N.descendants(N.under(nodes, GRID_BOX, THUMB, T_("a")), N.select(nodes, T_("img"))), "src").alias("src"),
        N.values(N.descendants(N.under(nodes, GRID_BOX, THUMB_INFO, THUMB_HEAD), anchors), "href").alias("grid"))
    is_look = F.size("look") > 0
    rows = N.zip_explode(staged, link=F.when(is_look, F.col("look")).otherwise(F.col("grid")),
                         img=F.when(is_look, F.col("look")).otherwise(F.col("src")), img_id="look_ids")
    rows = rows.where(F.col("link").isNotNull())
    below = F.filter("category_path", lambda x: F.length(x) > 0)
    path = F.concat(F.array(F.lit(GENDER)), F.coalesce(below, F.array().cast("array<string>")))
    return rows.select(
        *IDS, "pos", absolute_url(F.col("link"), BASE_URL, force=False).alias("link"),
        F.coalesce(base_sku_from_scene(F.col("img"), F.col("img_id")), F.col("img")).alias("base_sku"),
        F.transform(path, F.lower).alias("category_identifiers"),
        F.transform(path, X.title_case).alias("category_names"))


def listing_items(rows: DataFrame) -> DataFrame:
    """Sightings under the names of the product table."""
    return rows.withColumnsRenamed({"language": "language_code", "url": "referer_url", "link": "url"})


def _menu_skus(menu: Column) -> Column:
    """Skus of the menu object as (color_option, size, stock, price) with their size names."""
    skus = F.transform(object_values(menu["aOptionSkus"]), lambda s: F.struct(
        s["skuOptions"]["0"]["iOptionPk"].alias("color_option"),
        s["skuOptions"]["1"]["iOptionPk"].alias("size_option"),
        stock_flag(s["inStock"]).alias("stock"), s["skuPrice"].alias("price")))
    return size_names(skus, object_values(menu["aOptionTypes"]["1"]["options"]))


def menu_entries(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, rejects) of the menu objects of detail pages, whatever their shape: page_id, part (first-level key), key, value as JSON.

    A menu that cannot be read at all is a reject. For menus of the known shape ``detail_facts`` reads typed values.
    """
    body = parse_any(script_var(F.col("html"), MENU_CALL)).alias("menu")
    menus = pages.where(F.col("page_type") == "detail").select("page_id", "url", script_var(F.col("html"), MENU_CALL).isNotNull().alias("shown"), body)
    parts = variant_entries(menus, "menu", ["page_id"]).select("page_id", F.col("key").alias("part"), "value")
    entries = variant_entries(parts, "value", ["page_id", "part"]).select("page_id", "part", "key", F.to_json("value").alias("value"))
    return entries, reject_rows(menus, "page_id", "url", {"menu": F.col("shown") & F.col("menu").isNull()})


def _swatches(skus: Column, country: Column) -> Column:
    """Colours of the page with their size entries; a colour without skus keeps an empty list."""
    images = F.col("swatch_nodes")

    def one(img: Column, all_skus: Column) -> Column:
        option = X.group(img["outer"], "swatchClicked\\((.*?)\\)")
        mine = skus_of(option, all_skus)
        return F.struct(
            X.group(F.try_element_at(img["attrs"], F.lit("onclick")), "changeAltImages\\(.*?,'(.*?)'\\)").alias("color_code"),
            F.try_element_at(img["attrs"], F.lit("title")).alias("color_name"),
            F.transform(mine, lambda s: size_item(s["size"], country, s["stock"], s["price"], s["price"]))
            .alias("size_infos"),
            has_price(mine).alias("use_size_level_prices"))

    return F.transform(images, lambda img: one(img, skus))


def detail_facts(pages: DataFrame) -> DataFrame:
    """Facts of the detail pages, whether they could be read or not."""
    docs = N.parse_nodes(pages, DETAIL_TESTS, DETAIL_IDS, with_html=True, marked=True)
    nodes, html = N.tested(DETAIL_TESTS), F.col("norm_html")

    def price(test: N.Test) -> Column:
        return N.texts_under(nodes, BOX, PRICE_BOX, test)

    def one_text(*lists: str) -> Column:
        return F.array(X.clean(F.array_join(first_non_empty(*[F.col(c) for c in lists]), "")))

    image = N.values(N.descendants(N.under(nodes, BOX, FLYOUT), N.select(nodes, T_("img"))), "src")
    # lists become columns first, so that choosing among them does not select them again
    lists = docs.select(
        *DETAIL_IDS, N.texts_under(nodes, BOX, NAME).alias("title"),
        N.texts_under(nodes, BOX, BRAND, T_("a")).alias("brand_links"), N.texts_under(nodes, BOX, BRAND).alias("brand_texts"),
        price(SALE).alias("sale_texts"), price(WAS).alias("was_texts"), price(SINGLE).alias("single_texts"),
        F.get(N.texts_under(nodes, BADGE), F.lit(0)).alias("badge"), (N.count(N.select(nodes, ALERT)) > 0).alias("alert"),
        N.own_texts(nodes, BOX, DESC_BOX, DESC).alias("panels"), N.values(N.select(nodes, KEYWORDS), "content").alias("keywords"),
        F.transform(F.slice(image, 1, 1), schemeless).alias("primary_image"),
        script_var(html, "assetProductCode = \"(.*)\"").alias("asset"),
        script_var(html, MENU_CALL).alias("menu_text"), N.under(nodes, RIGHT, SWATCH).col.alias("swatch_nodes"))
    facts = lists.select(
        *DETAIL_IDS, "title", brand_text(F.col("brand_links"), F.col("brand_texts")).alias("brand"),
        one_text("sale_texts", "single_texts").alias("sale"), one_text("was_texts", "single_texts").alias("was"), "badge", "alert",
        X.description(F.col("panels")).alias("description_text"), "keywords", "primary_image", "asset", "menu_text",
        parse_js(F.col("menu_text"), MENU).alias("menu"), "swatch_nodes")
    sized = facts.select("*", _menu_skus(F.col("menu")).alias("skus"))
    state = availability(F.col("sale"), F.col("was"), F.lit(False), F.col("badge"), F.col("alert"), "[0-9,.]")
    swatches = F.when(F.col("menu").isNotNull(), _swatches(F.col("skus"), F.col("country_code")))
    return sized.select(*DETAIL_IDS, "title", "brand", "description_text", "keywords", "primary_image",
                        "asset", state.alias("state"), swatches.alias("swatches"),
                        (F.col("menu_text").isNotNull() & F.col("menu.aOptionSkus").isNull()).alias("lost_menu"))


def image_rows(pages: DataFrame) -> DataFrame:
    """Image-set pages: image_url and images."""
    data = X.group(F.col("html"), "'(.*)'")
    return pages.select(F.col("url").alias("image_url"), "url", "page_id", "fetched_at", data.isNull().alias("lost"),
                        image_list(data, F.lit(IMAGE_BASE), "", None, skip_first=False).alias("images"))


def image_sets(rows: DataFrame) -> DataFrame:
    """The newest image set per url."""
    return newest(rows.select("image_url", "page_id", "fetched_at", "images"), ["image_url"]).drop("page_id", "fetched_at")


def facts(pages: DataFrame, staging: str | None = None) -> Facts:
    """What the pages of each kind say, as written tables with the checks that failed: links without key, details without title or
    with a menu that cannot be read, image sets that cannot be read."""
    def of(kind: str) -> DataFrame:
        return pages.where(F.col("page_type") == kind)

    return Facts({
        "listing": with_failed(sightings(of("listing")), {"listing": F.col("base_sku").isNull()}),
        "detail": with_failed(detail_facts(of("detail")), {"title": F.size("title") == 0, "menu": F.col("lost_menu")}),
        "images": with_failed(image_rows(of("images")), {"images": F.col("lost")}),
    }, staging or scratch_path(pages.sparkSession, "facts"))


def rejects(pages: DataFrame, staging: str | None = None) -> DataFrame:
    """Pages and links that gave nothing: page_id, url, stage, reason."""
    return facts(pages, staging).rejects()


def products(pages: DataFrame, staging: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(sightings, products) of routed pages with their country, language, currency and category path."""
    return products_of(facts(pages, staging))


def products_of(read: Facts) -> tuple[DataFrame, DataFrame]:
    """(sightings, products) of the facts."""
    listing = read.good("listing").drop("row_id")
    first = listing_items(first_sightings(listing, ["fetched_at", "page_id", "pos"]))
    detail = newest_row(read.good("detail"), ["country_code", "url"]).drop("page_id", "fetched_at", "row_id", "lost_menu")
    found = first.join(detail, ["country_code", "url"]).where(sellable(F.col("title"), F.col("base_sku")))
    rows = swatch_rows(found, "swatches")
    code = F.col("color_code")
    asset = F.concat(F.lit(IMAGE_BASE), "asset", F.lit(IMAGE_QUERY))
    recolored = F.regexp_replace(asset, F.lit("_[0-9]{3,4}\\?"), F.concat(F.lit("_"), code, F.lit("?")))
    rows = rows.withColumn("image_url", spread_nulls(F.when(code.isNull(), asset).otherwise(recolored), F.col("url")))
    full = rows.join(image_sets(read.good("images")), "image_url", "left")
    out = with_color_sku(full).select(
        "*", F.col("state.price").alias("new_price_text"), F.col("state.full_price").alias("full_price_text"),
        F.when(code.isNull(), F.lit(False)).otherwise(F.col("state.available")).alias("available"),
        F.lit(GENDER).alias("gender_names"),
        F.when(F.size(F.coalesce("images", F.array())) > 0, F.col("images")).otherwise(F.col("primary_image"))
        .alias("image_urls"))
    return listing_items(listing), conform(out.withColumn("item_kind", F.lit("full")), PRODUCTS)


def catalogue(pages: DataFrame, staging: str | None = None, ignore: DataFrame | None = None) -> DataFrame:
    """Mini items of every sighting and full items of the first ones."""
    if ignore is not None:
        pages = drop_ignored(pages, ignore)
    listing, full = products(pages, staging)
    return conform(mini_and_full(listing, full), PRODUCTS)
