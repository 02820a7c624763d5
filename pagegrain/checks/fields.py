"""Checks of column functions and predicates (families D, E) and the flagship query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.checks.base import LI, check, dealt_parts, table
from pagegrain.functions import catalog as C
from pagegrain.functions import price as P
from pagegrain.functions import text as X
from pagegrain.functions import urls as U
from pagegrain.operators import filters as E
from pagegrain.operators import nodes as N
from pagegrain.operators.quality import keep_where

LONG = "bigint"


def li_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.simple_blocks(table(spark, sf_dir, "pages").select("page_id", "html"), "li")
    return rows.withColumn("pos", F.col("pos").cast(LONG))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part")


@check("flagship", """
WITH li AS (
  SELECT url, regexp_replace(lower(regexp_extract(url, '://([^/?#:]+)', 1)), '^www\\.', '') AS site,
         regexp_extract(url, '^(https?://[^/]+)', 1) AS origin, unnest(regexp_extract_all(html, '(?is)<li>.*?</li>')) AS block
  FROM pages),
f AS (SELECT site, replace(regexp_extract(block, '<a[^>]*>(.*?)<', 1), '&amp;', '&') AS store_name,
             origin || regexp_extract(block, 'href="(.*?)"', 1) AS url FROM li)
SELECT site, store_name, url, CASE WHEN contains(store_name, '$') THEN 'Absolute Cash Back'
  WHEN contains(store_name, '%') THEN 'Percentage Cash Back' ELSE 'unknown' END AS category FROM f""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(U.site_of(F.col("url")).alias("site"), U.origin(F.col("url")).alias("origin"), "html")
    anchor = X.find(F.col("block"), "<a .*?</a>")
    fields = N.simple_blocks(pages, "li").select(
        "site", X.decode_amp(X.inner_text(anchor)).alias("store_name"),
        U.absolute_url(X.attr_value(anchor, "href"), F.col("origin")).alias("url"))
    return fields.select("site", "store_name", "url", X.cash_category(F.col("store_name")).alias("category"))


@check("d1_first_match", """
SELECT page_id, nullif(regexp_extract(html, '(?is)<H1>.*?</h1>'), '') AS h1, nullif(regexp_extract(html, '(?is)<b>.*?<br>'), '') AS b
FROM pages""")
def d1_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", X.find(html, "<H1>.*?</h1>").alias("h1"), X.find(html, "<b>.*?<br>").alias("b"))


@check("d2_nth_match", """
SELECT page_id, regexp_extract_all(html, '(?is)<p>.*?</p>')[2] AS second, regexp_extract_all(html, '(?is)<p>.*?</p>')[12] AS twelfth
FROM pages""")
def d2_nth_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", X.find_nth(html, "<p>.*?</p>", 1).alias("second"), X.find_nth(html, "<p>.*?</p>", 11).alias("twelfth"))


@check("d3_inner_text", f"""
WITH {LI} SELECT page_id, pos, regexp_extract(block, '<a[^>]*>([^<]*)<', 1) AS text FROM li""")
def d3_inner_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return li_blocks(spark, sf_dir).select("page_id", "pos", X.inner_text(X.find(F.col("block"), "<a .*")).alias("text"))


@check("d4_attr", f"""
WITH {LI} SELECT page_id, pos, regexp_extract(block, 'href="(.*?)"', 1) AS href, CAST(NULL AS VARCHAR) AS title FROM li""")
def d4_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = F.col("block")
    return li_blocks(spark, sf_dir).select("page_id", "pos", X.attr_value(block, "href").alias("href"),
                                           X.attr_value(block, "title").alias("title"))


@check("d5_amp", """
SELECT page_id, replace(html, '&amp;', '&') AS every,
  array_to_string(string_split(html, '&amp;')[1:3], '&') ||
    CASE WHEN len(string_split(html, '&amp;')) > 3 THEN '&amp;' || array_to_string(string_split(html, '&amp;')[4:], '&amp;')
         ELSE '' END AS two
FROM pages""")
def d5_amp(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", X.decode_amp(html).alias("every"), X.decode_amp(html, 2).alias("two"))


@check("d6_replace_n", """
SELECT doc_id, array_to_string(string_split(text, 'e')[1:3], 'E') ||
    CASE WHEN len(string_split(text, 'e')) > 3 THEN 'e' || array_to_string(string_split(text, 'e')[4:], 'e') ELSE '' END AS two,
  array_to_string(string_split(text, '.')[1:19], '') ||
    CASE WHEN len(string_split(text, '.')) > 19 THEN '.' || array_to_string(string_split(text, '.')[20:], '.') ELSE '' END AS many
FROM documents""")
def d6_replace_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.replace_n(text, "e", "E", 2).alias("two"), X.replace_n(text, ".", "", 18).alias("many"))


@check("d7_clean", """
SELECT doc_id, translate(text, chr(9) || chr(10) || chr(13), '') AS cleaned, replace(text, 'the', '') AS without FROM documents""")
def d7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.clean(text).alias("cleaned"), X.replace_all(text, "the").alias("without"))


@check("d8_suffix", """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_name || ' coupons now' END AS name FROM part""")
def d8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, " coupons").otherwise(" coupons now"))
    return parts(spark, sf_dir).select("p_partkey", X.drop_suffix(name, " coupons").alias("name"))


@check("d9_trim", """
SELECT doc_id, ' ' || text AS one, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS whole FROM documents""")
def d9_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.trim_one(F.concat(F.lit("  "), text, F.lit(" "))).alias("one"), X.strip_ws(text).alias("whole"))


@check("d10_noise", """
SELECT p_partkey, p_name || '  ' || p_brand || ' Gift Cards' AS name, CAST(p_size AS VARCHAR) || '% ' AS cash FROM part""")
def d10_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("p_name", F.lit(" Gift Cards "), "p_brand", F.lit("(Online Only)Gift Cards Gift Cards"))
    cash = F.concat(F.col("p_size").cast("string"), F.lit("% OFF"))
    return parts(spark, sf_dir).select("p_partkey", X.drop_words(name, ["Gift Cards", "(Online Only)"]).alias("name"),
                                       X.drop_words(cash, ["OFF"]).alias("cash"))


@check("d11_paren", """
SELECT p_partkey, CAST(p_size AS VARCHAR) AS stock, CAST(NULL AS VARCHAR) AS none FROM part""")
def d11_paren(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("p_name", F.lit(" ("), F.col("p_size").cast("string"), F.lit(") (x)"))
    return parts(spark, sf_dir).select("p_partkey", X.in_parens(text).alias("stock"),
                                       X.in_parens(F.col("p_name")).alias("none"))


@check("d12_category", """
SELECT doc_id, CASE WHEN contains(text, '$') THEN 'Absolute Cash Back' WHEN contains(text, '%') THEN 'Percentage Cash Back'
  ELSE 'unknown' END AS category FROM documents""")
def d12_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.cash_category(F.col("text")).alias("category"))


@check("d13_discount", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_tax = 0 THEN NULL ELSE round((l_tax - l_discount) / l_tax * 100, 2) END AS pct, l_tax = 0 AS undefined
FROM lineitem""")
def d13_discount(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = P.discount_pct(F.col("l_tax"), F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", P.to_number(text).alias("pct"), text.isNull().alias("undefined"))


@check("d14_number", """
SELECT p_partkey, p_retailprice AS price, CAST(p_size AS DOUBLE) AS pct, CAST(NULL AS DOUBLE) AS none,
 CAST(120000 + p_size AS BIGINT) AS digits, '1,234,567,' || p_size || '.50' AS text
FROM part""")
def d14_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    return parts(spark, sf_dir).select(
        "p_partkey", P.to_number(F.concat(F.lit("$"), F.col("p_retailprice").cast("string"))).alias("price"),
        P.to_number(F.concat(size, F.lit("%"))).alias("pct"), P.to_number(F.col("p_name")).alias("none"),
        P.first_digits(F.concat(F.lit("pages: "), (F.col("p_size") + 120000).cast("string"), F.lit(" of 7"))).cast(LONG).alias("digits"),
        P.price_digits(F.concat(F.lit("EUR 1,234,567,"), size, F.lit(".50 each"))).alias("text"))


@check("d15_case", """
SELECT p_partkey, lower(p_name) AS low, upper(p_name) AS up,
  array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') || '''S '
   || p_size || 'Way-' || upper(lower(p_type)[1]) || lower(p_type)[2:] AS title
FROM part""")
def d15_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    text = F.concat(name, F.lit("'s "), F.col("p_size").cast("string"), F.lit("way-"), F.lower("p_type"))
    return parts(spark, sf_dir).select("p_partkey", F.lower(name).alias("low"), F.upper(name).alias("up"),
                                       X.title_case(text).alias("title"))


@check("d16_path", """
SELECT p_partkey, 'women/' || p_type || CASE WHEN p_size % 2 = 0 THEN '/' || p_brand ELSE '' END AS path FROM part""")
def d16_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub = F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("")
    path = C.category_path(F.lit("women"), F.col("p_type"), sub, F.lit(""))
    return parts(spark, sf_dir).select("p_partkey", F.array_join(path, "/").alias("path"))


@check("d17_subcat", """
SELECT p_partkey, p_name AS fr_or_us, 'a b c|' || p_size AS split_rest, p_name AS under_sale FROM part""")
def d17_subcat(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(F.lower("p_brand"), F.lit("-"), F.translate("p_name", " ", "-"))
    country = F.when(F.col("p_size") % 2 == 0, "fr").otherwise("us")
    rest = F.concat(F.lit("shoes-a-b-c--"), F.col("p_size").cast("string"))
    sale = F.concat(F.lit("sale-"), "p_name", F.lit(" sale"))
    return parts(spark, sf_dir).select(
        "p_partkey", F.array_join(C.subcat_label(label, F.lower("p_brand"), country), "|").alias("fr_or_us"),
        F.array_join(C.subcat_label(rest, F.lit("shoes"), F.lit("us")), "|").alias("split_rest"),
        F.array_join(C.subcat_label(sale, F.lit("sale"), F.lit("us")), "|").alias("under_sale"))


@check("d18_sku", """
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'id' || p_partkey WHEN 1 THEN CAST(123450000000 + p_partkey AS VARCHAR)
  ELSE 'k' || p_partkey END AS link_sku, 'img' || p_partkey AS image_sku, 'P' || (100000000 + p_partkey) || 'TAIL' AS scene_sku,
  'X' || p_partkey AS id_sku
FROM part""")
def d18_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, kind = F.col("p_partkey").cast("string"), F.col("p_size") % 3
    link = F.when(kind == 1, F.concat(F.lit("/p/"), (F.col("p_partkey") + 123450000000).cast("string"), F.lit(".html"))).otherwise(
        F.concat(F.lit("/p?dwvar_K"), key, F.lit("_c=1")))
    script_id = F.when(kind == 0, F.concat(F.lit("ID"), key))
    scene = F.concat(F.lit("//i.example/Intermix/PROD_P"), (F.col("p_partkey") + 100000000).cast("string"), F.lit("TAIL_01?w=1"))
    return parts(spark, sf_dir).select(
        "p_partkey", C.base_sku_from_link(link, script_id).alias("link_sku"),
        C.base_sku_from_image(F.concat(F.lit("/a/product/IMG"), key, F.lit("/x.jpg"))).alias("image_sku"),
        C.base_sku_from_scene(scene, F.lit("a_b")).alias("scene_sku"),
        C.base_sku_from_scene(F.lit("/look.html"), F.concat(F.lit("img_X"), key)).alias("id_sku"))


@check("d19_sku_detail", """
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'S' || p_partkey WHEN 1 THEN CAST(10000000 + p_partkey AS VARCHAR)
  ELSE 'T' || p_partkey END AS sku FROM part""")
def d19_sku_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, kind = F.col("p_partkey").cast("string"), F.col("p_size") % 3
    style = F.when(kind == 0, F.concat(F.lit("S"), key)).otherwise("")
    url = F.when(kind == 1, F.concat(F.lit("/p/"), (F.col("p_partkey") + 10000000).cast("string"))).otherwise("/p/x")
    texts = F.array(F.lit("a"), F.concat(F.lit("Style Number: T"), key))
    return parts(spark, sf_dir).select("p_partkey", C.detail_sku(style, url, texts).alias("sku"))


@check("d20_variant_sku", "SELECT l_orderkey, l_linenumber, l_partkey, l_partkey || '_' || l_returnflag AS sku FROM lineitem")
def d20_variant_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        C.variant_sku(F.col("l_partkey").cast("string"), F.col("l_returnflag")).alias("sku"))


@check("d21_price", """
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 's' || p_size ELSE 'o' || p_size END AS new_price,
  CASE p_size % 3 WHEN 1 THEN 'o' || p_size WHEN 0 THEN 's' || p_size ELSE 'o' || p_size END AS old_price,
  'a-' || p_size AS joined
FROM part""")
def d21_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, kind = F.col("p_size").cast("string"), F.col("p_size") % 3
    none = F.array().cast("array<string>")
    sale = F.when(kind == 0, F.array(F.concat(F.lit("s"), size))).otherwise(none)
    old = F.when(kind != 0, F.array(F.concat(F.lit("o"), size), F.lit("other"))).otherwise(none)
    full, new = P.prices([none, sale], [old], None)
    _, joined = P.prices([F.array(F.lit("a"), size)], [none], "-")
    pick = lambda c: F.get(c, F.lit(0))
    return parts(spark, sf_dir).select("p_partkey", pick(new).alias("new_price"), pick(full).alias("old_price"),
                                       pick(joined).alias("joined"))


@check("d22_desc", """
SELECT doc_id, text AS one, 'no description available' AS blank, CASE WHEN doc_id % 2 = 0 THEN 'no description available'
  ELSE text || '|' || lang END AS mixed FROM documents""")
def d22_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = F.when(F.col("doc_id") % 2 == 0, F.array().cast("array<string>")).otherwise(F.array("text", "lang"))
    join = lambda c: F.array_join(X.description(c), "|")
    return table(spark, sf_dir, "documents").select(
        "doc_id", join(F.array("text")).alias("one"), join(F.array(F.lit("\r\n\t"))).alias("blank"), join(mixed).alias("mixed"))


@check("d23_available", """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN false WHEN p_size % 7 = 0 THEN p_size % 2 = 1 WHEN p_size % 11 = 0 THEN false
    ELSE p_size % 3 <> 0 END AS available,
  CASE WHEN p_size % 3 = 0 THEN '0' ELSE '$' || p_size END AS price, CASE WHEN p_size % 3 = 0 THEN '0' ELSE 'full' END AS full_price,
  CAST(CASE WHEN p_size % 5 = 0 THEN 0 ELSE 1 END AS BIGINT) AS stock
FROM part""")
def d23_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    price = F.array(F.when(size % 3 == 0, "call us").otherwise(F.concat(F.lit("$"), size.cast("string"))))
    badge = F.when(size % 7 == 0, F.when(size % 2 == 0, "Preorder now").otherwise("New"))
    state = P.availability(price, F.array(F.lit("full")), size % 5 == 0, badge, size % 11 == 0)
    return parts(spark, sf_dir).select("p_partkey", state.alias("s")).select(
        "p_partkey", "s.available", F.get("s.price", F.lit(0)).alias("price"),
        F.get("s.full_price", F.lit(0)).alias("full_price"), F.col("s.stock").cast(LONG).alias("stock"))


@check("d24_title_parse", """
SELECT p_partkey, p_name AS title, CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'None' END AS flavor,
  CASE WHEN p_size % 3 = 0 THEN '1' ELSE CAST(1000000 + p_size AS VARCHAR) END AS size,
  CASE WHEN p_size % 3 = 0 THEN 'item' ELSE 'Vegetablecapsules' END AS unit
FROM part""")
def d24_title_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat("p_brand", F.lit(" "), "p_name", F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(", "), "p_type")).otherwise(""))
    size = F.when(F.col("p_size") % 3 == 0, " one ").otherwise(F.concat(F.lit(" "), (F.col("p_size") + 1000000).cast("string"), F.lit(" Vegetablecapsules ")))
    return parts(spark, sf_dir).select("p_partkey", C.parse_title(title, F.col("p_brand"), size).alias("t")).select("p_partkey", "t.*")


@check("d25_images", """
SELECT p_partkey, 'i/TB_' || p_partkey || '_001_A?w' AS colored, 'b/A_' || p_size || '|b/B' AS listed FROM part""")
def d25_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    data = F.concat(F.lit("p;p,TB_"), key, F.lit("_001_A;x,TB_"), key, F.lit("_002_A;y"))
    plain = F.concat(F.lit("A_"), F.col("p_size").cast("string"), F.lit(";x,B;y,"))
    return parts(spark, sf_dir).select(
        "p_partkey", F.array_join(C.image_list(data, F.lit("i/"), "?w", F.lit("001"), True), "|").alias("colored"),
        F.array_join(C.image_list(plain, F.lit("b/"), "", None, False), "|").alias("listed"))


@check("d26_image_color", """
SELECT p_partkey, 'a_' || p_size || '_x|b_' || p_size || '?c|d_9' AS recolored, 'p/i?crop$1' AS cropped, 'a|p' AS appended, 'a' AS present
FROM part""")
def d26_image_color(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = F.array(F.lit("a_001_x"), F.lit("b_001?c"), F.lit("d_9"))
    own = F.concat(F.lit("p/i?"), "p_name")
    return parts(spark, sf_dir).select(
        "p_partkey", F.array_join(C.recolor_images(images, F.lit("001"), F.col("p_size").cast("string")), "|").alias("recolored"),
        C.recrop(own, "?crop$1").alias("cropped"),
        F.array_join(C.with_primary(F.array(F.lit("a")), F.array(F.lit("p"))), "|").alias("appended"),
        F.array_join(C.with_primary(F.array(F.lit("a")), F.array(F.lit("a"))), "|").alias("present"))


@check("d27_image_jp", """
SELECT l_partkey, lower(l_returnflag) AS name, arg_max('/img/' || l_orderkey || '_' || l_linenumber || '.jpg', l_orderkey * 8 + l_linenumber) AS src
FROM lineitem GROUP BY l_partkey, lower(l_returnflag)""")
def d27_image_jp(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = F.concat(F.lit("/img/"), "l_orderkey", F.lit("_"), "l_linenumber", F.lit("_120x1500.jpg"))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.lower("l_returnflag").alias("name"), C.drop_pixel_size(src).alias("src"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"))
    return rows.groupBy("l_partkey", "name").agg(F.max_by("src", "pos").alias("src"))


@check("d28_text", """
SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g') || chr(10)), '') AS joined,
  '' AS empty FROM documents""")
def d28_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.join_text(F.split("text", "\n")).alias("joined"), X.join_text(F.array().cast("array<string>")).alias("empty"))


@check("d29_swatch", """
SELECT p_partkey, CAST(i AS BIGINT) AS pos, 'c' || i AS color_code, p_name || i AS color_name, CAST(p_size * 10 + i AS VARCHAR) AS option_id, i = 1 AS shown
FROM part, unnest(range(0, 2)) AS t(i)""")
def d29_swatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    def swatch(i: int):
        option = (F.col("p_size") * 10 + i).cast("string")
        return F.concat(F.lit(f'<img class="swatch{" selected" if i else ""}" title="'), "p_name", F.lit(f'{i}" onclick="changeAltImages('),
                        F.lit(f"this,'c{i}'); swatchClicked("), option, F.lit(')">'))

    pages = dealt_parts(spark, sf_dir).select("p_partkey", F.concat(F.lit('<div class="pdpRight x">'), swatch(0), swatch(1), F.lit("</div>")).alias("html"))
    docs = N.parse_nodes(pages, [N.Test("div", "class", "starts", "pdpRight"), N.Test("img", "class", "starts", "swatch", markup=True)], ["p_partkey"])
    images = N.under(N.ALL, N.Test("div", "class", "starts", "pdpRight"), N.Test("img", "class", "starts", "swatch"))
    rows = docs.select("p_partkey", F.posexplode(images.col).alias("pos", "n"))
    attr = lambda name: F.try_element_at(F.col("n.attrs"), F.lit(name))
    return rows.select(
        "p_partkey", F.col("pos").cast(LONG).alias("pos"), X.group(attr("onclick"), "changeAltImages\\(.*?,'(.*?)'\\)").alias("color_code"),
        attr("title").alias("color_name"), X.group(F.col("n.outer"), "swatchClicked\\((.*?)\\)").alias("option_id"),
        F.contains(attr("class"), F.lit("selected")).alias("shown"))


@check("d30_meta", """
SELECT page_id, regexp_extract(html, '<meta charset="(.*?)">', 1) AS charset, CAST(1 AS BIGINT) AS n FROM pages""")
def d30_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = N.parse_nodes(table(spark, sf_dir, "pages"), [N.Test("meta", "charset", "has", "")], ["page_id"])
    values = N.values(N.select(N.ALL, N.Test("meta")), "charset")
    return docs.select("page_id", F.array_join(values, "|").alias("charset"), F.size(values).cast(LONG).alias("n"))


@check("d31_brand", """
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_type ELSE 'unknown' END AS brand, p_name || '|' || p_type AS title FROM part""")
def d31_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    none, kind = F.array().cast("array<string>"), F.col("p_size") % 3
    links = F.when(kind == 0, F.array("p_brand")).otherwise(none)
    texts = F.when(kind == 1, F.array("p_type")).otherwise(none)
    return parts(spark, sf_dir).select(
        "p_partkey", C.brand_text(links, texts).alias("brand"),
        F.array_join(X.non_empty(F.array(F.lit(""), F.col("p_name"), F.lit(""), F.col("p_type"))), "|").alias("title"))


@check("d32_country", """
SELECT n_nationkey, chr(97 + n_nationkey) || chr(98 + n_regionkey) AS code FROM nation""")
def d32_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat(F.char(F.col("n_nationkey") + 65), F.char(F.col("n_regionkey") + 98))
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", U.country_from_url(F.concat(F.lit("http://www.shop.example/"), code, F.lit("/"))).alias("code"))


@check("e1_stock", "SELECT p_partkey FROM part WHERE p_size % 4 <> 0")
def e1_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock = F.when(F.col("p_size") % 4 != 1, (F.col("p_size") % 4).cast("string"))
    return parts(spark, sf_dir).where(E.in_stock(stock)).select("p_partkey")


@check("e2_named", f"WITH {LI}, n AS (SELECT page_id, pos, regexp_extract(block, '<a[^>]*>([^<]*)<', 1) AS name FROM li) SELECT * FROM n WHERE length(name) > 1")
def e2_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = li_blocks(spark, sf_dir).select("page_id", "pos", X.inner_text(X.find(F.col("block"), "<a .*")).alias("name"))
    return keep_where(names, E.named(F.col("name")), ["page_id", "pos", "name"])


@check("e3_anchor", """
SELECT page_id, regexp_extract(html, '(?is)<b>.*?<br>') AS found FROM pages WHERE regexp_matches(html, '(?is)<b>.*?<br>')""")
def e3_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages").select("page_id", X.find(F.col("html"), "<b>.*?<br>").alias("found"))
    return keep_where(found, E.has_anchor(F.col("found")), ["page_id", "found"])


@check("e4_exclude", """
SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, 'what\\+to\\+wear|designer|personal\\+styling|in-the-mix|stores|blog')
  AND NOT contains(lower(url), 'home') AND NOT contains(lower(url), 'spring look book')""")
def e4_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").where(
        E.followed_category(url) & E.followed_label(url) & E.followed_subcategory(url)).select("page_id", "url")


@check("e5_kind", """
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'looks' WHEN p_size % 4 = 1 THEN 'report' WHEN p_size % 3 = 0 THEN 'directory' ELSE 'grid' END AS kind
FROM part""")
def e5_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    label = F.concat("p_name", F.when(size % 4 == 0, " Chic Escape").otherwise(""))
    return parts(spark, sf_dir).select("p_partkey", E.page_kind(label, size % 4 == 1, size % 3 == 0).alias("kind"))


@check("e6_sellable", """
SELECT p_partkey FROM part WHERE p_size % 3 <> 0 AND p_size % 5 <> 0 AND NOT (p_size % 2 = 0 AND p_size % 7 = 0)""")
def e6_sellable(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    title = F.when(size % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("p_name"))
    sku = F.when(size % 5 == 0, "").otherwise(F.col("p_brand"))
    color = F.when(size % 2 == 1, "c1")
    price = F.array(F.when(size % 7 == 0, "0").otherwise("9"))
    return parts(spark, sf_dir).where(E.sellable(title, sku) & E.priced_or_colored(color, price)).select("p_partkey")


@check("e7_result_page", "SELECT doc_id FROM documents WHERE doc_id % 3 = 0 OR contains(text, 'Search results')")
def e7_result_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat("text", F.when(F.col("doc_id") % 3 == 0, "<h2>Search results</h2>").otherwise(""))
    return table(spark, sf_dir, "documents").where(E.is_result_page(body)).select("doc_id")
