"""Column functions: the semantics that are easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from pagegrain.functions import catalog as C
from pagegrain.functions import markup as M
from pagegrain.functions import price as P
from pagegrain.functions import text as X
from pagegrain.functions import urls as U


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text,expected", [("a-b-c-d", "a b c-d"), ("a-b", "a b"), ("", ""), ("--", "  ")])
def test_capped_replace_stops_at_two(spark, text, expected):
    assert value(spark, X.replace_n(F.lit(text), "-", " ", 2)) == expected


def test_no_match_is_null_and_guards_stay_null(spark):
    assert value(spark, X.find(F.lit("abc"), "<p>")) is None
    assert value(spark, X.inner_text(F.lit("no tags"))) is None
    assert value(spark, X.inner_text(F.lit("<b></b>"))) == ""
    assert value(spark, X.attr_value(F.lit('<a href="">'), "href")) == ""


def test_trim_removes_one_space_only(spark):
    assert value(spark, X.trim_one(F.lit("  a  "))) == " a "
    assert value(spark, X.strip_ws(F.lit(" \t a\n "))) == "a"


def test_double_decode_stops_after_the_cap(spark):
    assert value(spark, X.decode_amp_twice(F.lit("a &amp;amp; b"))) == "a & b"
    assert value(spark, X.decode_amp_twice(F.lit("&amp;amp;" * 3))) == "&&&amp;"


def test_find_ignores_case_and_newlines(spark):
    assert value(spark, X.find(F.lit("x<B>a\nb</b>"), "<b>.*?</b>")) == "<B>a\nb</b>"


@pytest.mark.parametrize("text,expected", [("$5 or 3%", "Absolute Cash Back"), ("3%", "Percentage Cash Back"), ("", "unknown")])
def test_category(spark, text, expected):
    assert value(spark, X.cash_category(F.lit(text))) == expected


def test_title_case_like_python(spark):
    for text in ("women's how we-style 3ways", "a b", ""):
        assert value(spark, X.title_case(F.lit(text))) == text.title()


def test_discount(spark):
    assert value(spark, P.discount_pct(F.lit(25.0), F.lit(20.0))) == "20.0%"
    assert value(spark, P.discount_pct(F.lit(0.0), F.lit(20.0))) is None


def test_best_percent_rejects_text(spark):
    assert value(spark, P.best_percent(F.array(F.lit("5%"), F.lit("12.5%")))) == "12.5%"
    assert value(spark, P.best_percent(F.array(F.lit("5%"), F.lit("n/a")))) is None


def test_subcategory_splits_after_the_second_hyphen(spark):
    got = C.subcat_label(F.lit("shoes-a-b-c--d"), F.lit("shoes"), F.lit("us"))
    assert value(spark, got) == ["a b c", "d"]
    assert value(spark, C.subcat_label(F.lit("a-b-c-d"), F.lit("x"), F.lit("fr"))) == ["a b c d"]


def test_primary_image_is_appended_once(spark):
    assert value(spark, C.with_primary(F.array(F.lit("a")), F.array(F.lit("a")))) == ["a"]
    assert value(spark, C.with_primary(F.lit(None).cast("array<string>"), F.array(F.lit("p")))) == ["p"]


def test_js_object_with_bare_and_numeric_keys(spark):
    text = "{'a':{1:{n:'x\\/y'}},bad:2}"
    got = value(spark, M.parse_js(F.lit(text), "struct<a:map<string,struct<n:string>>>"))
    assert got.a["1"].n == "x/y"
    assert value(spark, M.parse_js(F.lit("{nonsense"), "struct<a:string>")["a"]) is None


def test_markup_sizes(spark):
    text = "<option value='1'>S\n<option value='2'>M\n"
    assert value(spark, M.markup_sizes(F.lit(text))) == ["S", "M"]


def test_country_and_shop_id(spark):
    assert value(spark, U.country_from_url(F.lit("http://www.shop.example/US/"))) == "us"
    assert value(spark, U.shop_id(F.lit("/item/shop_product_id/12345"))) == "12345"


def test_description_default(spark):
    assert value(spark, X.description(F.array(F.lit("\r\n\t")))) == ["no description available"]
    assert value(spark, X.description(F.array(F.lit("a"), F.lit("")))) == ["a", ""]


def test_parse_title_defaults(spark):
    got = value(spark, C.parse_title(F.lit("Acme Malic Acid, Lemon"), F.lit("Acme"), F.lit("100 Tablets")))
    assert got.asDict() == {"title": "Malic Acid", "flavor": "Lemon", "size": "100", "unit": "Tablets"}
    got = value(spark, C.parse_title(F.lit("Zinc"), F.lit("Acme"), F.lit("one")))
    assert got.asDict() == {"title": "Zinc", "flavor": "None", "size": "1", "unit": "item"}
