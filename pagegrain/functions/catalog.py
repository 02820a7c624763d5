"""Category paths, product keys, images and titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagegrain.functions.text import clean, fill, group, replace_all, replace_n


# fixed values: patterns of the keys in links and image paths
LINK_DIGITS, VARIANT_KEY, IMAGE_KEY, SCENE_KEY = "([0-9]{8,})", "dwvar_(.*?)_", "(?i)product/(.*?)/", "(?i)Intermix/PROD_(.*?)_"


def category_path(*levels: Column) -> Column:
    """Non-empty levels in order."""
    return F.filter(F.array(*levels), lambda x: F.length(x) > 0)


def subcat_label(label: Column, category: Column, country: Column) -> Column:
    """Sub-category parts of a menu label.

    The category prefix goes, the first two hyphens become spaces, the rest split; empty parts are dropped.
    Under ``sale`` the word `` sale`` goes as well; for France the parts are joined again.
    """
    bare = F.array_join(F.split(label, F.concat(F.lit("\\Q"), category, F.lit("-\\E")), 3), "")
    spaced = clean(replace_n(bare, "-", " ", 2))
    spaced = F.when(category == "sale", replace_all(spaced, " sale")).otherwise(spaced)
    parts = F.filter(F.split(spaced, "-"), lambda x: x != "")
    return F.when((country == "fr") & (F.size(parts) > 0), F.array(F.array_join(parts, " "))).otherwise(parts)


def base_sku_from_link(link: Column, script_id: Column) -> Column:
    """Listing key: script id, else the first 8 or more digits of the link, else the variant key in it; lower case."""
    return F.lower(F.coalesce(script_id, group(link, LINK_DIGITS), group(link, VARIANT_KEY)))


def base_sku_from_image(src: Column) -> Column:
    """Key in a product image path."""
    return F.lower(group(src, IMAGE_KEY))


def base_sku_from_scene(src: Column, img_id: Column, most: int | None = None) -> Column:
    """Key in an image server path, else the tail of the image id; with ``most``, its first so many characters."""
    key = F.coalesce(group(src, SCENE_KEY), group(img_id, ".*_(.*)"))
    return key if most is None else F.substring(key, 1, most)


def detail_sku(style: Column, url: Column, texts: Column) -> Column:
    """Key on a detail page: style number, else 8 digits of the url, else the last text node."""
    last = F.regexp_replace(F.element_at(texts, -1), "(?i)Style Number: ", "")
    return F.coalesce(F.nullif(style, F.lit("")), group(url, "([0-9]{8})"), last)


def variant_sku(base: Column, color: Column) -> Column:
    return F.concat(base, F.lit("_"), color)


def image_list(data: Column, prefix: Column, suffix: str, color: Column | None, skip_first: bool) -> Column:
    """Urls of a comma list whose entries end at ``;``; one colour only when given."""
    names = F.transform(F.split(data, ","), lambda x: F.substring_index(x, ";", 1))
    if skip_first:
        names = F.slice(names, F.lit(2), F.greatest(F.size(names) - 1, F.lit(0)))
    names = F.filter(names, lambda x: x != "")
    if color is not None:
        names = F.filter(names, lambda x: F.contains(x, F.concat(F.lit("_"), color, F.lit("_"))))
    return F.transform(names, lambda x: F.concat(prefix, x, F.lit(suffix)))


def recolor_images(images: Column, old: Column, new: Column) -> Column:
    """The image list of another colour."""
    def one(x: Column) -> Column:
        mid = F.replace(x, F.concat(F.lit("_"), old, F.lit("_")), F.concat(F.lit("_"), new, F.lit("_")))
        return F.replace(mid, F.concat(F.lit("_"), old, F.lit("?")), F.concat(F.lit("_"), new, F.lit("?")))

    return F.transform(images, one)


def with_primary(images: Column, primary: Column) -> Column:
    """Append the primary image once; it stands alone when there are no others."""
    return F.array_union(F.coalesce(images, F.array().cast("array<string>")), primary)


def recrop(src: Column, query: str) -> Column:
    """Image url with its query replaced (only where it has one)."""
    return F.regexp_replace(src, "\\?.*", query.replace("$", "\\$"))


def drop_pixel_size(src: Column) -> Column:
    return F.regexp_replace(src, "_[0-9]{2,4}x[0-9]{2,5}", "")


def breadcrumb(anchors: Column) -> Column:
    """The two levels after anchor 2, or after anchor 3 when anchor 2 is the home link."""
    home = F.contains(F.lower(F.get(anchors, F.lit(1))), F.lit("home"))
    return F.slice(anchors, F.when(F.coalesce(home, F.lit(False)), 4).otherwise(3), F.lit(2))


def brand_text(link_texts: Column, texts: Column) -> Column:
    """Brand link text, else brand text, else ``unknown``."""
    return F.when(F.size(link_texts) > 0, F.array_join(link_texts, "")).otherwise(
        F.when(F.size(texts) > 0, F.array_join(texts, "")).otherwise(F.lit("unknown"))
    )


def parse_title(title: Column, brand: Column, size_text: Column) -> Column:
    """struct(title, flavor, size, unit) of a supplement title such as ``Brand Name, Flavour``."""
    has_brand = F.contains(F.lower(title), F.lower(brand))
    named = F.when(has_brand, F.replace(title, F.concat(brand, F.lit(" ")), F.lit(""))).otherwise(title)
    flavor = replace_all(group(named, "(?s)(,.*)$"), ", ")
    base = F.when(F.contains(named, F.lit(",")), F.substring_index(named, ",", 1)).otherwise(named)
    measured = group(size_text, "(?s)([0-9]+.*?[a-zA-Z]+)")
    return F.struct(
        base.alias("title"),
        fill(flavor, "None").alias("flavor"),
        fill(group(measured, "([0-9]+)"), "1").alias("size"),
        fill(group(measured, "([a-zA-Z]+)"), "item").alias("unit"),
    )
