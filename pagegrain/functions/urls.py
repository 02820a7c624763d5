"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagegrain.functions.text import group


def host(url: Column) -> Column:
    """Lower-case host; null when the text is no url."""
    return F.lower(group(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)"))


def site_of(url: Column) -> Column:
    """Host without a leading ``www.``."""
    return F.regexp_replace(host(url), "^www\\.", "")


def origin(url: Column) -> Column:
    """Scheme and host, no trailing slash."""
    return group(url, "^(https?://[^/]+)")


def absolute_url(link: Column, base: Column | str, force: bool = True) -> Column:
    """Prefix a site base: always, or only when the link holds no ``http``."""
    base = F.lit(base) if isinstance(base, str) else base
    joined = F.concat(base, link)
    return joined if force else F.when(F.contains(link, F.lit("http")), link).otherwise(joined)


def drop_parent_dots(link: Column) -> Column:
    return F.regexp_replace(link, "^\\.\\.", "")


def schemeless(link: Column) -> Column:
    """Drop a leading ``//`` and add ``http://`` where no scheme is left."""
    bare = F.regexp_replace(link, "^//", "")
    return F.when(F.contains(bare, F.lit("http")), bare).otherwise(F.concat(F.lit("http://"), bare))


def canonical(url: Column) -> Column:
    """Form under which two requests count as the same: no fragment, query parameters in order."""
    bare = F.regexp_replace(url, "#.*$", "")
    query = F.regexp_extract(bare, "\\?(.*)$", 1)
    ordered = F.array_join(F.array_sort(F.split(query, "&")), "&")
    path = F.regexp_replace(bare, "\\?.*$", "")
    return F.when(query == "", path).otherwise(F.concat_ws("?", path, ordered))


def variant_url(page_url: Column, path: Column, sku: Column) -> Column:
    """Variant data url: host of the product link, path named by the page, product id."""
    return F.concat(origin(page_url), path, F.lit("?pid="), sku, F.lit("&format=json"))


def image_set_url(base: Column, name: Column, query: str) -> Column:
    return F.concat(base, name, F.lit(query))


def listing_page_url(base: str, category_id: Column, page: Column) -> Column:
    return F.concat(F.lit(base), category_id, F.lit("&ajaxRequest=true&page="), page.cast("string"))


def shop_id(url: Column) -> Column:
    """Shop product id, ended by a slash or, at the end of the url, four or more digits."""
    return F.coalesce(
        group(url, "shop_product_id/(.*?)/"), group(url, "shop_product_id/([0-9]{4,})")
    )


def country_from_url(url: Column) -> Column:
    """Last two letters of a start url once its slashes are gone, lower case."""
    return F.lower(group(F.replace(url, F.lit("/"), F.lit("")), "(?i)([a-z]{2})$"))
