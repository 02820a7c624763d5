"""Table schemas of the jobs' inputs and outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STR, _INT, _LONG, _BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
_LIST = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


PAGES = _struct(
    page_id=_LONG, site=_STR, page_type=_STR, url=_STR, referer=_STR, country_code=_STR, language=_STR,
    currency=_STR, category_path=_LIST, html=_STR, fetched_at=T.TimestampType(),
)

NODE = _struct(
    pre=_INT, end=_INT, parent=_INT, level=_INT, tag=_STR, nth=_INT, path=_STR, attrs=T.MapType(_STR, _STR),
    text=_STR, outer=_STR,
)

OFFERS = _struct(store_name=_STR, cash_back=_STR, url=_STR, category=_STR, site=_STR)

JOBS = _struct(site=_STR, job_title=_STR, job_id=_STR, job_location=_STR, summary=_STR, requirements=_STR)

SIZE_ITEM = _struct(
    size_identifier=_STR, size_name=_STR, stock=_INT, size_current_price_text=_STR, size_original_price_text=_STR,
)

PRODUCTS = _struct(
    item_kind=_STR, country_code=_STR, language_code=_STR, currency=_STR, base_sku=_STR, sku=_STR, identifier=_STR,
    brand=_STR, url=_STR, referer_url=_STR, color_code=_STR, color_name=_STR, gender_names=_STR, title=_LIST,
    keywords=_LIST, description_text=_LIST, new_price_text=_LIST, full_price_text=_LIST,
    category_identifiers=_LIST, category_names=_LIST, image_urls=_LIST, available=_BOOL,
    use_size_level_prices=_BOOL, size_infos=T.ArrayType(SIZE_ITEM),
)

REJECTS = _struct(page_id=_LONG, url=_STR, stage=_STR, reason=_STR)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``; a missing column becomes a typed null."""
    def one(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in df.columns else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[one(f) for f in schema.fields])
