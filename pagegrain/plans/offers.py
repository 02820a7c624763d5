"""Offer jobs: listing pages of many sites to one offers table.

A site's job is a narrow chain: filter on site, parse stage, block rows, two projections, offer rows. Nothing
shuffles, so a site that holds a third of the pages is just more input splits. The all-sites job parses once,
writes the blocks by site into the shared folder and unions one branch per site, each reading its own partition.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagegrain.functions import price as P
from pagegrain.functions import text as X
from pagegrain.functions.urls import absolute_url
from pagegrain.operators import nodes as N
from pagegrain.operators.filters import in_stock, named
from pagegrain.operators.quality import kept_row, reject_rows
from pagegrain.plans.offer_rules import RULES, OfferRule, retail_discount


def _by_site(rules: list[OfferRule], one) -> Column:
    if len(rules) == 1:
        return one(rules[0])
    out = F
    for rule in rules:
        out = out.when(F.col("site") == rule.site, one(rule))
    return out


def _block_nodes(rule: OfferRule) -> Column:
    nodes = N.ALL
    found = N.select(nodes, *rule.blocks)
    if rule.custom == "best":
        return N.part(N.children(N.select(nodes, *rule.within), found), 1).col
    return (N.descendants(N.select(nodes, *rule.within), found) if rule.within else found).col


def _aux_texts(rule: OfferRule) -> Column:
    nodes = N.ALL
    texts = N.select(nodes, N.Test(N.TEXT, "@path", "ends", rule.aux_text))
    if rule.custom == "best":
        cell, body = rule.aux
        return N.values(N.children(N.descendants(N.select(nodes, body), N.select(nodes, cell)), texts))
    return N.values(N.descendants(N.select(nodes, *rule.aux), texts))


def offer_blocks(pages: DataFrame, rules: Iterable[OfferRule] = RULES) -> DataFrame:
    """One row per offer block: page_id, site, url, pos, block, aux.

    ``aux`` holds the texts a rule reads outside the block: the text at the block's own position for positional
    lists, the whole list for page-level blocks, else nothing.
    """
    rules = list(rules)
    mine = pages.where(F.col("site").isin([r.site for r in rules]))
    docs = N.parse_nodes(mine, {r.site: r.tests for r in rules}, ["page_id", "site", "url"])
    with_aux = [r for r in rules if r.aux]
    none = F.array().cast("array<string>")
    texts = F.coalesce(_by_site(with_aux, _aux_texts), none) if with_aux else none
    if with_aux and len(rules) > len(with_aux):
        texts = F.when(F.col("site").isin([r.site for r in with_aux]), texts).otherwise(none)
    flat = docs.select("page_id", "site", "url", texts.alias("texts"),
                       F.posexplode(_by_site(rules, _block_nodes)).alias("pos", "node"))
    positional = [r.site for r in rules if r.custom == "retail"]
    paged = [r.site for r in rules if r.custom == "best"]
    aux, block = F.col("texts"), F.col("node.outer")
    if positional:
        aux = F.when(F.col("site").isin(positional), F.slice("texts", F.col("pos") + 1, F.lit(1))).otherwise(aux)
    if paged:
        block = F.when(F.col("site").isin(paged), F.col("node.text")).otherwise(block)
    return flat.select("page_id", "site", "url", "pos", block.alias("block"), aux.alias("aux"))


def _sources(rule: OfferRule) -> dict[str, Column]:
    """What the guards match: link_src, name_src and the cash alternative as (alt, hit)."""
    block = F.col("block")
    if rule.custom == "best":
        return {"link_src": block, "name_src": block, "alt": F.lit(0), "hit": block}
    link = X.find(block, rule.link_from or rule.anchor)
    name = X.find(block, rule.name_from or rule.link_from or rule.anchor)
    hits = [X.find(block, guard) for guard, _ in rule.cash]
    alt = F
    for i, hit in enumerate(hits):
        alt = alt.when(hit.isNotNull(), i)
    return {"link_src": link, "name_src": name, "alt": alt, "hit": F.coalesce(*hits)}


def _link(rule: OfferRule) -> Column:
    if rule.custom == "best":
        return F.col("page_url")
    source = F.col("block") if rule.link_in_block else F.col("link_src")
    return F.when(F.col("link_src").isNull(), "").otherwise(absolute_url(rule.link(source), rule.base))


def _name(rule: OfferRule) -> Column:
    source = F.get("aux", F.lit(0)) if rule.custom == "retail" else F.col("block" if rule.name_in_block else "name_src")
    return F.when(F.col("name_src").isNull(), "").otherwise(rule.name(source))


def _cash(rule: OfferRule) -> Column:
    if rule.custom == "best":
        return P.best_percent(F.col("aux"))
    if rule.custom == "retail":
        return retail_discount(F.col("block"), F.col("store_name"))
    out = F.when(F.col("alt").isNull(), rule.no_cash[0])
    for i, (_, steps) in enumerate(rule.cash):
        out = out.when(F.col("alt") == i, steps(F.col("block") if rule.cash_in_block else F.col("hit")))
    return out


def _category(rule: OfferRule) -> Column:
    usual = X.cash_category(F.col("cash_back"))
    if rule.no_cash[1] is None:
        return usual
    return F.when(F.col("alt").isNull(), rule.no_cash[1]).otherwise(usual)


def _stock(rule: OfferRule) -> Column:
    """Stock text; empty when its guard is missing, null when the guard holds no stock (a reject)."""
    if rule.stock is None:
        return F.lit("")
    guard = X.find(F.col("block"), rule.stock_from)
    return F.when(guard.isNull(), "").otherwise(rule.stock(F.col("block")))


def _kept(rule: OfferRule) -> Column:
    keep = in_stock(F.col("stock"))
    if rule.min_name:
        keep = keep & named(F.col("store_name"), rule.min_name)
    if rule.needs_anchor:
        keep = keep & F.col("link_src").isNotNull()
    return keep


@lru_cache(maxsize=256)
def _columns(app: str, rule: OfferRule) -> tuple[list, list, list, list]:
    """The select lists of a rule. Building them takes a thousand calls into the JVM, so each is built once per application (``app``) and
    then serves every plan, such as those of a stream's micro-batches."""
    found = ["page_id", "site", F.col("url").alias("page_url"), "pos", "block", "aux", *[c.alias(k) for k, c in _sources(rule).items()]]
    named_ = ["*", _link(rule).alias("url"), _name(rule).alias("store_name"), _stock(rule).alias("stock")]
    fields = ["page_id", "site", "page_url", "pos", "store_name", "cash_back", "url", _category(rule).alias("category"), "stock", _kept(rule).alias("kept")]
    return found, named_, ["*", _cash(rule).alias("cash_back")], fields


def offer_fields(blocks: DataFrame, rule: OfferRule) -> DataFrame:
    """One site's blocks to raw fields; null marks a field whose search failed after its guard matched."""
    rows = blocks.where(F.col("site") == rule.site)
    for columns in _columns(blocks.sparkSession.sparkContext.applicationId, rule):
        rows = rows.select(*columns)
    return rows


CHECKS = {"name": "store_name", "cash_back": "cash_back", "link": "url", "stock": "stock"}
OFFER_COLUMNS = ["store_name", "cash_back", "url", "category", "site"]


def _readable() -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in CHECKS.values()])


def offers_from_blocks(blocks: DataFrame, rules: Iterable[OfferRule] = RULES) -> DataFrame:
    """Offers of every readable, sellable block: one branch per site, united."""
    row = kept_row(_readable() & F.col("kept"), OFFER_COLUMNS)
    return reduce(DataFrame.union, [offer_fields(blocks, r).select(row).select("__row.*") for r in rules])


def extract_offers(pages: DataFrame, rules: Iterable[OfferRule]) -> DataFrame:
    """store_name, cash_back, url, category, site. Pages should be partitioned by site, so that each rule's
    branch reads its own partition; otherwise stage the blocks first (``extract_all_offers``)."""
    parts = [offers_from_blocks(offer_blocks(pages, [r]), [r]) for r in rules]
    return reduce(DataFrame.unionByName, parts)


def stage_blocks(pages: DataFrame, path: str, rules: Iterable[OfferRule] = RULES) -> DataFrame:
    """Parse the pages of all sites once and keep the blocks as a table partitioned by site, a small site in one file."""
    blocks = offer_blocks(pages, rules)
    blocks.hint("rebalance", "site").write.mode("overwrite").partitionBy("site").parquet(path)
    return pages.sparkSession.read.schema(blocks.schema).parquet(path).select(*blocks.columns)


def extract_all_offers(pages: DataFrame, staging: str, rules: Iterable[OfferRule] = RULES) -> DataFrame:
    """Offers of all sites from one parse of an unpartitioned pages table."""
    rules = list(rules)
    return offers_from_blocks(stage_blocks(pages, staging, rules), rules)


def rejects_from_blocks(blocks: DataFrame, rules: Iterable[OfferRule] = RULES) -> DataFrame:
    """page_id, url, stage, reason of every block field that could not be read."""
    checks = {k: F.col(v).isNull() for k, v in CHECKS.items()}
    parts = [reject_rows(offer_fields(blocks, r), "page_id", "page_url", checks) for r in rules]
    return reduce(DataFrame.unionByName, parts)


def offers_and_rejects(pages: DataFrame, staging: str, rules: Iterable[OfferRule] = RULES) -> tuple[DataFrame, DataFrame]:
    """(offers, rejects) of all sites from one parse of an unpartitioned pages table."""
    rules = list(rules)
    blocks = stage_blocks(pages, staging, rules)
    return offers_from_blocks(blocks, rules), rejects_from_blocks(blocks, rules)


def offer_rejects(pages: DataFrame, rules: Iterable[OfferRule]) -> DataFrame:
    """Rejects of pages that are partitioned by site; each rule parses its own pages. For others see ``offers_and_rejects``."""
    return reduce(DataFrame.unionByName, [rejects_from_blocks(offer_blocks(pages, [r]), [r]) for r in rules])
