"""The checked queries. Importing the package registers them all."""

from pagegrain.checks.base import ORACLES, QUERIES
from pagegrain.checks import fields, menus, pages, products, relations, site_jobs, streams  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
