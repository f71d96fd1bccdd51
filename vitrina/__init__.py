"""Catalog analytics on Spark: clean, query, check and maintain wide catalog tables."""

from vitrina.spec import CatalogSpec

__all__ = ["CatalogSpec"]
