"""Readers of the landing zone and of stored areas."""

from annalist.sources.registry import SourceReader, get_source, register_source, union_listings

__all__ = ["SourceReader", "get_source", "register_source", "union_listings"]
