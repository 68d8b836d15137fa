"""Queries over the given tables; importing the package registers them."""

from . import registry  # isort: skip
from . import aggregates, facade, files, increments, joins, scripture, search, similarity, texts, windows

__all__ = ["aggregates", "facade", "files", "increments", "joins", "registry", "scripture", "search", "similarity", "texts", "windows"]
