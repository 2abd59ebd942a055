"""Imports every module that registers queries."""

from . import rows, cleaning, joins, aggregates, texts, files, jobs  # noqa: F401
