"""Imports every catalog module so their ``@query`` registrations run."""

from __future__ import annotations


def load_all():
    from . import (catalog_metrics, catalog_models, catalog_monitor, catalog_prep,  # noqa: F401
                   catalog_profile, catalog_split, catalog_store, catalog_stream)
    from .registry import ORACLE, QUERIES
    return QUERIES, ORACLE
