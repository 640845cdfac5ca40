"""All registered queries over layers, scenes and metadata, with their SQL."""

from __future__ import annotations

from . import cells, grids, histograms, neighbours, places, stages

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _module in (cells, grids, histograms, neighbours, places, stages):
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
