"""Named queries over the driver's tables, with the SQL they are checked against."""

from __future__ import annotations

from clipwright.queries import clips, files, geometry, manifest, masks, quality, runtime, state

QUERIES: dict = {}
ORACLE_SQL: dict = {}
for _module in (manifest, files, state, geometry, masks, clips, quality, runtime):
    QUERIES |= _module.QUERIES
    ORACLE_SQL |= _module.SQL
