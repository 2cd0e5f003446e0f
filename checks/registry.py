"""All registered queries and their SQL."""

from __future__ import annotations

from checks import identity, ingest, prepare, report, sinks, stage

_FAMILIES = [identity, ingest, stage, prepare, report, sinks]

QUERIES = {name: fn for family in _FAMILIES for name, fn in family.QUERIES.items()}
ORACLES = {name: text for family in _FAMILIES for name, text in family.ORACLES.items()}
