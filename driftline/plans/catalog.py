"""All registered queries of the core and their SQL twins."""

from __future__ import annotations

from driftline.plans import changes, comments, coverage, documents, files, phases, problems, quality, schedule

_MODULES = (problems, changes, quality, comments, coverage, schedule, files, documents, phases)
QUERIES = {k: q for m in _MODULES for k, q in m.QUERIES.items()}
ORACLES = {k: s for m in _MODULES for k, s in m.ORACLES.items()}
