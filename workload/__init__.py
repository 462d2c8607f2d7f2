"""Queries over the driver's test tables, each beside the SQL that must give the same rows."""

from workload import (  # noqa: F401
    sources, selection, spines, temporal, spatial, joins, aggregates, shaping, scalars, stages,
)
from workload.registry import ORACLES, QUERIES  # noqa: F401
