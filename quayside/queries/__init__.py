"""The registered queries, one module per group, each beside its oracle SQL."""

from quayside.queries import (  # noqa: F401
    aggregations, cleaning, dates, joins, marts, numbers, projections, quality, sets, sources,
    strings, streams, windows,
)
from quayside.queries.registry import ORACLES, QUERIES  # noqa: F401
