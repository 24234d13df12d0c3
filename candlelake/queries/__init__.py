"""All registered queries; importing the parts fills the registry."""

from candlelake.queries import builds, history, measures, projections, reports, scd, sinks, sources  # noqa: F401
from candlelake.queries.registry import ORACLES, QUERIES  # noqa: F401
