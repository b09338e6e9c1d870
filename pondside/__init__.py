"""Analytics over field-monitoring records (groups of sites, sites, visits, observations) on Spark."""

from pondside.plans.exports import export
from pondside.plans.synthesis import synthesis_feed
from pondside.sources.tables import Survey, read_survey

__all__ = ["Survey", "export", "read_survey", "synthesis_feed"]
