"""touchline: match-event analytics as Spark DataFrame plans.

Entry points: ``touchline.plans.catalog`` (named statistics and the source
API), ``touchline.sources`` (documents, landing, seasons),
``touchline.operators`` (the statistics), ``touchline.streaming`` (arriving
documents).
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
