"""claimlens: Spark-native claim-line shaping, anomaly seeding, coding edits,
adjudication, detection features, rule scoring and review summaries.

Every public operator is a pure ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, joins, aggregates and windows, so Catalyst can push
filters and prune columns, and AQE can re-plan joins at run time.
"""

from claimlens.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
