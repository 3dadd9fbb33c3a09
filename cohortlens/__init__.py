"""cohortlens: Spark-native cohort analytics.

Cleaning, data-quality audit, association statistics, leakage-free group
features, reproducible splits, MLlib regression pipelines and diagnostics,
all expressed as DataFrame plans so Catalyst optimises and executors run them.
"""

from cohortlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
