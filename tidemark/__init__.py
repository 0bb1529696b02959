"""tidemark — time-aware evaluation and drift monitoring on Spark.

Every operator takes and returns DataFrames; column roles (id, label, date,
features) are parameters, with the malware-header preset in ``config``.
"""

from tidemark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
