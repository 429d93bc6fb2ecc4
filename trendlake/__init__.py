"""trendlake: trend analytics over category / measure / event-time / tag tables on Spark.

Every operator takes and returns a Spark DataFrame and is lazy; actions happen
only in the sinks (``trendlake.sources``) or in the caller.
"""

from trendlake.roles import Roles, REFERENCE_ROLES
from trendlake.session import get_spark, ensure_checkpoint_dir

__all__ = ["Roles", "REFERENCE_ROLES", "get_spark", "ensure_checkpoint_dir"]
