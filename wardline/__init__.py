"""wardline: clinical early-warning cohorts, windows, features and evaluation on Spark.

Every operator is a plain function over DataFrames with column names as
parameters.  Nothing is collected to the driver except bounded one-row
statistics and bounded split points; all heavy work is joins, aggregates
and windows that Spark plans and distributes.
"""

from wardline.session import get_session, checkpoint_dir, materialize

__all__ = ["get_session", "checkpoint_dir", "materialize"]
