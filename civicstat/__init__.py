"""District statistics analytics on Spark DataFrames.

Every operator is a function from DataFrames to a DataFrame. Nothing is
collected to the driver except a handful of model metrics.
"""

from civicstat.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
