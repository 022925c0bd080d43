"""tabulon: distributed DataFrame operators for the life of a tabular classification data set.

Every operator takes Spark DataFrames (or Spark ML estimators / models) and returns lazy
DataFrames. Statistics that parametrise a later projection (fences, means, min/max) are
computed by one aggregation job each and come back to the driver as a single row.
"""

from tabulon.session import build_session, checkpoint_dir, reliable_checkpoint, scratch_path

__all__ = ["build_session", "checkpoint_dir", "reliable_checkpoint", "scratch_path"]
