"""quarry: data-mining operators written against the PySpark DataFrame API.

Every operator takes DataFrames and returns a lazy DataFrame; the heavy work
(grouping, joins, shuffles, windows) runs on the executors and the driver only
ever sees bounded values (a k x d centre table, an F x F Gram matrix, one
scalar per loop round).
"""

from quarry.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
