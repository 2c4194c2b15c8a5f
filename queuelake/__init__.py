"""Park-operations analytics on Spark: landed JSON responses in, typed tables and boards out."""

from queuelake.session import build_session, checkpoint_dir, prepare

__all__ = ["build_session", "checkpoint_dir", "prepare"]
