"""hourglass: implicit-feedback recommendation on Spark DataFrames and MLlib ALS."""

from .session import ensure_checkpoint_dir, get_session, scratch_path, stable

__version__ = "0.1.0"
__all__ = ["ensure_checkpoint_dir", "get_session", "scratch_path", "stable"]
