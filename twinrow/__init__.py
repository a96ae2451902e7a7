"""twinrow: check on Spark that two copies of a dataset agree."""

from twinrow.session import build_session, run_folder

__all__ = ["build_session", "run_folder"]
