"""millrace: generate, land, query and check streams of text records on Spark."""

from millrace.operators.policy import RollPolicy
from millrace.session import build_session, scratch_path, ship_package

__all__ = ["RollPolicy", "build_session", "scratch_path", "ship_package"]
