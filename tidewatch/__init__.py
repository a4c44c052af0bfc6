"""tidewatch: operational metric analytics as PySpark DataFrame operators."""

from tidewatch.session import get_session, prepare

__all__ = ["get_session", "prepare"]
