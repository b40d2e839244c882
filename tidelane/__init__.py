"""Quality control and alignment of irregular sensor time series on Spark DataFrames."""

from tidelane.session import local_session, require_utc

__all__ = ["local_session", "require_utc"]
