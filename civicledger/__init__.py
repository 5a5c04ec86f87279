"""civicledger: public-finance analytics on Spark DataFrames."""

from civicledger.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
