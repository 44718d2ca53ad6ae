"""trendflow: Bronze -> Silver -> Gold analytics of trending-video snapshots
on Spark DataFrames (see README.md). Library functions take and return
DataFrames and never create or configure a session."""

__version__ = "0.1.0"
