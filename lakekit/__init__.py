"""lakekit: batch analytics over posts and comments, written as Spark jobs."""

__version__ = "0.1.0"
