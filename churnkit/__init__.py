"""Subscriber-churn analytics on Spark DataFrames."""

from churnkit.spec import TELCO, SplitSpec, TableSpec, TrainSpec

__all__ = ["TELCO", "SplitSpec", "TableSpec", "TrainSpec"]
