"""Inventory-policy analytics on Spark DataFrames.

Layers: raw text -> staging -> marts -> parameters -> findings. Every operator
takes DataFrames and returns a lazy DataFrame unless its docstring says it runs
a job.
"""

from stockpolicy.config import Mapping, PolicyConfig, SourceSpec

__all__ = ["Mapping", "PolicyConfig", "SourceSpec"]
