"""Typed views over property-graph instances and their time series, as Spark DataFrames.

Everything here returns a lazy DataFrame or Column; nothing collects data to the driver.
"""

from viewloom.model import Property, ViewDef

__all__ = ["Property", "ViewDef"]
