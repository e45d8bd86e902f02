"""vantage: platform-telemetry analytics on Spark.

Every query is a function from source DataFrames (``Telemetry``) and an
``as_of`` instant to a lazy DataFrame built from Spark's own joins, windows and
aggregates. Nothing is collected to the driver.
"""

from vantage.functions.time import AsOf
from vantage.sources.telemetry import Telemetry

__all__ = ["AsOf", "Telemetry"]
__version__ = "0.1.0"
