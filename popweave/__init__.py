"""popweave: survey weighting and small-area population synthesis on Spark DataFrames.

Every operator is a pure ``DataFrame -> DataFrame`` function built from Spark's
built-in expressions, so Catalyst plans it and it runs distributed.
"""

from popweave.config import RunConfig, ZoneRanges

__all__ = ["RunConfig", "ZoneRanges"]
