"""Asset-performance screening as Spark DataFrame transforms.

``functions``  column expressions (parsing, classes, rates, bands)
``operators``  DataFrame -> DataFrame building blocks (joins, picks, panels, ...)
``sources``    delimited feeds, staging, dated snapshots, result files
``plans``      the screening job composed from the above
"""

from culvert.config import ScreeningConfig

__all__ = ["ScreeningConfig"]
