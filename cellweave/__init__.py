"""Raster and vector analytics on plain Spark DataFrames.

Rasters are *cell tables* (one row per cell), geometries are *vertex* and *edge*
tables.  Every operator takes and returns DataFrames, so a job is a chain of
``df.transform(...)`` calls that Catalyst plans as joins, windows and aggregates.
"""

from cellweave.schema import Grid

__all__ = ["Grid"]
