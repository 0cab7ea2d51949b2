"""Region points to the small tables the other jobs read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from galecast.operators.regions import region_dimension, unique_calls, unique_grid
from galecast.sources.tables import write_table


def run_dimensions(points: DataFrame, regions: str, calls: str, grid: str) -> None:
    """Regions with their cell, one region per cell, and one coordinate pair per cell."""
    rows = region_dimension(points)
    write_table(rows, regions)
    stored = points.sparkSession.read.parquet(regions)
    write_table(unique_calls(stored), calls)
    write_table(unique_grid(stored), grid)
