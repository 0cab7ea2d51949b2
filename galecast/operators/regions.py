"""Regions, their cells and their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.functions.geo import grid_cell
from galecast.functions.numeric import as_number, stripped
from galecast.operators.keys import first_per_key, splittable

CELL = ("nx", "ny")
SHORT_CODE_LENGTH = 5
# Names under which a region's name may come.
NAME_ALIASES = ("admin_name", "adm_name", "name")


def whole_number(df: DataFrame, name: str) -> Column:
    return as_number(df, name).try_cast("int")


def clean_region_map(df: DataFrame) -> DataFrame:
    """Any spelling of the cell and name columns to ``nx, ny, admin_name``, without repeats.

    Raises when the cell columns are missing; a missing name column is null.
    """
    found = {c.lower(): c for c in df.columns}
    if "nx" not in found or "ny" not in found:
        raise ValueError(f"a region map needs nx and ny; it has {df.columns}")
    alias = next((found[a] for a in NAME_ALIASES if a in found), None)
    name = stripped(F.col(alias).cast("string")) if alias else F.lit(None).cast("string")
    return df.select(
        whole_number(df, found["nx"]).alias("nx"),
        whole_number(df, found["ny"]).alias("ny"),
        name.alias("admin_name"),
    ).distinct()


def assign_cells(points: DataFrame) -> DataFrame:
    """Add the grid cell of each point's ``lat`` and ``lon``."""
    nx, ny = grid_cell(F.col("lat"), F.col("lon"))
    return points.withColumns({"nx": nx, "ny": ny})


def region_dimension(points: DataFrame) -> DataFrame:
    """One row per region code, with its cell and its short code; rows with a point come first.

    The short code is there only when some code is long enough for it.
    """
    typed = points.select(
        F.col("admin_code").cast("string").alias("admin_code"),
        F.col("admin_name").cast("string").alias("admin_name"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
    )
    unplaced = F.col("lat").isNull() | F.col("lon").isNull()
    regions = first_per_key(typed.withColumn("_unplaced", unplaced), ["admin_code"], ["_unplaced"]).drop("_unplaced")
    longest = typed.agg(F.max(F.length("admin_code"))).scalar()
    return assign_cells(regions).withColumn(
        "SIG_CD",
        F.when(longest >= SHORT_CODE_LENGTH, F.substring("admin_code", 1, SHORT_CODE_LENGTH)),
    )


def unique_calls(regions: DataFrame) -> DataFrame:
    """One region per cell: the cells to ask the feeds for."""
    return first_per_key(regions, CELL, ["admin_code"])


def unique_grid(regions: DataFrame) -> DataFrame:
    """One coordinate pair per cell, from the first region that has one."""
    missing = {"nx", "ny", "lat", "lon"} - set(regions.columns)
    if missing:
        raise ValueError(f"the region table lacks {sorted(missing)}")
    placed = regions.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    order = [c for c in ("admin_code",) if c in regions.columns]
    first = first_per_key(placed.select("nx", "ny", *order, "lat", "lon"), CELL, order)
    return first.select(
        F.col("nx").cast("int").alias("nx"), F.col("ny").cast("int").alias("ny"), "lat", "lon"
    )


def clean_calls(df: DataFrame) -> DataFrame:
    """Call list with typed cells and trimmed region codes; rows without a code drop out."""
    if "admin_code" not in df.columns and "areaNo" in df.columns:
        df = df.withColumnRenamed("areaNo", "admin_code")
    missing = {"nx", "ny", "admin_code"} - set(df.columns)
    if missing:
        raise ValueError(f"the call list lacks {sorted(missing)}")
    return df.where(F.col("admin_code").isNotNull()).withColumns(
        {
            "nx": whole_number(df, "nx"),
            "ny": whole_number(df, "ny"),
            "admin_code": stripped(F.col("admin_code").cast("string")),
        }
    )


def sample_cells(regions: DataFrame, n: int = 0) -> DataFrame:
    """The first ``n`` cells in cell order; all of them when ``n`` is 0."""
    return regions.orderBy("nx", "ny", "admin_code").limit(n) if n else regions


def region_labels(regions: DataFrame, separator: str = "|") -> DataFrame:
    """The sorted distinct region names of each cell as one text; none gives null."""
    names = F.sort_array(F.collect_set(F.col("admin_name").cast("string")))
    return regions.groupBy(*CELL).agg(
        F.nullif(F.concat_ws(separator, names), F.lit("")).alias("admin_names")
    )


def attach_regions(df: DataFrame, regions: DataFrame | None) -> DataFrame:
    """Add ``admin_names`` by cell; null when the region table cannot give it.

    The labels are one row per cell. Spark broadcasts them while they are below
    its broadcast threshold and shuffles by cell, splitting full cells, above it.
    """
    if regions is None or {"nx", "ny", "admin_name"} - set(regions.columns):
        return df.withColumn("admin_names", F.lit(None).cast("string"))
    typed = regions.withColumns({c: whole_number(regions, c) for c in CELL})
    labels = splittable(region_labels(typed), CELL)
    return df.join(labels, list(CELL), "left").select(*df.columns, "admin_names")
