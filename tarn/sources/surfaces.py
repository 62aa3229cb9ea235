"""Surfaces as a sink: layers of an area's pixels packed into tiles, and boxes read back from few of them.

A tile is one row: its layer, area and place, and the values of its pixels as bytes, by rows, with NaN where a pixel has no
value. Tiles are partitioned by layer and row of tiles, so a box reads the folders that it crosses; the tile's column is a
filter that the scan takes. A tile has a bounded number of pixels, so packing and unpacking fit any task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Side of a tile in pixels.
TILE = 256
FIELDS = "layer string, aoi_id string, ty long, tx long, side int, n_known long, data binary"


def packed(surface: DataFrame, layers: list[str], tile: int = TILE) -> DataFrame:
    """layer, aoi_id, ty, tx, side, n_known, data of the named columns of a surface (aoi_id, y, x, and numbers or booleans); a pixel is one row of it."""
    value = F.inline(F.array(*[F.struct(F.lit(c).alias("layer"), F.col(c).cast("double").alias("value")) for c in layers]))
    rows = surface.select("aoi_id", F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), value).where("value is not null")
    rows = rows.withColumns({"ty": F.floor(F.col("y") / tile), "tx": F.floor(F.col("x") / tile)})

    def pack(table: pa.Table) -> pa.Table:
        ty, tx = table.column("ty")[0].as_py(), table.column("tx")[0].as_py()
        cells = np.full((tile, tile), np.nan)
        cells[table.column("y").to_numpy() - ty * tile, table.column("x").to_numpy() - tx * tile] = table.column("value").to_numpy()
        one = {"layer": table.column("layer")[0].as_py(), "aoi_id": table.column("aoi_id")[0].as_py(), "ty": ty, "tx": tx, "side": tile, "n_known": table.num_rows, "data": zlib.compress(cells.tobytes(), 1)}
        return pa.table({k: [v] for k, v in one.items()}, schema=pa.schema([("layer", pa.string()), ("aoi_id", pa.string()), ("ty", pa.int64()), ("tx", pa.int64()), ("side", pa.int32()), ("n_known", pa.int64()), ("data", pa.binary())]))

    return rows.groupBy("layer", "aoi_id", "ty", "tx").applyInArrow(pack, FIELDS)


def write(surface: DataFrame, layers: list[str], path: str, tile: int = TILE) -> None:
    packed(surface, layers, tile).repartition("layer", "ty").sortWithinPartitions("layer", "ty", "aoi_id", "tx").write.partitionBy("layer", "ty").parquet(path)


def read_box(spark: SparkSession, path: str, layer: str, y0: int, x0: int, y1: int, x1: int, aoi_id: str | None = None, tile: int = TILE) -> DataFrame:
    """aoi_id, y, x, value of a layer's pixels in a box, its edges included, of one area or of all; tile is that of the writer."""
    rows = spark.read.schema(FIELDS).parquet(path).where((F.col("layer") == layer) & F.col("ty").between(y0 // tile, y1 // tile) & F.col("tx").between(x0 // tile, x1 // tile))
    if aoi_id is not None:
        rows = rows.where(F.col("aoi_id") == aoi_id)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.to_pylist():
                cells = np.frombuffer(zlib.decompress(t["data"])).reshape(t["side"], t["side"])
                y, x = np.nonzero(~np.isnan(cells))
                value, y, x = cells[y, x], y + t["ty"] * t["side"], x + t["tx"] * t["side"]
                inside = (y >= y0) & (y <= y1) & (x >= x0) & (x <= x1)
                if inside.any():
                    yield pa.RecordBatch.from_arrays([pa.array([t["aoi_id"]] * int(inside.sum()), pa.string()), pa.array(y[inside], pa.int64()), pa.array(x[inside], pa.int64()), pa.array(value[inside])], ["aoi_id", "y", "x", "value"])

    return rows.select("aoi_id", "ty", "tx", "side", "data").mapInArrow(unpack, "aoi_id string, y long, x long, value double")
