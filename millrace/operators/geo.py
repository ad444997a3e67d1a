"""Points (AG26-AG30): grids, hexagons, geohash, cell statistics. Built-in expressions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.operators.scale import group_quantiles

# Fixed value: the geohash alphabet.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"

CELL_AGGREGATES = ("sum", "min", "max", "mean", "median", "count", "variance", "deviation", "p1", "p5", "p95", "p99")


def _cells(df: DataFrame, cell: Sequence[str], agg: str, weight: str | None) -> DataFrame:
    if agg not in CELL_AGGREGATES:
        raise QueryError(f"unknown cell aggregate: {agg}")
    df = df.withColumn("__w", F.col(weight).cast("double") if weight else F.lit(1.0))
    if agg in ("median", "p1", "p5", "p95", "p99"):
        prob = 0.5 if agg == "median" else int(agg[1:]) / 100
        return group_quantiles(df, cell, "__w", {"value": (prob, "linear")})
    take = {
        "sum": F.sum, "min": F.min, "max": F.max, "mean": F.avg, "count": F.count,
        "variance": F.var_samp, "deviation": F.stddev_samp,
    }[agg]
    return df.groupBy(*cell).agg(take("__w").alias("value"))


def geo_grid(df: DataFrame, lat: str, lon: str, cell: float, agg: str = "sum", weight: str | None = None) -> DataFrame:
    """AG26: square cells of ``cell`` degrees; the weight defaults to 1."""
    placed = df.dropna(subset=[lat, lon]).withColumns(
        {"cell_x": F.floor(F.col(lon) / cell).cast("bigint"), "cell_y": F.floor(F.col(lat) / cell).cast("bigint")}
    )
    return _cells(placed, ["cell_x", "cell_y"], agg, weight)


def hex_bin(df: DataFrame, lat: str, lon: str, size: float, agg: str = "sum", weight: str | None = None) -> DataFrame:
    """AG27: hexagons of radius ``size`` in axial coordinates (pointy top), rounded on the cube."""
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    q = (x * (math.sqrt(3) / 3) - y / 3) / size
    r = (y * (2 / 3)) / size
    fractional = df.dropna(subset=[lat, lon]).withColumns({"__q": q, "__r": r})
    rounded = fractional.withColumns(
        {
            "__rq": F.floor(F.col("__q") + 0.5),
            "__rr": F.floor(F.col("__r") + 0.5),
            "__rs": F.floor(-F.col("__q") - F.col("__r") + 0.5),
        }
    )
    dq = F.abs(F.col("__rq") - F.col("__q"))
    dr = F.abs(F.col("__rr") - F.col("__r"))
    ds = F.abs(F.col("__rs") + F.col("__q") + F.col("__r"))
    placed = rounded.withColumns(
        {
            "hex_q": F.when((dq > dr) & (dq > ds), -F.col("__rr") - F.col("__rs")).otherwise(F.col("__rq")),
            "hex_r": F.when((dr >= dq) & (dr > ds), -F.col("__rq") - F.col("__rs")).otherwise(F.col("__rr")),
        }
    )
    return _cells(placed, ["hex_q", "hex_r"], agg, weight)


def _bits(precision: int) -> tuple[int, int]:
    total = 5 * precision
    return (total + 1) // 2, total // 2


def _place(col: Column, low: float, span: float, bits: int) -> Column:
    raw = F.floor((col.cast("double") - low) / span * float(2**bits)).cast("bigint")
    return F.greatest(F.least(raw, F.lit(2**bits - 1)), F.lit(0))


def geohash_cell(lat: Column, lon: Column, precision: int) -> tuple[Column, Column]:
    """Integer (lon, lat) cell of a geohash of ``precision`` characters."""
    lon_bits, lat_bits = _bits(precision)
    return _place(lon, -180.0, 360.0, lon_bits), _place(lat, -90.0, 180.0, lat_bits)


def geohash_encode(lat: Column, lon: Column, precision: int = 12) -> Column:
    """Geohash text: bits of the two cells alternate, longitude first."""
    lon_bits, lat_bits = _bits(precision)
    x, y = geohash_cell(lat, lon, precision)
    chars = []
    for j in range(precision):
        value = F.lit(0).cast("bigint")
        for k in range(5):
            g = 5 * j + k
            cell, left = (x, lon_bits - 1 - g // 2) if g % 2 == 0 else (y, lat_bits - 1 - g // 2)
            bit = F.shiftright(cell, left).bitwiseAND(F.lit(1).cast("bigint"))
            value = value + bit * 2 ** (4 - k)
        chars.append(F.substring(F.lit(BASE32), value.cast("int") + 1, F.lit(1)))
    return F.concat(*chars)


def to_geohash(df: DataFrame, latitude: str, longitude: str, geohash: str = "geohash", precision: int = 12) -> DataFrame:
    """AG28: the geohash of two columns as a new one; null where either is."""
    return df.withColumn(geohash, geohash_encode(F.col(latitude), F.col(longitude), precision))


def from_geohash(df: DataFrame, geohash: str, precision: int = 12) -> DataFrame:
    """AG28: ``latitude``, ``longitude`` (centre) and half sizes ``lat_err``, ``lon_err``."""
    lon_bits, lat_bits = _bits(precision)
    x, y = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    for j in range(precision):
        place = (F.instr(F.lit(BASE32), F.substring(F.col(geohash), j + 1, 1)) - 1).cast("bigint")
        for k in range(5):
            bit = F.shiftright(place, 4 - k).bitwiseAND(F.lit(1).cast("bigint"))
            if (5 * j + k) % 2 == 0:
                x = x * 2 + bit
            else:
                y = y * 2 + bit
    return df.withColumns(
        {
            "longitude": (x + 0.5) / float(2**lon_bits) * 360.0 - 180.0,
            "latitude": (y + 0.5) / float(2**lat_bits) * 180.0 - 90.0,
            "lon_err": F.lit(180.0 / 2**lon_bits),
            "lat_err": F.lit(90.0 / 2**lat_bits),
        }
    )


def geohash_grid(
    df: DataFrame, lat: str, lon: str, precision: int, agg: str = "count", weight: str | None = None
) -> DataFrame:
    """AG28: points per geohash cell; the text is built once per cell, after grouping."""
    x, y = geohash_cell(F.col(lat), F.col(lon), precision)
    placed = df.dropna(subset=[lat, lon]).withColumns({"cell_x": x, "cell_y": y})
    cells = _cells(placed, ["cell_x", "cell_y"], agg, weight)
    lon_bits, lat_bits = _bits(precision)
    centre_lon = (F.col("cell_x") + 0.5) / float(2**lon_bits) * 360.0 - 180.0
    centre_lat = (F.col("cell_y") + 0.5) / float(2**lat_bits) * 180.0 - 90.0
    return cells.withColumn("geohash", geohash_encode(centre_lat, centre_lon, precision))


def cluster_stats(df: DataFrame, lat: str, lon: str, cell: float, metric: str) -> DataFrame:
    """AG29: per cell count, sum, min, max, mean, population variance and deviation (2 decimals)."""
    m = F.col(metric).cast("double")
    placed = df.dropna(subset=[lat, lon]).groupBy(
        F.floor(F.col(lon) / cell).cast("bigint").alias("cell_x"), F.floor(F.col(lat) / cell).cast("bigint").alias("cell_y")
    )
    return placed.agg(
        F.count(m).alias("count"),
        F.round(F.sum(m), 2).alias("sum"),
        F.min(m).alias("min"),
        F.max(m).alias("max"),
        F.round(F.avg(m), 2).alias("mean"),
        F.round(F.var_pop(m), 2).alias("variance"),
        F.round(F.stddev_pop(m), 2).alias("deviation"),
    )


def bounds(df: DataFrame, x: str, y: str) -> DataFrame:
    """AG30: south-west and north-east corners."""
    return df.agg(
        F.min(x).alias("west"), F.min(y).alias("south"), F.max(x).alias("east"), F.max(y).alias("north")
    )
