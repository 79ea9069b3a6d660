"""Neighbours on the globe."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrawave.functions import cx
from terrawave.session import release, small, stash


def nearest(points: DataFrame, n: int, id_col: str = "id", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """id, other, km, place of the n nearest other points of each point, by great-circle distance (to a millimetre, then by id).

    Points lie in cubes of space; all within a cube's width of a point are in the 27 cubes around it. A point that finds n
    neighbours so near is done; the others go on with cubes twice as wide, until the cubes hold the globe.
    """
    p = points.select(F.col(id_col).alias("id"), F.radians(lat).alias("_f"), F.radians(lon).alias("_l"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
    p = stash(p.select("id", "lat", "lon", (F.cos("_f") * F.cos("_l")).alias("x"), (F.cos("_f") * F.sin("_l")).alias("y"), F.sin("_f").alias("z")), "points")
    # Of points at one place the n + 1 least ids are all that another point, or one of them, can have among its n nearest.
    same = Window.partitionBy("lat", "lon").orderBy("id")
    told = stash(p.withColumn("_same", F.row_number().over(same)).where(F.col("_same") <= n + 1).drop("_same"), "told")
    width = math.sqrt(8 * math.pi * (n + 1) / max(p.count(), 1))
    todo, done = p, []
    while True:
        width = min(width, 2.1)
        cell = [F.floor(F.col(c) / width) for c in "xyz"]
        around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1))))
        ask = todo.select("*", around.alias("d")).select("id", "lat", "lon", "x", "y", "z", *((c + F.col(f"d.{v}")).alias(v) for c, v in zip(cell, "ijk", strict=True)))
        held = told.select(F.col("id").alias("other"), *(F.col(c).alias(f"{c}2") for c in ("lat", "lon", "x", "y", "z")), *(c.alias(v) for c, v in zip(cell, "ijk", strict=True)))
        chord = F.sqrt(sum((F.col(c) - F.col(f"{c}2")) ** 2 for c in "xyz"))
        near = ask.join(held, list("ijk")).where((F.col("id") != F.col("other")) & (chord <= (width if width < 2.1 else 3.0)))
        near = near.select("id", "other", cx.distance_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")).alias("km"))
        place = F.row_number().over(Window.partitionBy("id").orderBy(F.round("km", 6), "other"))
        near = stash(near.withColumn("place", place).where(F.col("place") <= n), "near")
        if width >= 2.1:
            done.append(near)
            break
        full = stash(near.where(F.col("place") == n).select("id"), "full")
        done.append(near.join(small(full), "id", "left_semi"))
        rest = stash(todo.join(small(full), "id", "left_anti"), "rest")
        if todo is not p:
            release(todo)
        todo, width = rest, 2 * width
        if todo.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
