"""Rows for figures: category codes and colours, component and label panels, expression overlays, grid places."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Red, green and blue at equal steps of the default colour scale.
SCALE = ((0.0, 0.0, 0.5), (0.0, 0.5, 1.0), (0.5, 1.0, 0.5), (1.0, 0.5, 0.0), (0.5, 0.0, 0.0))


def category_codes(rows: DataFrame, column: str) -> DataFrame:
    """Adds code: the place, from 0, of a value among the sorted distinct ones; whole numbers are their own codes, null stays null."""
    if rows.schema[column].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        return rows.withColumn("code", F.col(column).cast("long"))
    places = rows.select(column).where(F.col(column).isNotNull()).distinct().withColumn("code", (F.row_number().over(Window.orderBy(column)) - 1).cast("long"))
    return rows.join(places, column, "left")


def category_colours(rows: DataFrame, column: str, scale: tuple[tuple[float, float, float], ...] = SCALE) -> DataFrame:
    """Distinct values of a column with position (0 to 1 at equal steps in sorted order), red, green and blue on a colour scale."""
    values = rows.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    place = (F.row_number().over(Window.orderBy("value")) - 1).cast("double")
    last = (F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))) - 1).cast("double")
    placed = values.withColumn("position", F.coalesce(place / F.nullif(last, F.lit(0.0)), F.lit(0.0)))
    return placed.select("value", "position", *[_between(F.col("position"), [c[i] for c in scale]).alias(n) for i, n in enumerate(("red", "green", "blue"))])


def _between(position: Column, stops: list[float]) -> Column:
    """Linear interpolation of stops at equal steps from 0 to 1."""
    steps = max(1, len(stops) - 1)
    at = F.least(F.floor(position * steps), F.lit(steps - 1)).cast("int")
    table = F.array(*[F.lit(float(s)) for s in (stops if len(stops) > 1 else stops * 2)])
    low, high = F.get(table, at), F.get(table, at + 1)
    return low + (high - low) * (position * steps - at)


def component_panels(projection: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """cell, panel ('0-1'), x, y for each pair of components, from cell, component, x.

    The wanted components of a cell are gathered by one aggregate; a cell without one of a pair has null there.
    """
    wanted = sorted({c for pair in pairs for c in pair})
    wide = projection.where(F.col("component").isin(wanted)).groupBy("cell").agg(*[F.max(F.when(F.col("component") == c, F.col("x"))).alias(f"c{c}") for c in wanted])
    panels = F.array(*[F.struct(F.lit(f"{a}-{b}").alias("panel"), F.col(f"c{a}").alias("x"), F.col(f"c{b}").alias("y")) for a, b in pairs])
    return wide.select("cell", F.inline(panels))


def label_panel(places: DataFrame, labels: DataFrame) -> DataFrame:
    """label, n, x, y: size and middle of each label's cells on a map (cell, x, y); cells without a label count under null."""
    return places.join(labels, "cell", "left").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y"))


def expression_overlay(places: DataFrame, matrix: DataFrame, genes: list) -> DataFrame:
    """cell, x, y, gene, value of the wanted genes on a map; cells without a row of a gene have 0."""
    wanted = places.withColumn("gene", F.explode(F.array(*[F.lit(g) for g in genes])))
    some = matrix.where(F.col("gene").isin(genes)).groupBy("cell", "gene").agg(F.sum("value").cast("double").alias("value"))
    return wanted.join(some, ["cell", "gene"], "left").select("cell", "x", "y", "gene", F.coalesce("value", F.lit(0.0)).alias("value"))


def grid_places(spark: SparkSession, panels: int, most_columns: int = 4) -> DataFrame:
    """panel, row, col (from 0) of a figure with at most so many columns, filled row by row in nearly a square."""
    columns = max(1, min(most_columns, math.ceil(math.sqrt(max(0, panels)))))
    return spark.range(panels).select(F.col("id").alias("panel"), F.floor(F.col("id") / columns).cast("long").alias("row"), (F.col("id") % columns).alias("col"))


def eigengap(values: DataFrame) -> DataFrame:
    """n_components, gap: how many components come before the largest fall of value (ties to the fewest), from component, value."""
    order = Window.orderBy(F.desc("value"), "component")
    falls = values.select(F.row_number().over(order).cast("long").alias("n_components"), (F.col("value") - F.lead("value").over(order)).alias("gap")).where("gap is not null")
    return falls.orderBy(F.desc("gap"), "n_components").limit(1)


def components_for(values: DataFrame, share: float = 0.75, otherwise: int = 300) -> DataFrame:
    """n_components: the fewest leading components with that share of all variance, or ``otherwise`` where as many don't reach it."""
    order = Window.orderBy(F.desc("value"), "component")
    total = F.sum("value").over(Window.partitionBy(F.lit(1)))
    reached = values.select(F.row_number().over(order).cast("long").alias("k"), (F.sum("value").over(order) / total).alias("part")).where(F.col("part") >= share)
    least = F.min("k")
    return reached.agg(F.when(least <= otherwise, least).otherwise(F.lit(otherwise)).cast("long").alias("n_components"))
