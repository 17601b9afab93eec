"""Geometry feeds: cable paths from GeoJSON, points to feature collections and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions import strict
from beaconlake.functions.pieces import piece_of
from beaconlake.operators import feeds

PATH_TYPE = "array<array<struct<x:double,y:double>>>"
GRID = 10000
COLLECTION_SIZE = 10000


def _line(points: Column) -> Column:
    return F.transform(points, lambda p: F.struct(strict.number(p, "$[0]").alias("x"), strict.number(p, "$[1]").alias("y")))


def _usable(paths: Column) -> Column:
    """Paths, or null if a point of theirs lacks a coordinate."""
    broken = F.exists(paths, lambda line: F.exists(line, lambda p: p["x"].isNull() | p["y"].isNull()))
    return F.when(~broken, paths).cast(PATH_TYPE)


def cable_paths(payloads: DataFrame) -> DataFrame:
    """Name, id and path of each feature; a single line becomes a path of one line.

    Other geometries give a null path; a missing name or id becomes `Unknown`.
    """
    r = F.col("record")
    rows = feeds.records(payloads, feeds.array_at("$.features"))
    kind = strict.text(r, "$.geometry.type")
    single = F.array(_line(strict.elements(r, "$.geometry.coordinates")))
    many = F.transform(strict.elements(r, "$.geometry.coordinates"), lambda line: _line(strict.elements(line, "$")))
    unknown = F.lit("Unknown")
    return rows.select(
        *feeds.LINEAGE,
        F.coalesce(strict.text(r, "$.properties.name"), unknown).alias("name"),
        F.coalesce(strict.text(r, "$.properties.id"), unknown).alias("id"),
        _usable(F.when(kind == "LineString", single).when(kind == "MultiLineString", many)).alias("geometry"),
    )


def vertices(paths: DataFrame) -> DataFrame:
    """One row per vertex; a feature without path keeps one row."""
    lines = paths.select(*feeds.LINEAGE, "name", "id", F.posexplode_outer("geometry").alias("line_no", "line"))
    return lines.select(
        *feeds.LINEAGE, "name", "id", "line_no", F.posexplode_outer("line").alias("vertex_no", "vertex")
    ).select(*feeds.LINEAGE, "name", "id", "line_no", "vertex_no", "vertex.x", "vertex.y")


def point(longitude: str = "longitude", latitude: str = "latitude") -> Column:
    return F.struct(F.col(longitude).alias("x"), F.col(latitude).alias("y"))


def located(rows: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    """Rows with both coordinates; NaN is a value."""
    return rows.where(F.col(lon_col).isNotNull() & F.col(lat_col).isNotNull())


def _whole(value: Column) -> Column:
    """A whole number of 32 bits: NaN gives 0, what lies beyond an end gives that end."""
    low, high = -(2**31), 2**31 - 1
    return F.when(F.isnan(value), 0).when(value >= high, high).when(value <= low, low).otherwise(value.cast("int"))


def to_features(
    rows: DataFrame, layer: str | Column, id_col: str, lat_col: str = "latitude", lon_col: str = "longitude"
) -> DataFrame:
    """Located rows as features: integer grid coordinates, all other columns as properties."""
    for name in (lat_col, lon_col):
        if name not in rows.columns:
            raise ValueError(f"column {name} not found")
        if dict(rows.dtypes)[name] != "double":
            raise ValueError(f"column {name} must be double")
    layer_name = F.lit(layer) if isinstance(layer, str) else layer
    given = [c for c in rows.columns if c not in (lat_col, lon_col, id_col)]
    grid = F.array(_whole(F.col(lon_col) * GRID), _whole(F.col(lat_col) * GRID))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.col(id_col).alias("id"),
        F.struct(F.lit("Point").alias("type"), grid.alias("coordinates")).alias("geometry"),
        F.struct(layer_name.alias("_layer"), *given).alias("properties"),
    )
    return located(rows, lat_col, lon_col).select(
        layer_name.alias("layer"), F.col(id_col).alias("feature_id"), F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature")
    )


def to_collections(features: DataFrame, size: int = COLLECTION_SIZE) -> DataFrame:
    """Feature collections per layer, cut by feature id.

    Ids are unique in a layer, so no collection exceeds `size` features, however large
    the layer; a layer with smaller ids is one collection.
    """
    part = piece_of("feature_id", size).alias("part")
    ordered = F.array_sort(F.collect_list(F.struct("feature_id", "feature")))
    body = F.array_join(F.transform(ordered, lambda f: f["feature"]), ",")
    return (
        features.groupBy("layer", part)
        .agg(F.count("*").alias("n_features"), body.alias("body"))
        .select(
            "layer", "part", "n_features",
            F.concat(F.lit('{"type":"FeatureCollection","features":['), "body", F.lit("]}")).alias("collection"),
        )
    )


def from_collections(collections: DataFrame, properties: dict[str, str]) -> DataFrame:
    """Rows of feature collections with their layer; `properties` maps names to types."""
    parsed = collections.select(F.explode(strict.elements(strict.parse("collection"), "$.features")).alias("f"))
    f = F.col("f")
    return parsed.select(
        F.try_variant_get(f, "$.properties._layer", "string").alias("layer"),
        F.try_variant_get(f, "$.id", "bigint").alias("feature_id"),
        F.try_variant_get(f, "$.geometry.coordinates[0]", "int").alias("px"),
        F.try_variant_get(f, "$.geometry.coordinates[1]", "int").alias("py"),
        *[F.try_variant_get(f, f"$.properties.{name}", kind).alias(name) for name, kind in properties.items()],
    )


def layers(collections: DataFrame) -> DataFrame:
    """Names of the layers that occur."""
    return from_collections(collections, {}).select("layer").distinct()
