"""Helpers shared by the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import driver_views as views
from fleetgrain.operators import walk
from fleetgrain.operators.shapes import build_shapes
from fleetgrain.session import apply_conf, cut_lineage

Query = Callable[[SparkSession, str], DataFrame]

_stages: dict[tuple, DataFrame] = {}


def stage(spark: SparkSession, sf_dir: str, name: str, build: Query) -> DataFrame:
    """A pipeline stage written once per session and folder and read by its consumers."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stages:
        _stages[key] = cut_lineage(build(spark, sf_dir))
    return _stages[key]


def walk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered points with their geometry key, the dimension both below start from."""
    return stage(spark, sf_dir, "walk_lines", views.keyed_lines)


def walk_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "walk_trips", lambda s, d: views.trips(s, d, walk_lines(s, d)))


def walk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "walk_plan", views.walk_days)


def walk_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "walk_shapes", lambda s, d: build_shapes(walk_lines(s, d)))


def judged_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The walk itself, not kept."""
    apply_conf(spark)
    return walk.walk(
        views.positions(spark, sf_dir),
        walk_plan(spark, sf_dir),
        walk_trips(spark, sf_dir),
        walk_shapes(spark, sf_dir),
        views.WALK,
        ["seq"],
    )


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "steps", judged_steps)
