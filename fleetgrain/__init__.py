"""Transit speed analytics as Spark jobs."""

from fleetgrain.params import City, WalkParams
from fleetgrain.session import build_session

__all__ = ["City", "WalkParams", "build_session"]
