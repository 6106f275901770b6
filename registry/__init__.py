"""Registered queries: each name with its Spark form and, where one exists, its SQL form."""

from registry import files, planning, quality, serving, streams, walking

ALL = {
    **walking.QUERIES,
    **planning.QUERIES,
    **serving.QUERIES,
    **quality.QUERIES,
    **files.QUERIES,
    **streams.QUERIES,
}
