"""Dependency graphs of pipeline steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topological(spark: SparkSession, steps: dict[str, list[str]]) -> DataFrame:
    """``step, depth``: each step below all steps it depends on.

    An unknown dependency or a cycle raises ValueError. The definition is a configuration of a few steps.
    """
    unknown = sorted({d for needs in steps.values() for d in needs} - set(steps))
    if unknown:
        raise ValueError(f"unknown dependencies: {', '.join(unknown)}")
    depth: dict[str, int] = {}
    while len(depth) < len(steps):
        ready = [s for s, needs in steps.items() if s not in depth and all(d in depth for d in needs)]
        if not ready:
            raise ValueError("the steps depend on each other in a cycle")
        for s in ready:
            depth[s] = max((depth[d] + 1 for d in steps[s]), default=0)
    return spark.createDataFrame(list(depth.items()) or [], "step string, depth int")
