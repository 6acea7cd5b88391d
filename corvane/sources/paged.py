"""A data source for paged indexes: each partition walks the pages of one slice."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Slice(InputPartition):
    def __init__(self, value: str):
        self.value = value


class _Reader(DataSourceReader):
    def __init__(self, slices: list[str], page: Callable[[str, int], list], pages: int):
        self.slices, self.page, self.pages = slices, page, pages

    def partitions(self) -> list[Slice]:
        return [Slice(s) for s in self.slices]

    def read(self, partition: Slice) -> Iterator[tuple]:
        for number in range(self.pages):
            rows = self.page(partition.value, number)
            if not rows:
                return
            for row in rows:
                yield partition.value, number, json.dumps(row, sort_keys=True)
        if self.page(partition.value, self.pages):
            raise ValueError(f"slice {partition.value} has more than {self.pages} pages")


def paged(spark: SparkSession, name: str, slices: list[str], page: Callable[[str, int], list], pages: int = 1000) -> DataFrame:
    """``slice, page, payload`` of an index that ``page(slice, number)`` reads, until a page is empty.

    A slice with more than ``pages`` pages fails the query; nothing is dropped.

    ``page`` is injected: a client for papers by month, repositories by query, or a fake.
    """

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "slice string, page int, payload string"

        def reader(self, schema) -> DataSourceReader:
            return _Reader(slices, page, pages)

    spark.dataSource.register(Paged)
    return spark.read.format(name).load()
