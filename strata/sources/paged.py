"""A paged source as a Spark data source: ranges of pages are read by the tasks, up to the first empty page.

Pages are numbered without gaps and lie in a shared folder, ``page=<number>/`` each, as files of JSON lines (a stand-in
for a paged service). The plan finds the last page by doubling and halving, so a few pages
are looked at before the tasks start, whatever their number. A task that meets an empty page before the last raises: the pages
changed in between, and rows would be missing.
"""
from __future__ import annotations

import json

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "strata_pages"


class Pages(InputPartition):
    def __init__(self, first: int, end: int):
        self.first, self.end = first, end


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str, first: int, per_task: int):
        self.schema, self.path, self.first, self.per_task = schema, path.rstrip("/"), first, per_task

    def page(self, number: int) -> list[dict]:
        store, root = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(f"{root}/page={number}", allow_not_found=True))
        rows = []
        for f in sorted(found, key=lambda f: f.path):
            if f.is_file and not f.base_name.startswith(("_", ".")):
                with store.open_input_stream(f.path) as stream:
                    rows += [json.loads(line) for line in stream.read().splitlines() if line.strip()]
        return rows

    def end(self) -> int:
        """The first empty page."""
        if not self.page(self.first):
            return self.first
        full, step = self.first, 1
        while self.page(full + step):
            full, step = full + step, 2 * step
        empty = full + step
        while empty - full > 1:
            middle = (full + empty) // 2
            full, empty = (middle, empty) if self.page(middle) else (full, middle)
        return empty

    def partitions(self) -> list[Pages]:
        end = self.end()
        return [Pages(i, min(i + self.per_task, end)) for i in range(self.first, end, self.per_task)] or [Pages(self.first, self.first)]

    def read(self, partition: Pages):
        arrow = to_arrow_schema(self.schema)
        for number in range(partition.first, partition.end):
            rows = self.page(number)
            if not rows:
                raise ValueError(f"page {number} of {self.path} is empty, but a later one is not")
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)


class PagedSource(DataSource):
    """Options: ``path``, ``firstPage`` (0), ``pagesPerTask`` (16). The schema is the caller's; a field that a row lacks is null."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, self.options["path"], int(self.options.get("firstPage", 0)), int(self.options.get("pagesPerTask", 16)))


def read_pages(spark: SparkSession, path: str, schema: StructType | str, first_page: int = 0, pages_per_task: int = 16) -> DataFrame:
    """All rows of all pages before the first empty one."""
    spark.dataSource.register(PagedSource)
    options = {"path": path, "firstPage": str(first_page), "pagesPerTask": str(pages_per_task)}
    return spark.read.format(FORMAT).schema(schema).options(**options).load()
