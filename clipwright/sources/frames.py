"""A data source of frame numbers: spark.read.format("frames") with fps, start_s, end_s and stride as options."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class FrameSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return "offset long, frame_index long, timestamp_s double"

    def reader(self, schema) -> DataSourceReader:
        return FrameReader(self.options)


class FrameReader(DataSourceReader):
    """Frames from start to end, the end included; a stride below one is one. Partitions are runs of frames."""

    def __init__(self, options):
        self.fps = float(options.get("fps", 0))
        on = lambda key: round(float(options.get(key, 0)) * self.fps) if self.fps > 0 else 0
        self.first, self.last = on("start_s"), on("end_s")
        self.stride = max(1, int(options.get("stride", 1)))
        self.rows = max(1, int(options.get("rows", 100_000)))

    def partitions(self) -> list[InputPartition]:
        step = self.stride * self.rows
        return [InputPartition(k) for k in range(self.first, self.last + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for k in range(partition.value, min(self.last + 1, partition.value + self.stride * self.rows), self.stride):
            yield k - self.first, k, k / self.fps if self.fps > 0 else 0.0


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FrameSource)
