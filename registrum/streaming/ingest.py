"""Loads of pages as they arrive: each micro-batch is merged like a load of its own, so a batch that comes again changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.normalize import normalize
from ..operators.routing import route_pages
from ..sources.pages import ENVELOPE, page_items
from ..sources.registry import Registry


def page_stream(registry: Registry, folder: str) -> DataFrame:
    read = registry.spark.readStream.schema(ENVELOPE).option("multiLine", True).json(folder)
    return read.select(F.col("_metadata.file_name").alias("source_file"), "*").filter(F.col("source_file").rlike(r"^page_[0-9]+\.json$"))


def start(registry: Registry, folder: str, checkpoint: str, cities: list[str], source: str = "api_pages", **trigger) -> StreamingQuery:
    """Merges the pages that appear in folder. trigger: as of DataStreamWriter.trigger, by default all that is there and then the end."""

    def batch(pages: DataFrame, _: int) -> None:
        files = pages.count()
        if files:
            registry._load(source, lambda _: normalize(page_items(pages), cities), lambda rows, companies, now, _: route_pages(rows, companies, source, now), files)

    return page_stream(registry, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
