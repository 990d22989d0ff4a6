"""A data source that reads archived pages of feeds, one partition a window of days.

``spark.read.format("feed_pages").option("root", folder)...`` reads pages of Atom text from ``root/FROM_TO/page-N.xml``: windows of
``days`` days tile [start, end]; a partition reads the pages of its window until one is missing, is empty, or the announced total is
reached, and stops at offset ``most`` with a row that says so. Filters on ``window_from`` and ``window_to`` prune windows before any is read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "window_from date, window_to date, page int, offset int, total int, entries int, truncated boolean, xml string"
_TOTAL = re.compile(r"<(?:\w+:)?totalResults[^>]*>\s*(\d+)\s*<")


def windows(start: date, end: date, days: int = 7) -> list[tuple[date, date]]:
    """Closed windows of ``days`` days that tile [start, end]; one if the span is shorter, none if it is empty."""
    out = []
    while start <= end:
        out.append((start, min(start + timedelta(days - 1), end)))
        start += timedelta(days)
    return out


def range_query(categories: list[str], start: date, end: date) -> str:
    """The text by which a feed is asked for categories and days, both ends included."""
    cats = " OR ".join(f"cat:{c}" for c in categories)
    span = f"submittedDate:[{start:%Y%m%d}0000 TO {end:%Y%m%d}2359]"
    return f"({cats}) AND {span}" if cats else span


@dataclass
class Window(InputPartition):
    start: date
    end: date


class FeedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feed_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "FeedReader":
        return FeedReader(dict(self.options))


class FeedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["root"]
        self.most = int(options.get("most", 10_000))
        start, end = (date.fromisoformat(options[k]) for k in ("start", "end"))
        self.windows = windows(start, end, int(options.get("days", 7)))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        test = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b}
        for f in filters:
            side = {("window_from",): 0, ("window_to",): 1}.get(getattr(f, "attribute", None))
            if side is None or type(f) not in test:
                yield f
            else:
                self.windows = [w for w in self.windows if test[type(f)](w[side], f.value)]

    def partitions(self) -> list[InputPartition]:
        return [Window(*w) for w in self.windows]

    def read(self, partition: Window):
        folder = os.path.join(self.root, f"{partition.start}_{partition.end}")
        offset, page = 0, 0
        while True:
            path = os.path.join(folder, f"page-{page}.xml")
            if not os.path.exists(path):
                return
            with open(path, encoding="utf-8") as f:
                xml = f.read()
            n = len(re.findall(r"<(?:\w+:)?entry[\s>]", xml))
            total = int(m.group(1)) if (m := _TOTAL.search(xml)) else None
            if not n:
                return
            cut = offset + n >= self.most and (total is None or total > offset + n)
            yield partition.start, partition.end, page, offset, total, n, cut, xml
            offset, page = offset + n, page + 1
            if cut or (total is not None and offset >= total):
                return


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FeedPages)
