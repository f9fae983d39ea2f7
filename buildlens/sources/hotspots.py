"""Hotspots from a paged REST service, as a data source, or from saved pages."""

from __future__ import annotations

import json
import os
import urllib.parse
import urllib.request

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

HOTSPOT = (
    "ruleKey string, message string, securityCategory string, vulnerabilityProbability string, component string, line int, status string, resolution string"
)
STATUSES = ("TO_REVIEW", "REVIEWED")
PAGE = 500
NAMES = [c.strip().split(" ")[0] for c in HOTSPOT.split(",")]


class Pages(InputPartition):
    def __init__(self, status: str, page: int):
        self.status, self.page = status, page


class HotspotReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.project, self.size = options["url"].rstrip("/"), options["project"], int(options.get("pagesize", PAGE))

    def _page(self, status: str, page: int) -> dict:
        """A page; any answer but success fails the read, so that a report is never made from a part."""
        query = urllib.parse.urlencode({"projectKey": self.project, "status": status, "ps": self.size, "p": page})
        request = urllib.request.Request(f"{self.url}/api/hotspots/search?{query}")
        if token := os.environ.get("HOTSPOTS_TOKEN"):
            request.add_header("Authorization", f"Bearer {token}")
        with urllib.request.urlopen(request, timeout=30) as answer:
            return json.load(answer)

    def partitions(self) -> list[Pages]:
        """One partition a status and page; the first page of a status tells how many there are."""
        found = []
        for status in STATUSES:
            total = self._page(status, 1).get("paging", {}).get("total", 0)
            found += [Pages(status, k + 1) for k in range(max(1, -(-total // self.size)))]
        return found

    def read(self, partition: Pages):
        for h in self._page(partition.status, partition.page).get("hotspots", []):
            yield tuple(h.get(c) for c in NAMES)


class HotspotSource(DataSource):
    """``spark.read.format("hotspots").option("url", ...).option("project", ...)``; a token comes from HOTSPOTS_TOKEN in the environment of driver and workers."""

    @classmethod
    def name(cls) -> str:
        return "hotspots"

    def schema(self) -> str:
        return HOTSPOT

    def reader(self, schema) -> HotspotReader:
        return HotspotReader(self.options)


def read_service(spark: SparkSession, url: str, project: str) -> DataFrame:
    spark.dataSource.register(HotspotSource)
    return spark.read.format("hotspots").option("url", url).option("project", project).load()


def read_pages(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Hotspots of saved pages (JSON)."""
    return spark.read.schema(f"hotspots array<struct<{HOTSPOT.replace(' string', ':string').replace(' int', ':int')}>>").option("multiLine", True).json(paths).select(F.inline("hotspots"))
