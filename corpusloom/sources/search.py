"""A search API with facets and pages, over any transport; large results are cut into slices that a window allows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RETRIED = frozenset((408, 425, 429, 500, 502, 503, 504))
#: (status, headers, text, parsed JSON or None) of a request for (path, parameters).
Transport = Callable[[str, dict], tuple[int, dict, str, dict | None]]


class Unexpected(Exception):
    """An answer that is no result: an HTML page, or an error that trying again does not mend."""


@dataclass
class SearchClient:
    transport: Transport
    tries: int = 4
    backoff: float = 2.0
    sleep: Callable[[float], None] = time.sleep

    def get(self, path: str, parameters: dict) -> dict:
        for attempt in range(self.tries):
            status, headers, text, body = self.transport(path, parameters)
            if status in RETRIED and attempt + 1 < self.tries:
                said = str({k.lower(): v for k, v in headers.items()}.get("retry-after", ""))
                self.sleep(float(said) if said.isdigit() else self.backoff * 2**attempt)
                continue
            if status != 200 or body is None:
                raise Unexpected("an HTML page in place of a result" if text.lstrip().startswith("<") else f"http_{status}")
            return body
        raise Unexpected("tries used up")

    def search(self, query: str = "", filters: list[str] = (), fields: list[str] = (), facets: list[str] = (), page: int = 1, limit: int = 100, sort: str = "") -> dict:
        asked = {"lookfor": query, "type": "AllFields", "filter[]": list(filters), "field[]": list(fields), "facet[]": list(facets), "page": page, "limit": min(limit, 100), "sort": sort}
        return self.get("/search", {k: v for k, v in asked.items() if v not in ("", [])})

    def total(self, query: str = "", filters: list[str] = ()) -> int:
        return int(self.search(query, filters, limit=0).get("resultCount", 0))

    def facet(self, name: str, query: str = "", filters: list[str] = ()) -> list[tuple[str, int]]:
        found = self.search(query, filters, facets=[name], limit=0).get("facets", {}).get(name, [])
        return [(f["value"], int(f["count"])) for f in found]

    def record(self, ids: list[str], fields: list[str] = ()) -> list[dict]:
        return self.get("/record", {"id[]": list(ids), "field[]": list(fields)}).get("records", [])

    def slices(self, query: str = "", filters: list[str] = (), window: int = 9000, by: tuple[str, ...] = ("publishDate", "institution")) -> Iterator[tuple[list[str], int]]:
        """Filters and sizes of slices no larger than the window: cut by the first facet, what is still too large by the next."""
        n = self.total(query, filters)
        if n <= window or not by:
            yield list(filters), n
            return
        for value, count in self.facet(by[0], query, filters):
            if count:
                yield from self.slices(query, [*filters, f'{by[0]}:"{value}"'], window, by[1:])

    def rows(self, query: str, filters: list[str], fields: list[str] = (), most: int | None = None) -> Iterator[dict]:
        page, given = 1, 0
        while most is None or given < most:
            found = self.search(query, filters, fields, page=page).get("records", [])
            for r in found[: None if most is None else most - given]:
                given += 1
                yield r
            if len(found) < 100:
                return
            page += 1


def collected(spark: SparkSession, client: SearchClient, query: str, filters: list[str] = (), fields: list[str] = (), window: int = 9000) -> DataFrame:
    """(id, record as JSON, query, collected_at): the driver plans slices, a task asks each for its rows. Write it before use."""
    import json

    plan = [(k, f, n) for k, (f, n) in enumerate(client.slices(query, list(filters), window))]
    slices = spark.createDataFrame(plan, "k int, filters array<string>, n long").repartition(max(1, len(plan)), "k")

    def run(batches):
        for batch in batches:
            rows = [(str(r.get("id", "")), json.dumps(r, ensure_ascii=False), query) for own in batch["filters"] for r in client.rows(query, list(own), fields)]
            yield pd.DataFrame(rows, columns=["id", "record", "query"])

    return slices.mapInPandas(run, "id string, record string, query string").withColumn("collected_at", F.current_timestamp())
