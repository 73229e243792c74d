"""Web pages as Spark tables: listing pages of hosts as a source for batch and stream, and a fetch of a table of URLs.

`spark.dataSource.register(WebPages)`, then `spark.read.format("web_pages")` or `spark.readStream`. Options:
templates (JSON list of URLs that hold {page}), first, last (page numbers, both included), until (pattern that every
page of a listing matches; the first page without it is its last), sweepSeconds (stream: how often all pages are read
again), agent, minPause, maxPause, attempts, transport (module:function, plain HTTP if none).

A partition is one host with its range of pages. So one task at a time asks a host, and robots rules, pauses and
retries hold wherever tasks run; hosts are asked side by side. A host that blocks gives one row with that error and is
not asked again. A page that can't be had is a row with its error. A task that is run again asks its pages again.

The stream's offset is the number of the sweep that the clock is in: a restart within a sweep reads nothing twice, and
sweeps missed while the stream was down are one sweep. An interrupted sweep is read again as a whole.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from importlib import import_module
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tessera.sources.fetch import Blocked, Fetcher, FetchError, Transport

SCHEMA = "host string, page int, url string, body string, error string, fetched_at timestamp"


def plain_http(url: str) -> tuple[int, dict[str, str], str]:
    try:
        with urllib.request.urlopen(url, timeout=30) as answer:
            return answer.status, dict(answer.headers), answer.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as refused:
        return refused.code, dict(refused.headers), ""


def transport_named(name: str | None) -> Transport:
    if not name:
        return plain_http
    module, _, function = name.partition(":")
    return getattr(import_module(module), function)


def fetcher(options: dict[str, str]) -> Fetcher:
    low = float(options.get("minPause", 2.0))
    pause = (low, max(low, float(options.get("maxPause", 5.0))))
    return Fetcher(transport_named(options.get("transport")), options.get("agent", "tessera"), pause, int(options.get("attempts", 3)))


def host_of(url: str | None) -> str:
    try:
        return urlsplit(url or "").netloc
    except ValueError:
        return ""


def asked(get: Fetcher, url: str | None) -> tuple[str | None, str | None, bool]:
    """(body, error, whether the host may be asked on)."""
    if not host_of(url):
        return None, "fetch_failed: no host", True
    try:
        return get.get(url), None, True
    except FetchError as e:
        return None, f"{e.kind}: {e}", not isinstance(e, Blocked)


@dataclass
class HostPages(InputPartition):
    host: str
    templates: list[str]
    first: int
    last: int


class _Pages:
    """What batch and stream share: partitions by host, and how one is read."""

    def __init__(self, options: dict[str, str]):
        self.options = options
        self.templates = json.loads(options["templates"])
        self.first, self.last = int(options.get("first", 1)), int(options.get("last", 1))
        faulty = [t for t in self.templates if "{page}" not in t or not host_of(t)]
        if faulty:
            raise ValueError(f"no URLs with {{page}}: {faulty}")

    def by_host(self) -> list[HostPages]:
        hosts: dict[str, list[str]] = {}
        for template in dict.fromkeys(self.templates):
            hosts.setdefault(host_of(template), []).append(template)
        return [HostPages(host, templates, self.first, self.last) for host, templates in hosts.items()]

    def rows(self, part: HostPages) -> Iterator[tuple]:
        import re

        get = fetcher(self.options)
        until = re.compile(self.options["until"]) if "until" in self.options else None
        for template in part.templates:
            for page in range(part.first, part.last + 1):
                url = template.replace("{page}", str(page))
                body, error, on = asked(get, url)
                yield part.host, page, url, body, error, datetime.now(UTC)
                if not on:
                    return
                if until and body is not None and not until.search(body):
                    break


class PagesReader(_Pages, DataSourceReader):
    def partitions(self) -> list[HostPages]:
        return self.by_host()

    def read(self, partition: HostPages) -> Iterator[tuple]:
        return self.rows(partition)


class SweepReader(_Pages, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"sweep": 0}

    def latestOffset(self) -> dict:
        return {"sweep": int(time.time() // float(self.options.get("sweepSeconds", 3600)))}

    def partitions(self, start: dict, end: dict) -> list[HostPages]:
        return self.by_host() if end["sweep"] > start["sweep"] else []

    def read(self, partition: HostPages) -> Iterator[tuple]:
        return self.rows(partition)

    def commit(self, end: dict) -> None:
        """Nothing is held for a sweep."""


class WebPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "web_pages"

    def schema(self) -> str:
        return SCHEMA

    def _given(self) -> dict[str, str]:
        # Spark hands the options over in lower case
        names = ("templates", "first", "last", "until", "sweepSeconds", "agent", "minPause", "maxPause", "attempts", "transport")
        return {n: self.options[n] for n in names if self.options.get(n) is not None}

    def reader(self, schema) -> PagesReader:
        return PagesReader(self._given())

    def streamReader(self, schema) -> SweepReader:
        return SweepReader(self._given())


def fetched(urls: DataFrame, options: dict[str, str], order: str = "nth") -> DataFrame:
    """(url, body, error) of (order, url) rows: each host is asked by one task, in order, as a stream of rows.

    Behind a blocking page the host is not asked, and its other URLs have no row. A URL without a host, or null, is an error. Fetching is no
    function of its input: write the result before it is read twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, blocked = fetcher(options), set()
        for b in batches:
            for host, url in zip(b["__host"].to_pylist(), b["url"].to_pylist(), strict=True):
                if host in blocked:
                    continue
                body, error, on = asked(get, url)
                if not on:
                    blocked.add(host)
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (url, body, error)], names=["url", "body", "error"])

    hosts = urls.select(F.lower(F.try_parse_url("url", F.lit("AUTHORITY"))).alias("__host"), F.col(order).alias("__order"), "url")
    return hosts.repartition("__host").sortWithinPartitions("__host", "__order", "url").select("__host", "url").mapInArrow(run, "url string, body string, error string")
