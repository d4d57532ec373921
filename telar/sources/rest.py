"""A paged REST source as a Python Data Source: a partition per page range.

``spark.dataSource.register(PagedSource)`` and then
``spark.read.format("paged").option("base", ...)``. The transport is a class
named by the option ``transport`` (module:Class) so that tests, captured pages
and browsers can stand in; the default reads JSON over HTTP.
Options: ``size`` (rows a page), ``max_pages`` (no limit unless given), ``known_id``
(stop at the first page with an id at or below it), ``tries`` and ``pause`` (seconds before
the second try, twice as many before each further one), ``fallback`` (a base
used once the first one refuses with 401 or 403; without one that is an error at once),
``token`` (sent as bearer; Spark blots out options of this name), ``whole`` (each answer
stays one payload, for endpoints that give no list of records), and any ``param.NAME`` pushed to
the API. A page count that the source leaves out follows from its number of records. Records that are no objects or have no integer id come through with a null
id, for validation to turn down.

``spark.readStream.format("paged")`` reads the same source as a stream whose offset
is the highest id: a batch is what lies between two ids, so it can be replayed, and a
restart from a checkpoint goes on behind the last one. ``known_id`` is where a new stream
starts. Records without an integer id have no place between two offsets and are left to the batch reader.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.request
from collections.abc import Iterator
from urllib.parse import urlencode

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "page int, id long, payload string"


class HttpTransport:
    """fetch(page, size, params) -> {"pageable": {...}, "data": [...]}. ``get`` is one request; tries and fallback are the same for all kinds of it."""

    def __init__(self, options: dict):
        self.base, self.tries, self.fallback = options["base"], int(options.get("tries", 3)), options.get("fallback")
        self.pause, self.token = float(options.get("pause", 1)), options.get("token")

    def get(self, base: str, query: dict):
        asked = f"{base}?{urlencode(query)}"
        if self.token:
            asked = urllib.request.Request(asked, headers={"Authorization": f"Bearer {self.token}"})
        with urllib.request.urlopen(asked, timeout=60) as r:
            return json.load(r)

    def fetch(self, page: int, size: int, params: dict) -> dict:
        for attempt in range(self.tries):
            try:
                got = self.get(self.base, {"page": page, "size": size} | params)
                if not isinstance(got, dict):
                    raise ValueError("the answer is no object")
                return got
            except (OSError, ValueError) as e:
                if getattr(e, "code", None) in (401, 403):
                    if not self.fallback:
                        raise
                    self.base, self.fallback = self.fallback, None
                    return self.fetch(page, size, params)
                if attempt + 1 == self.tries:
                    raise
                time.sleep(self.pause * 2**attempt)
        return {}


class CapturedPages(HttpTransport):
    """Answers kept by ``captured.write_pages`` in the folder ``base``; ``param.objeto`` chooses among them as the API does. A folder is listed once a task."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.opened: dict = {}

    def get(self, base: str, query: dict):
        from pyarrow import dataset, fs

        if base not in self.opened:
            where, path = fs.FileSystem.from_uri(base)
            self.opened[base] = dataset.dataset(path, filesystem=where, format="parquet")
        asked = (dataset.field("page") == query["page"]) & (dataset.field("objeto") == query.get("objeto", ""))
        bodies = self.opened[base].to_table(columns=["body"], filter=asked)["body"].to_pylist()
        return json.loads(bodies[0]) if bodies else {"data": []}


def record_id(record) -> int | None:
    """The integer id of a record, if it has one."""
    key = record.get("idContrato") if isinstance(record, dict) else None
    return key if isinstance(key, int) and not isinstance(key, bool) else None


def transport(options: dict):
    module, _, name = options.get("transport", f"{__name__}:HttpTransport").partition(":")
    return getattr(importlib.import_module(module), name)(options)


class Pages(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class Ids(InputPartition):
    """Ids above ``low``, up to ``high``."""

    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _Paged:
    def __init__(self, options: dict):
        self.options = dict(options)
        self.size = int(options.get("size", 100))
        self.whole = str(self.options.get("whole", "false")).lower() == "true"
        self.params = {k.removeprefix("param."): v for k, v in self.options.items() if k.startswith("param.")}

    def page_count(self, head: dict) -> int:
        of = head.get("pageable") or {}
        return int(of.get("totalPages") or -(-int(of.get("totalElements") or 0) // self.size) or 1)

    def first_page_down_to(self, source, key: int, pages: int, head: dict | None = None) -> int:
        """The first page with an id at or below the key, or the last page; ids fall from page to page."""
        first, last = 1, pages
        while first < last:
            middle = (first + last) // 2
            rows = head.get("data") if head is not None and middle == 1 else source.fetch(middle, self.size, self.params).get("data")
            ids = [k for k in map(record_id, rows or []) if k is not None]
            first, last = (first, middle) if not rows or ids and min(ids) <= key else (middle + 1, last)
        return first


class PagedReader(_Paged, DataSourceReader):

    def partitions(self) -> list[Pages]:
        """The first page tells how many there are. With ``known_id`` (ids fall from page to page) the last page needed is found by halving."""
        source, most = transport(self.options), int(self.options.get("max_pages", 0))
        head = source.fetch(1, self.size, self.params)
        pages = self.page_count(head)
        pages = min(most, pages) if most else pages
        known = int(self.options.get("known_id", 0))
        if known:
            pages = self.first_page_down_to(source, known, pages, head)
        step = max(1, pages // int(self.options.get("partitions", 32)) or 1)
        return [Pages(a, min(pages, a + step - 1)) for a in range(1, pages + 1, step)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        source, known = transport(self.options), int(self.options.get("known_id", 0))
        since = "known_id" in self.options
        for page in range(partition.first, partition.last + 1):
            got = source.fetch(page, self.size, self.params)
            if self.whole:
                yield page, None, json.dumps(got, ensure_ascii=False)
                continue
            rows = got.get("data") or []
            for r in rows:
                key = record_id(r)
                if key is None or not since or key > known:
                    yield page, key, json.dumps(r, ensure_ascii=False)
            if not rows:
                return


class PagedStream(_Paged, DataSourceStreamReader):
    """Each task finds the pages of its own range of ids and reads on until it is below it.

    New records push old ones to later pages, never to earlier ones. So a task that
    reads forward may see a record again, which it leaves out, but misses none.
    """

    def initialOffset(self) -> dict:
        return {"id": int(self.options.get("known_id", 0))}

    def latestOffset(self) -> dict:
        rows = transport(self.options).fetch(1, self.size, self.params).get("data") or []
        return {"id": max([self.initialOffset()["id"], *(k for k in map(record_id, rows) if k is not None)])}

    def partitions(self, start: dict, end: dict) -> list[Ids]:
        low, high = start["id"], end["id"]
        n = max(1, min(int(self.options.get("partitions", 32)), (high - low) // self.size))
        cuts = [low + (high - low) * i // n for i in range(n + 1)]
        return [Ids(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]

    def read(self, partition: Ids) -> Iterator[tuple]:
        source, seen = transport(self.options), set()
        pages = self.page_count(source.fetch(1, self.size, self.params))
        page = self.first_page_down_to(source, partition.high, pages)
        while rows := source.fetch(page, self.size, self.params).get("data"):
            ids = [record_id(r) for r in rows]
            for key, r in zip(ids, rows, strict=True):
                if key is not None and partition.low < key <= partition.high and key not in seen:
                    seen.add(key)
                    yield page, key, json.dumps(r, ensure_ascii=False)
            if min((k for k in ids if k is not None), default=partition.low + 1) <= partition.low:
                return
            page += 1

    def commit(self, end: dict) -> None:
        """The source keeps nothing for us."""


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)

    def streamReader(self, schema) -> PagedStream:
        return PagedStream(self.options)
