"""An upsert sink as a Python Data Source: batches by key, retries, failures counted and skipped.

``spark.dataSource.register(UpsertSink)`` and then
``df.write.format("upsert").option("transport", "module:Class").mode("append").save()``.
A transport has ``upsert(rows, keys, token)``, which raises if the batch is not taken
(``UnknownColumn`` if the target lacks a column: that is left out and the batch sent again), and ``finished(summary)``.

Options: ``keys`` (comma-separated, ``id`` unless given), ``size`` (rows a batch, 500), ``tries`` (3),
``pause`` (seconds before the first retry, 2, then doubled), ``run`` (a name of the
run, in the tokens), and whatever the transport reads. A batch that still fails after its
tries is counted and left out, with its first and last key and the reason, and the next
one goes on. The token names run, partition and batch, so a task that is run
again sends the same tokens, and a target can tell them. Each attempt reports
what it sent; only those of committed tasks are summed: {"outcome", "rows", "batches", "failed_batches", "failed_rows", "retries", "failures"}.
Of ``failures`` the summary names at most 20.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from itertools import islice

from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

NAMED_FAILURES = 20


class UnknownColumn(Exception):
    """The target has no such column."""


class FolderTransport:
    """A stand-in target: a file of JSON lines for each token, in a folder of any file system."""

    def __init__(self, options: dict):
        from pyarrow import fs

        self.fs, self.path = fs.FileSystem.from_uri(options["folder"])

    def _put(self, name: str, text: str) -> None:
        self.fs.create_dir(self.path, recursive=True)
        with self.fs.open_output_stream(f"{self.path}/{name}") as out:
            out.write(text.encode())

    def upsert(self, rows: list[dict], keys: list[str], token: str) -> None:
        self._put(f"{token}.json", "".join(json.dumps(r, ensure_ascii=False, default=str) + "\n" for r in rows))

    def finished(self, summary: dict) -> None:
        self._put("_summary", json.dumps(summary, ensure_ascii=False))


def transport(options: dict):
    module, _, name = options.get("transport", f"{__name__}:FolderTransport").partition(":")
    return getattr(importlib.import_module(module), name)(options)


@dataclass
class Sent(WriterCommitMessage):
    rows: int = 0
    batches: int = 0
    failed_batches: int = 0
    failed_rows: int = 0
    retries: int = 0
    failures: list = field(default_factory=list)


class UpsertWriter(DataSourceWriter):
    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns = dict(options), columns
        self.keys = [k.strip() for k in self.options.get("keys", "id").split(",")]
        if missing := [k for k in self.keys if k not in columns]:
            raise ValueError(f"no columns {missing} to upsert by")

    def write(self, iterator: Iterator) -> Sent:
        from pyspark import TaskContext

        size, tries, pause = int(self.options.get("size", 500)), max(1, int(self.options.get("tries", 3))), float(self.options.get("pause", 2))
        target, partition, out, dropped = transport(self.options), TaskContext.get().partitionId(), Sent(), set()
        while batch := [r.asDict(recursive=True) for r in islice(iterator, size)]:
            token = f"{self.options.get('run', 'run')}-{partition:06d}-{out.batches:06d}"
            out.batches += 1
            attempt = 0
            while True:
                try:
                    target.upsert([{k: v for k, v in r.items() if k not in dropped} for r in batch], self.keys, token)
                    out.rows += len(batch)
                    break
                except UnknownColumn as e:
                    name = str(e)
                    if name in dropped or name in self.keys or name not in self.columns:
                        raise
                    dropped.add(name)
                except (TypeError, NameError, AttributeError):
                    raise  # a fault of the program, not of the target
                except Exception as e:
                    attempt += 1
                    if attempt == tries:
                        out.failed_batches += 1
                        out.failed_rows += len(batch)
                        if len(out.failures) < NAMED_FAILURES:
                            out.failures.append({"first": [batch[0][k] for k in self.keys], "last": [batch[-1][k] for k in self.keys], "error": f"{type(e).__name__}: {e}"})
                        break
                    out.retries += 1
                    time.sleep(pause * 2 ** (attempt - 1))
        return out

    def _finish(self, outcome: str, messages: list) -> None:
        total = Sent()
        for m in messages:
            if m is not None:
                for k, v in asdict(m).items():
                    setattr(total, k, getattr(total, k) + v)
        total.failures = sorted(total.failures, key=lambda f: str(f["first"]))[:NAMED_FAILURES]
        transport(self.options).finished({"outcome": outcome} | asdict(total))

    def commit(self, messages: list) -> None:
        self._finish("committed", messages)

    def abort(self, messages: list) -> None:
        self._finish("aborted", messages)


class UpsertSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "upsert"

    def writer(self, schema, overwrite: bool) -> UpsertWriter:
        if overwrite:
            raise ValueError("an upsert replaces rows by key; use mode append")
        return UpsertWriter(self.options, list(schema.names))
