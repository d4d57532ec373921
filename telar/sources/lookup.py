"""Point lookups by key, and hints in nested payloads."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .discovery import WANTED


def lookup(keys: DataFrame, key: str, fetch: Callable[[int], dict | None], schema: str, tries: int = 3, pause: float = 0.0) -> DataFrame:
    """One payload a key: key, payload (parsed by schema; null if there is none) and error (the last one, if all tries failed).

    ``fetch`` runs on the executors; failures stay rows, so a failed key is simply pending again.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for k in f[key]:
                payload = error = None
                for attempt in range(tries):
                    try:
                        got = fetch(int(k))
                        payload, error = None if got is None else json.dumps(got), None
                        break
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                        time.sleep(pause * 2**attempt)
                out.append((k, payload, error))
            yield pd.DataFrame(out, columns=[key, "payload", "error"])

    rows = keys.select(F.col(key).cast("long").alias(key)).mapInPandas(run, f"{key} long, payload string, error string")
    return rows.withColumn("payload", F.from_json("payload", schema))


def json_hints(payload: Column, words: Sequence[str] = WANTED, most: int = 15, each: int = 20) -> Column:
    """Strings of a JSON document that are URLs or hold a word, as ``path=value``; of a list its first 20 elements. Nesting has no bound, hence a pandas UDF."""

    @F.pandas_udf("array<string>")
    def hints(s: pd.Series) -> pd.Series:
        def walk(x, path=""):
            if isinstance(x, dict):
                for k, v in x.items():
                    yield from walk(v, f"{path}.{k}")
            elif isinstance(x, list):
                for i, v in enumerate(x[:each]):
                    yield from walk(v, f"{path}[{i}]")
            elif isinstance(x, str) and (x.startswith("http") or any(w in x.lower() for w in words)):
                yield f"{path}={x[:250]}"

        def one(t):
            try:
                return list(walk(json.loads(t)))[:most] if t else []
            except ValueError:
                return []

        return s.map(one)

    return hints(payload)
