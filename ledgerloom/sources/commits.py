"""A store's log: what readers see changes from one whole version to the next.

Tables are written to folders of their own, which nobody reads until an entry names them.  An entry is a small file with the next number, created
only if it isn't there, so of two writers one is told to try again; a file that isn't whole (its writer died) doesn't count.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from ledgerloom.plans.shared import create, names, read_small


def _numbers(spark: SparkSession, store: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in names(spark, f"{store}/log") if n.removesuffix(".json").isdigit())


def _read(spark: SparkSession, store: str, number: int) -> dict | None:
    body, _, digest = read_small(spark, f"{store}/log/{number:020d}.json").partition("\n")
    return json.loads(body) if digest == hashlib.sha256(body.encode()).hexdigest() else None


def newest(spark: SparkSession, store: str) -> dict | None:
    """The newest whole entry; None before the first."""
    for number in reversed(_numbers(spark, store)):
        if (entry := _read(spark, store, number)) is not None:
            return entry
    return None


def commit(spark: SparkSession, store: str, change: Callable[[dict | None], dict], tries: int = 20) -> dict:
    """Appends change(newest entry); where another writer was faster, again from its entry."""
    for _ in range(tries):
        number = max(_numbers(spark, store), default=0) + 1
        entry = change(newest(spark, store))
        body = json.dumps(entry, sort_keys=True)
        if create(spark, f"{store}/log/{number:020d}.json", body + "\n" + hashlib.sha256(body.encode()).hexdigest()):
            return entry
    raise RuntimeError(f"{tries} other writers of {store} were faster")
