"""Finished steps of long jobs, so that no step is done twice, also not by the next driver after a lost one."""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession


def _canonical(key: Any) -> str:
    return json.dumps(key, sort_keys=True)


class Ledger:
    """Small JSON values of finished steps by key.

    With a ``root`` every value is a file of its own in that folder, which appears whole or not at all, and a new ledger
    on the same folder knows all of them. A folder belongs to one set of data: keys name steps and settings, not rows.
    Without a root the values live as long as the ledger. Threads may share a ledger.
    """

    def __init__(self, spark: SparkSession | None = None, root: str | None = None):
        self.spark, self.root, self.lock = spark, root, threading.Lock()
        self.known: dict[str, Any] = {}
        if root is not None:
            self.folder = spark._jvm.org.apache.hadoop.fs.Path(root)
            self.system = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())
            self.system.mkdirs(self.folder)
            if any(s.getPath().getName().endswith(".json") for s in self.system.listStatus(self.folder)):
                entries = spark.read.option("pathGlobFilter", "*.json").text(root, wholetext=True).collect()
                for entry in map(json.loads, (e["value"] for e in entries)):
                    self.known[_canonical(entry["key"])] = entry["value"]

    def __len__(self) -> int:
        return len(self.known)

    def get(self, key: Any) -> Any | None:
        return self.known.get(_canonical(key))

    def put(self, key: Any, value: Any) -> None:
        """Record a value; with a root it is on disk when this returns."""
        name = _canonical(key)
        if self.root is not None:
            path = self.spark._jvm.org.apache.hadoop.fs.Path
            stem = f"{self.root}/{hashlib.sha256(name.encode()).hexdigest()[:32]}"
            part = path(f"{stem}.{uuid.uuid4().hex}.part")
            out = self.system.create(part)
            try:
                out.write(bytearray(json.dumps({"key": key, "value": value}).encode()))
            finally:
                out.close()
            if not self.system.rename(part, path(f"{stem}.json")):
                self.system.delete(part, False)  # another driver recorded the same step before
        with self.lock:
            self.known[name] = value

    def once(self, key: Any, make: Callable[[], Any]) -> Any:
        """The recorded value, or what ``make`` returns, recorded."""
        found = self.get(key)
        if found is None:
            found = make()
            self.put(key, found)
        return found
