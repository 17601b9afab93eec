"""Which batches of a stream's output count: a ledger of small files, each published by one rename.

A batch writes its tables into folders of its own (`batch_id=<n>`), then publishes its entry. Readers take the newest
entry and the folders that it names or that are not newer, so they see a batch whole or not at all. A batch that is
repeated after its entry stands does nothing; one that is repeated before writes its folders anew. Entries but the last
two are removed, and with them the folders only they name.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from beaconlake.session import delete_path, file_system, scratch_scope

KEPT = 2
_FOLDER = "_ledger"


class Ledger:
    """The ledger of one output folder, in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._folder = f"{path}/{_FOLDER}"

    def _numbers(self) -> list[int]:
        fs, folder = file_system(self.spark, self._folder)
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def _read(self, number: int) -> dict[str, Any]:
        fs, file = file_system(self.spark, f"{self._folder}/{number}.json")
        stream = fs.open(file)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> dict[str, Any] | None:
        """The newest entry, with its `batch_id`."""
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else None

    def publish(self, batch_id: int, entry: dict[str, Any]) -> None:
        draft = f"{self._folder}/.draft-{uuid.uuid4().hex}"
        fs, file = file_system(self.spark, draft)
        stream = fs.create(file, True)
        stream.write(json.dumps({**entry, "batch_id": batch_id}).encode())
        stream.close()
        _, final = file_system(self.spark, f"{self._folder}/{batch_id}.json")
        if not fs.rename(file, final):
            raise OSError(f"could not publish batch {batch_id} in {self._folder}")
        self._forget()

    def _forget(self) -> None:
        """Remove old entries, and the folders they name that no kept entry does."""
        numbers = self._numbers()
        kept = {f for n in numbers[-KEPT:] for f in self._read(n).get("folders", [])}
        for number in numbers[:-KEPT]:
            for folder in self._read(number).get("folders", []):
                if folder not in kept:
                    delete_path(self.spark, f"{self.path}/{folder}")
            delete_path(self.spark, f"{self._folder}/{number}.json")


def published(spark: SparkSession, path: str, name: str, work: Callable[[DataFrame, int, dict | None], dict]) -> Callable[[DataFrame, int], None]:
    """A batch function that runs `work(batch, batch_id, last entry)` and publishes the entry it returns.

    What `work` stages belongs to the batch and is removed with its end; a batch begun anew removes what a lost one left.
    """
    ledger = Ledger(spark, path)

    def run(batch: DataFrame, batch_id: int) -> None:
        last = ledger.latest()
        if last is not None and last["batch_id"] >= batch_id:
            return
        # The output's path tells streams of one name in different applications apart.
        with scratch_scope(spark, f"batch-{name}-{zlib.crc32(path.encode()):08x}"):
            entry = work(batch, batch_id, last)
        ledger.publish(batch_id, entry)

    return run
