"""A log of commits: numbered small files, each made whole and by one writer only.

A table or set of tables is written into a folder of its own, which nothing refers to
until an entry of the log names it. The entry with the largest number is the state; a
writer that lost the race for a number sees that, looks at what the others did and
tries again. So a writer that fails leaves the state as it was.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession

from . import storage

_NAME = re.compile(r"(\d{10})\.json")


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def numbers(self) -> list[int]:
        """Numbers of the kept entries, ascending."""
        return sorted(int(m[1]) for n in storage.children(self.spark, self.path) if (m := _NAME.fullmatch(n)))

    def entry(self, number: int) -> dict:
        return json.loads(storage.read_text(self.spark, self._file(number)))

    def latest(self) -> tuple[int, dict] | None:
        """Number and content of the newest entry; None before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.entry(numbers[-1])) if numbers else None

    def commit(self, number: int, entry: dict) -> bool:
        """Publish ``entry`` as ``number``; False if another writer has it already."""
        return storage.publish(self.spark, self._file(number), json.dumps(entry))

    def drop(self, number: int) -> None:
        storage.remove(self.spark, self._file(number))

    def _file(self, number: int) -> str:
        return f"{self.path}/{number:010d}.json"
