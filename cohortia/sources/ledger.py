"""What an ingest has decided, kept beside its table.

An entry names the files of one batch, what is done with each, and the state that
the next batch starts from.  It is created atomically under the next number before
any row is written, and marked once the rows are.  A batch that is delivered again,
or a run that follows one that broke off, does what the entry says, so the table
is the same however often and wherever a run ends.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from cohortia.sources import files


class Ledger:
    def __init__(self, spark: SparkSession, uri: str):
        self.spark, self.uri = spark, uri.rstrip("/")

    def numbers(self) -> list[int]:
        return sorted(int(n) for n in files.list_names(self.spark, self.uri) if n.isdigit())

    def entry(self, number: int) -> dict:
        return json.loads(files.read_text(self.spark, f"{self.uri}/{number}"))

    def newest(self) -> dict | None:
        numbers = self.numbers()
        return self.entry(numbers[-1]) if numbers else None

    def of_batch(self, stream: str, batch: int) -> int | None:
        """Number of the entry of a stream's batch; only a stream's newest batch is ever delivered again."""
        for number in reversed(self.numbers()):
            entry = self.entry(number)
            if entry["stream"] == stream:
                return number if entry["batch"] == batch else None
        return None

    def open_entries(self) -> list[int]:
        """Numbers of entries whose rows were not written to the end, oldest first."""
        names = set(files.list_names(self.spark, self.uri))
        return [n for n in self.numbers() if f"{n}.done" not in names]

    def add(self, after: int, entry: dict) -> bool:
        """Record an entry behind number ``after``; False if another run was faster."""
        return files.claim(self.spark, f"{self.uri}/{after + 1}", json.dumps(entry))

    def mark_done(self, number: int) -> None:
        files.claim(self.spark, f"{self.uri}/{number}.done", "")
