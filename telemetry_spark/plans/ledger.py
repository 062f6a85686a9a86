"""The ledger of a run: which stages finished, what each read and which tables it left.

A stage is named with the fingerprint of what it reads -- the files of a source, the folders of
stored tables (every refresh has a folder of its own), the model, the options.  A run that is
resumed takes over a stage's metrics if the fingerprint is still the same and the tables it left are
still the current ones, and so starts at the first stage whose input changed or that did not end.
One small file a run, written after each stage.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame

from telemetry_spark.sources import files
from telemetry_spark.sources.store import Lake

Tables = tuple[tuple[str, str], ...]


def fingerprint(*reads) -> str:
    return hashlib.sha256("\n".join(map(str, reads)).encode()).hexdigest()


def source_state(lake: Lake, source: str | DataFrame) -> str:
    """A path's files, or a frame's plan and the names of its files (not their content: a frame over
    a file that is replaced under its own name counts as unchanged)."""
    if isinstance(source, DataFrame):
        return f"frame:{source.semanticHash()}:{files.names_hash(source)}"
    return files.identity(lake.spark, source)


class Ledger:
    def __init__(self, lake: Lake, run_id: str, resume: bool = False):
        self.lake, self.resume = lake, resume
        self.path = f"{lake.root}/_runs/{quote(run_id, safe='')}.json"
        text = files.read_text(lake.spark, self.path)
        self.stages: dict[str, dict] = json.loads(text) if text else {}
        self.reused: list[str] = []

    def folders(self, tables: Tables) -> list[str]:
        return [self.lake.location(*t) if self.lake.has(*t) else "" for t in tables]

    def stage(self, name: str, reads: str, tables: Tables, work: Callable[[], dict]) -> dict:
        """The metrics of a stage, from this run of it or, if resumed and unchanged, from the last."""
        last = self.stages.get(name)
        if self.resume and last and last["reads"] == reads and last["left"] == self.folders(tables):
            self.reused.append(name)
            return last["metrics"]
        metrics = work()
        self.stages[name] = {"reads": reads, "left": self.folders(tables), "metrics": metrics}
        files.write_text(self.lake.spark, self.path, json.dumps(self.stages, default=str))
        return metrics
