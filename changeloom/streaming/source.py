"""A streaming source that is the clock of the pipeline: its offset is a log position and a number of snapshot pages.

A micro-batch gets one row with the positions between which all its tables are read, so they share one ceiling and a
batch can be put in global order by itself; the tables are then read by Spark's own scans, as wide as they are. A batch
takes whole log positions, never a part of a transaction; `max_lsns` caps how many, and the rest follows in later batches.
The offset moves on even where no table has a row up to the ceiling. As long as there are snapshot pages to come, each
batch takes one more of every table.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from changeloom.model import LOWEST_TEXT

NAME = "changeloom_positions"
SCHEMA = "start_lsn string, end_lsn string, start_page long, end_page long"


class Span(InputPartition):
    def __init__(self, start: dict, end: dict):
        self.start, self.end = start, end


class PositionReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.map_path = options["lsn_map"]
        self.max_lsns, self.pages = int(options.get("max_lsns", "0")), int(options.get("pages", "0"))
        self.first = {"lsn": options.get("starting_lsn", LOWEST_TEXT), "page": int(options.get("starting_page", "0"))}
        self.given = self._resumed(options.get("checkpoint")) or self.first

    @staticmethod
    def _resumed(checkpoint: str | None) -> dict | None:
        """The last offset that a checkpoint has handed out: a restarted reader isn't told it."""
        if checkpoint is None:
            return None
        fs, at = pafs.FileSystem.from_uri(checkpoint)
        found = [f for f in fs.get_file_info(pafs.FileSelector(f"{at}/offsets", allow_not_found=True)) if f.base_name.isdigit()]
        if not found:
            return None
        with fs.open_input_stream(max(found, key=lambda f: int(f.base_name)).path) as f:
            return json.loads(f.read().decode().splitlines()[-1])

    def initialOffset(self) -> dict:
        return self.first

    def _positions(self, after: str) -> Iterator:
        """Distinct positions after one, a batch of the map at a time."""
        fs, at = pafs.FileSystem.from_uri(self.map_path)
        found = ds.dataset(at, filesystem=fs, format="parquet").scanner(columns=["start_lsn"], filter=ds.field("start_lsn") > after)
        return (batch.column(0) for batch in found.to_batches() if batch.num_rows)

    def _ceiling(self, after: str) -> str:
        """The highest position, or the last of the `max_lsns` next ones; holds no more than those."""
        if not self.max_lsns:
            return max((pc.max(x).as_py() for x in self._positions(after)), default=after)
        least: list[str] = []
        for x in self._positions(after):
            least = heapq.nsmallest(self.max_lsns, set(least).union(pc.unique(x).to_pylist()))
        return least[-1] if least else after

    def latestOffset(self) -> dict:
        """Read once for all tables."""
        self.given = {"lsn": self._ceiling(self.given["lsn"]), "page": max(self.given["page"], min(self.given["page"] + 1, self.pages))}
        return self.given

    def partitions(self, start: dict, end: dict) -> list[Span]:
        self.given = max(self.given, end, key=lambda x: (x["lsn"], x["page"]))
        return [Span(start, end)]

    def read(self, partition: Span) -> Iterator[tuple]:
        yield partition.start["lsn"], partition.end["lsn"], partition.start["page"], partition.end["page"]

    def commit(self, end: dict) -> None:
        """Nothing to do: change tables are kept by the database."""


class PositionSource(DataSource):
    """Options: lsn_map (a Parquet folder), checkpoint (so that a restart goes on from there), starting_lsn, starting_page, max_lsns (0: no cap), pages."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> PositionReader:
        return PositionReader(self.options)
