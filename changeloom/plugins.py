"""Plugins named by a dotted path in the settings: codecs of messages and reporters of metrics."""

from __future__ import annotations

import importlib
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions import avro
from changeloom.functions import expr as X
from changeloom.model import TableSpec


class Codec(Protocol):
    """Puts envelope rows into bytes and back. A tombstone's value is null."""

    def encode(self, envelope: DataFrame, table: TableSpec) -> DataFrame:
        """The columns of `envelope` but key, value and updated_fields, with key and value as binary."""

    def decode(self, messages: DataFrame, table: TableSpec, keep: list[str] | None = None) -> DataFrame:
        """The columns `keep` of messages and those of their value record; a row without a value has its key's columns."""


def _meta(position: str = "idx") -> list[Column]:
    at = {"__log_lsn": "lsn", "__command_id": "command_id", "__log_seqval": "seqval"}
    return [
        X.operation_name(F.col("operation")).alias("__operation"), X.iso_time(F.col("event_time")).alias("__event_time"),
        *[F.when(F.col("operation") != 0, F.col(f"{position}.{c}")).alias(n) for n, c in at.items()], F.col("updated_fields").alias("__updated_fields"),
    ]


class JsonCodec:
    """JSON objects, made in the JVM."""

    def encode(self, envelope: DataFrame, table: TableSpec) -> DataFrame:
        record = F.to_json(F.struct(*_meta(), *[F.col(f"value.{n}").alias(n) for n in table.value_names]))
        rest = [c for c in envelope.columns if c not in ("key", "value", "updated_fields")]
        return envelope.select(*rest, F.to_json("key").cast("binary").alias("key"), F.when(F.col("value").isNotNull(), record).cast("binary").alias("value"))

    def decode(self, messages: DataFrame, table: TableSpec, keep: list[str] | None = None) -> DataFrame:
        head = "__operation string, __event_time string, __log_lsn string, __command_id int, __log_seqval string, __updated_fields array<string>"
        fields = {f.name: f"`{f.name}` {f.spark.dataType.simpleString()}" for f in table.value_fields}
        keyed = set(table.key_names)
        parsed = messages.select(*(keep or []), F.from_json(F.col("value").cast("string"), f"{head}, {', '.join(fields.values())}").alias("_v"), *([F.from_json(F.col("key").cast("string"), ", ".join(fields[k] for k in table.key_names)).alias("_k")] if keyed else []))
        own = [(F.coalesce(F.col(f"_v.{n}"), F.col(f"_k.{n}")) if n in keyed else F.col(f"_v.{n}")).alias(n) for n in fields]
        return parsed.select(*(keep or []), *[F.col(f"_v.{x.split()[0]}") for x in head.split(", ")], *own)


class AvroCodec:
    """Framed Avro records; schema ids come from whoever registers the schemas."""

    def __init__(self, key_id: int = 1, value_id: int = 2):
        self.key_id, self.value_id = key_id, value_id

    def encode(self, envelope: DataFrame, table: TableSpec) -> DataFrame:
        rest = [c for c in envelope.columns if c not in ("key", "value", "updated_fields")]
        return avro.encode(envelope, table, self.key_id, self.value_id, keep=rest)

    def decode(self, messages: DataFrame, table: TableSpec, keep: list[str] | None = None) -> DataFrame:
        return avro.decode(messages, table, keep)


_SHORT = {
    "json": "changeloom.plugins.JsonCodec",
    "avro": "changeloom.plugins.AvroCodec",
    "stdout": "changeloom.streaming.reporters.StdoutReporter",
    "file": "changeloom.streaming.reporters.FileReporter",
    "http": "changeloom.streaming.reporters.HttpReporter",
}


def load(path: str, **options: Any) -> Any:
    """An instance of the class that a short name, or `package.module.Class`, stands for."""
    module, _, name = _SHORT.get(path, path).rpartition(".")
    if not module:
        raise ValueError(f"{path!r} is neither one of {sorted(_SHORT)} nor a dotted path")
    return getattr(importlib.import_module(module), name)(**options)
