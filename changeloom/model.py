"""Data model: the change index, operations, tables and fields, and the change envelope.

A change index is a struct of (lsn, command_id, seqval, operation). Spark compares structs field by field and binaries
as unsigned bytes, so `<`, `ORDER BY` and `max(struct)` give the log order without a type of its own. Log positions are
binary(10) or fixed-width lower-case hex text behind `0x`; both sort alike.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Operation ids of a change log, and their names.
SNAPSHOT, DELETE, INSERT, PRE_UPDATE, POST_UPDATE = 0, 1, 2, 3, 4
OPERATION_NAMES = {SNAPSHOT: "Snapshot", DELETE: "Delete", INSERT: "Insert", PRE_UPDATE: "PreUpdate", POST_UPDATE: "PostUpdate"}
PUBLISHED_OPERATIONS = (DELETE, INSERT, POST_UPDATE)

# Message types and envelope field names.
TABLE_CHANGE, UNIFIED_CHANGE, TABLE_SNAPSHOT, DELETION_TOMBSTONE = "table-change", "unified-change", "table-snapshot", "deletion-tombstone"
ENVELOPE_FIELDS = ("__operation", "__event_time", "__log_lsn", "__command_id", "__log_seqval", "__updated_fields")
CHANGE_ROWS, SNAPSHOT_ROWS = "change_rows", "snapshot_rows"
SNAPSHOT_ACTIONS = ("started", "resumed", "completed", "reset-auto", "reset-manual")

LSN_BYTES = 10
INDEX_COLUMNS = ("lsn", "command_id", "seqval", "operation")
LOWEST_TEXT, HIGHEST_TEXT = "0x" + "00" * LSN_BYTES, "0x" + "ff" * LSN_BYTES
MAX_COMMAND_ID = 2**31 - 1

CHANGE_INDEX = T.StructType([T.StructField("lsn", T.BinaryType()), T.StructField("command_id", T.IntegerType()), T.StructField("seqval", T.BinaryType()), T.StructField("operation", T.IntegerType())])


@dataclass(frozen=True, order=True)
class ChangeIndex:
    lsn: bytes
    command_id: int
    seqval: bytes
    operation: int

    @classmethod
    def of(cls, lsn: str, command_id: int, seqval: str, operation: int) -> ChangeIndex:
        return cls(bytes.fromhex(lsn[2:]), command_id, bytes.fromhex(seqval[2:]), operation)

    def text(self) -> tuple[str, int, str, int]:
        return "0x" + self.lsn.hex(), self.command_id, "0x" + self.seqval.hex(), self.operation

    @property
    def probably_heartbeat(self) -> bool:
        """Recorded without a change: everything up to the log position has been seen. The command id doesn't matter."""
        return self.seqval == HIGHEST.seqval and self.operation == HIGHEST.operation


LOWEST = ChangeIndex(b"\x00" * LSN_BYTES, 1, b"\x00" * LSN_BYTES, 0)
HIGHEST = ChangeIndex(b"\xff" * LSN_BYTES, MAX_COMMAND_ID, b"\xff" * LSN_BYTES, POST_UPDATE)

# ------------------------------------------------------------------ column types


class UnsupportedSqlType(ValueError):
    """A column type that has no counterpart here."""


_PLAIN: dict[str, T.DataType] = {
    "bigint": T.LongType(), "int": T.IntegerType(), "smallint": T.ShortType(), "tinyint": T.ShortType(), "bit": T.BooleanType(), "float": T.DoubleType(), "real": T.FloatType(),
    "date": T.DateType(), "time": T.IntegerType(), "datetime": T.TimestampNTZType(), "datetime2": T.TimestampNTZType(), "smalldatetime": T.TimestampNTZType(), "datetimeoffset": T.StringType(),
    **{t: T.StringType() for t in ("char", "nchar", "varchar", "nvarchar", "text", "ntext", "xml", "uniqueidentifier")},
    **{t: T.BinaryType() for t in ("binary", "varbinary", "image", "rowversion")},
}
DECIMAL_TYPES = ("decimal", "numeric", "money", "smallmoney")
STRING_TYPES = ("char", "nchar", "varchar", "nvarchar", "text", "ntext")


def spark_type(sql_type: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    kind = sql_type.lower()
    if kind in DECIMAL_TYPES:
        if precision is None or scale is None:
            raise UnsupportedSqlType(f"{sql_type} needs a precision and a scale")
        return T.DecimalType(precision, scale)
    if kind not in _PLAIN:
        raise UnsupportedSqlType(sql_type)
    return _PLAIN[kind]


# ------------------------------------------------------------------ tables


@dataclass(frozen=True)
class FieldSpec:
    name: str
    sql_type: str
    ordinal: int  # in the change table, from 1
    key_ordinal: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True
    truncate_after: int | None = None  # bytes of UTF-8

    def __post_init__(self) -> None:
        if self.truncate_after is not None and self.sql_type.lower() not in STRING_TYPES:
            raise ValueError(f"only text can be truncated, not {self.name} ({self.sql_type})")

    @property
    def spark(self) -> T.StructField:
        return T.StructField(self.name, spark_type(self.sql_type, self.precision, self.scale), self.nullable)


@dataclass(frozen=True)
class TableSpec:
    schema_name: str
    table_name: str
    capture_instance: str
    fields: tuple[FieldSpec, ...]
    topic: str = ""
    min_lsn: bytes = LOWEST.lsn
    snapshot_allowed: bool = False
    extra: dict[str, str] = field(default_factory=dict, hash=False, compare=False)

    @property
    def value_fields(self) -> tuple[FieldSpec, ...]:
        return tuple(sorted(self.fields, key=lambda f: f.ordinal))

    @property
    def value_names(self) -> list[str]:
        return [f.name for f in self.value_fields]

    @property
    def key_names(self) -> list[str]:
        keyed = [f for f in self.fields if f.key_ordinal is not None]
        return [f.name for f in sorted(keyed, key=lambda f: f.key_ordinal)]

    @property
    def has_key(self) -> bool:
        return bool(self.key_names)

    @property
    def qualified_name(self) -> str:
        return f"{self.schema_name}.{self.table_name}"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([f.spark for f in self.value_fields])


def envelope_schema(table: TableSpec) -> T.StructType:
    """One row is one message, before it is encoded; a null value is a tombstone."""
    keys = set(table.key_names)
    return T.StructType(
        [
            T.StructField("topic", T.StringType(), False), T.StructField("message_type", T.StringType(), False), T.StructField("operation", T.IntegerType()),
            T.StructField("event_time", T.TimestampNTZType()), T.StructField("idx", CHANGE_INDEX), T.StructField("updated_fields", T.ArrayType(T.StringType())),
            T.StructField("key", T.StructType([f.spark for f in table.value_fields if f.name in keys])), T.StructField("value", table.schema), T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        ]
    )
