"""Column expressions over change logs. All run in the JVM, without Python on the executors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeloom.model import HIGHEST_TEXT, INDEX_COLUMNS, OPERATION_NAMES, POST_UPDATE, PUBLISHED_OPERATIONS, ChangeIndex

# ------------------------------------------------------------------ log positions


def lsn_text(value: Column) -> Column:
    """binary -> `0x` and lower-case hex."""
    return F.concat(F.lit("0x"), F.lower(F.hex(value)))


def lsn_bytes(text: Column) -> Column:
    return F.unhex(F.substr(text, F.lit(3)))


def increment_lsn(text: Column) -> Column:
    """The next log position, with the carry over all ten bytes; the highest one stays."""
    high = F.conv(F.substr(text, F.lit(3), F.lit(10)), 16, 10).cast("long")
    low = F.conv(F.substr(text, F.lit(13), F.lit(10)), 16, 10).cast("long")
    full = F.lit(2**40 - 1)
    next_low = F.when(low == full, 0).otherwise(low + 1)
    next_high = F.when(low == full, high + 1).otherwise(high)
    hexed = F.lower(F.concat(F.lpad(F.hex(next_high), 10, "0"), F.lpad(F.hex(next_low), 10, "0")))
    return F.when(text == HIGHEST_TEXT, text).otherwise(F.concat(F.lit("0x"), hexed))


def index(prefix: str = "") -> Column:
    """The change index of a row as a struct that sorts in log order."""
    return F.struct(*[F.col(prefix + c).alias(c) for c in INDEX_COLUMNS])


def index_literal(at: ChangeIndex, binary: bool = False) -> Column:
    lsn, command_id, seqval, operation = at.text()
    position = (lambda t: F.unhex(F.lit(t[2:]))) if binary else F.lit
    return F.struct(position(lsn).alias("lsn"), F.lit(command_id).alias("command_id"), position(seqval).alias("seqval"), F.lit(operation).alias("operation"))


def after_index(at: ChangeIndex, with_operation: bool = True, binary: bool = False) -> Column:
    """Rows after a change index. The bound on lsn alone is implied, but only it reaches the scan."""
    names = INDEX_COLUMNS if with_operation else INDEX_COLUMNS[:3]
    start = index_literal(at, binary)
    left = F.struct(*[F.col(c).alias(c) for c in names])
    right = F.struct(*[start[c].alias(c) for c in names])
    return (F.col("lsn") >= start["lsn"]) & (left > right)


def upto_index(at: ChangeIndex, binary: bool = False) -> Column:
    end = index_literal(at, binary)
    return (F.col("lsn") <= end["lsn"]) & (index() <= end)


def index_display(prefix: str = "") -> Column:
    """`0xAAAAAAAA BBBBBBBB CCCC:command:0xAAAAAAAA BBBBBBBB CCCC:operation`"""

    def spaced(c: Column) -> Column:
        return F.concat(F.substr(c, F.lit(1), F.lit(10)), F.lit(" "), F.substr(c, F.lit(11), F.lit(8)), F.lit(" "), F.substr(c, F.lit(19)))

    return F.concat(spaced(F.col(prefix + "lsn")), F.lit(":"), F.col(prefix + "command_id").cast("string"), F.lit(":"), spaced(F.col(prefix + "seqval")), F.lit(":"), F.col(prefix + "operation").cast("string"))


def is_heartbeat(prefix: str = "") -> Column:
    return (F.col(prefix + "seqval") == HIGHEST_TEXT) & (F.col(prefix + "operation") == POST_UPDATE)


def is_published(operation: Column) -> Column:
    """Deletes, inserts and updates after the fact; images before an update are not published."""
    return operation.isin(*PUBLISHED_OPERATIONS)


def operation_name(operation: Column) -> Column:
    names = F.create_map(*[x for k, v in OPERATION_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return names[operation]


def operation_id(name: Column) -> Column:
    ids = F.create_map(*[x for k, v in OPERATION_NAMES.items() for x in (F.lit(v), F.lit(k))])
    return ids[name]


# ------------------------------------------------------------------ keys


def key_struct(names: list[str]) -> Column:
    return F.struct(*[F.col(c).alias(c) for c in names])


def key_compare(names: list[str], sign: str, bound: list) -> Column:
    """A comparison of a composite key with literals, spelled out as an OR of ANDs, which sources can evaluate by themselves.

    `<` and `>` are strict; `<=` and `>=` allow equality on the last column only, which makes them the closed bounds.
    """
    strict = {"<": Column.__lt__, "<=": Column.__lt__, ">": Column.__gt__, ">=": Column.__gt__}[sign]
    last = {"<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}[sign]
    arms = []
    for i, name in enumerate(names):
        equal = [F.col(names[j]) == F.lit(bound[j]) for j in range(i)]
        arms.append(reduce(lambda a, b: a & b, [*equal, (last if i == len(names) - 1 else strict)(F.col(name), F.lit(bound[i]))]))
    return reduce(lambda a, b: a | b, arms)


def casefolded(key: Column) -> Column:
    """Keys that differ by case alone become equal, the sharp s and ss too; both small sigmas are one, and so are i with and without a dot."""
    # The translation between keeps the optimizer from taking lower(upper(x)) for lower(x), and makes both sigmas one.
    return F.lower(F.translate(F.upper(key), "\u03a3", "\u03c3"))


def uuid_sort_key(uuid: Column) -> Column:
    """Text that sorts as the database sorts identifiers: bytes 10 to 15, 8 and 9, then 7 down to 0 of the text form."""
    flat = F.upper(F.regexp_replace(uuid, "-", ""))
    order = [10, 11, 12, 13, 14, 15, 8, 9, 7, 6, 5, 4, 3, 2, 1, 0]
    return F.concat(*[F.substr(flat, F.lit(2 * i + 1), F.lit(2)) for i in order])


def row_hash_uuid(names: list[str], table_name: str) -> Column:
    """A version-5 identifier from a row's names and values, for tables without a key: a function of the row's content."""
    parts = [x for n in names for x in (F.lit(n), F.coalesce(F.col(n).cast("string"), F.lit("\x00")))]
    digest = F.sha1(F.concat(F.unhex(F.md5(F.concat_ws("\x1f", *parts))), F.lit(table_name).cast("binary")))
    nibble = F.conv(F.substr(digest, F.lit(17), F.lit(1)), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)
    flat = F.concat(F.substr(digest, F.lit(1), F.lit(12)), F.lit("5"), F.substr(digest, F.lit(14), F.lit(3)), F.lower(F.hex(nibble)), F.substr(digest, F.lit(18), F.lit(15)))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substr(flat, F.lit(a), F.lit(n)) for a, n in cuts])


# ------------------------------------------------------------------ envelope


def updated_fields(mask: Column, names: list[str]) -> Column:
    """Names of the columns whose bit is set in a big-endian mask; the last byte's lowest bit is the first column."""
    size = F.octet_length(mask)
    listed = F.array(*[F.lit(n) for n in names])

    def on(i: Column) -> Column:
        byte = F.conv(F.hex(F.substring(mask, size - F.floor((i - 1) / 8).cast("int"), 1)), 16, 10).cast("int")
        return (i <= size * 8) & (F.getbit(byte, (i - 1) % 8) == 1)

    return F.transform(F.filter(F.sequence(F.lit(1), F.lit(len(names))), on), lambda i: F.element_at(listed, i))


def int_mask(mask: Column) -> Column:
    """A small mask kept as a number, as the four bytes it stands for."""
    return F.unhex(F.lpad(F.hex(mask.cast("long")), 8, "0"))


def truncate_utf8(text: Column, limit: int) -> Column:
    """At most `limit` bytes of UTF-8, never cutting a character."""
    raw = text.cast("binary")

    def continues(at: int) -> Column:
        """Whether the byte after the first `at` ones belongs to a character begun before."""
        return F.conv(F.hex(F.substring(raw, at + 1, 1)), 16, 10).cast("int").between(0x80, 0xBF)

    cut = reduce(lambda rest, back: F.when(~continues(limit - back), limit - back).otherwise(rest) if limit - back > 0 else F.lit(0), range(min(3, limit), -1, -1), F.lit(0))
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.substring(raw, F.lit(1), cut).cast("string"))


def truncation_header(text: Column, limit: int) -> Column:
    """`original,new` byte lengths where a text was cut, else null."""
    return F.when(F.octet_length(text) > limit, F.concat(F.octet_length(text).cast("string"), F.lit(","), F.octet_length(truncate_utf8(text, limit)).cast("string")))


def iso_time(at: Column) -> Column:
    """ISO 8601; six digits of a second's fraction, or none where it is zero."""
    whole = F.date_trunc("second", at) == at
    return F.when(whole, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def from_iso_time(text: Column) -> Column:
    return F.to_timestamp_ntz(text)


def db_time_to_utc(at: Column, skew_microseconds: int) -> Column:
    """A database clock's time in UTC, by a measured skew."""
    return F.timestamp_add("MICROSECOND", F.lit(skew_microseconds), at)


def local_to_utc(at: Column, zone: str, buffer_seconds: int = 0) -> Column:
    """A time of a named zone, as a time without one, in UTC; less a buffer where clocks may differ."""
    return F.timestamp_add("SECOND", F.lit(-buffer_seconds), F.convert_timezone(F.lit(zone), F.lit("UTC"), at.cast("timestamp_ntz")))


def coordinates(topic: str = "topic", partition: str = "partition_id", offset: str = "msg_offset") -> Column:
    return F.concat(F.col(topic), F.lit(":"), F.col(partition).cast("string"), F.lit("@"), F.col(offset).cast("string"))


# ------------------------------------------------------------------ names


def quoted_name(name: Column) -> Column:
    """Each part of a dotted name in brackets; brackets that are there already stay single."""
    return F.concat(F.lit("["), F.regexp_replace(F.regexp_replace(name, r"[\[\]]", ""), r"\.", "].["), F.lit("]"))


def change_table_name(capture_instance: Column) -> Column:
    return F.concat(F.lit("cdc."), capture_instance, F.lit("_CT"))


def capture_instance_of(change_table: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(change_table, r"[\[\]]", ""), r"^cdc\.(.*)_CT$", 1)


def topic_name(template: str, schema_name: Column, table_name: Column, capture_instance: Column | None = None) -> Column:
    out: list[Column] = []
    rest = template
    slots = {"{schema_name}": schema_name, "{table_name}": table_name, "{capture_instance_name}": capture_instance}
    while rest:
        at, slot = min(((rest.find(s), s) for s in slots if s in rest), default=(len(rest), ""))
        if at:
            out.append(F.lit(rest[:at]))
        if slot:
            if slots[slot] is None:
                raise ValueError(f"the template needs {slot}")
            out.append(slots[slot])
        rest = rest[at + len(slot) :]
    return F.concat(*out) if out else F.lit("")


def matches_start(name: Column, pattern: str) -> Column:
    """A case-insensitive pattern that must match from the start, not to the end."""
    return name.rlike(f"(?i)^(?:{pattern})")


_NAME = r'(?:\[(?:[^\]]|\]\])*\]|"(?:[^"]|"")*"|[\w@#$]+)'
#: Words that begin an item of ADD which is no column.
_NO_COLUMN = ("constraint", "primary", "unique", "foreign", "check", "default", "index", "period")


def added_columns(ddl: Column) -> Column:
    """Lower-case names of the columns that an ALTER TABLE ... ADD statement adds; none for other statements.

    The list after ADD is cut at commas outside parentheses and literals; an item begins with a name, which may be in
    brackets or quotes, or with the keyword of a constraint or an index.
    """
    body = F.regexp_extract(ddl, rf"(?is)^\s*alter\s+table\s+{_NAME}(?:\s*\.\s*{_NAME})*\s+(?:with\s+(?:no)?check\s+)?add\s+(?:column\s+)?(.*)$", 1)
    body = F.regexp_replace(body, "'(?:[^']|'')*'", "0")
    for _ in range(4):  # parentheses within parentheses
        body = F.regexp_replace(body, r"\([^()]*\)", " ")
    items = F.regexp_extract_all(body, F.lit(rf"(?:^|,)\s*({_NAME})"), 1)
    bare = F.filter(items, lambda x: ~F.lower(x).isin(*_NO_COLUMN))
    unquoted = F.transform(bare, lambda x: F.when(x.startswith("["), F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit("]]"), F.lit("]"))).when(x.startswith('"'), F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
    return F.transform(unquoted, F.lower)


# ------------------------------------------------------------------ encodings of target and source

#: The characters of code page 1252 that Latin-1 has control characters in place of.
_CP1252 = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def encoded(text: Column, charset: str) -> Column:
    """Text as the bytes of a column of the target: `cp1252` for plain text types, `utf-16le` for national ones."""
    if charset.lower() != "cp1252":
        return F.encode(text, charset.upper())
    return F.encode(F.translate(text, "".join(_CP1252.values()), "".join(_CP1252)), "ISO-8859-1")


def decode_utf16(raw: Column) -> Column:
    """UTF-16LE text whose last character may have been cut: an odd byte or half a pair at the end is left out."""
    even = F.octet_length(raw) - F.octet_length(raw) % 2
    last = F.conv(F.hex(F.substr(raw, even, F.lit(1))), 16, 10).cast("int")
    whole = F.when((even >= 2) & last.between(0xD8, 0xDB), even - 2).otherwise(even)
    return F.decode(F.substr(raw, F.lit(1), whole), "UTF-16LE")


def datetimeoffset_text(raw: Column) -> Column:
    """The 20 bytes of a database's time with an offset (little-endian: year, month, day, hour, minute, second, nanoseconds, offset hours, offset minutes) as ISO text."""

    def number(at: int, size: int, signed: bool = False) -> Column:
        value = F.conv(F.concat(*[F.hex(F.substr(raw, F.lit(at + size - i), F.lit(1))) for i in range(size)]), 16, 10).cast("long")
        return F.when(value >= 1 << (8 * size - 1), value - (1 << (8 * size))).otherwise(value) if signed else value

    year, month, day, hour, minute, second = (number(2 * i, 2) for i in range(6))
    nanos, hours, minutes = number(12, 4), number(16, 2, True), number(18, 2, True)
    fraction = F.when(nanos > 0, F.format_string(".%07d", F.floor(nanos / 100).cast("long"))).otherwise("")
    sign = F.when((hours < 0) | (minutes < 0), "-").otherwise("+")
    return F.concat(F.format_string("%04d-%02d-%02dT%02d:%02d:%02d", year, month, day, hour, minute, second), fraction, sign, F.format_string("%02d:%02d", F.abs(hours), F.abs(minutes)))
