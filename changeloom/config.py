"""Settings of the pipeline. A bad choice raises when the object is made."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

LSN_GAP_CHOICES = ("raise_exception", "begin_new_snapshot", "ignore")
START_CHOICES = ("latest", "earliest")
CAPTURE_STRATEGIES = ("create_date", "regex")
NEW_INSTANCE_SNAPSHOT = ("begin_new", "ignore")
NEW_INSTANCE_OVERLAP = ("skip", "republish")


@dataclass(frozen=True)
class CdcConfig:
    table_include: str | None = None
    table_exclude: str | None = None
    snapshot_include: str | None = None
    snapshot_exclude: str | None = None
    topic_template: str = "{schema_name}_{table_name}_cdc"
    capture_strategy: str = "create_date"
    capture_regex: str | None = None
    progress_topic: str = "_cdc_progress"
    snapshot_log_topic: str | None = None
    disable_tombstones: bool = False
    lsn_gap_handling: str = "raise_exception"
    new_follow_start_point: str = "latest"
    unified_topics: dict[str, str] = field(default_factory=dict)  # topic name -> regex of qualified table names
    new_instance_snapshot: str = "begin_new"
    new_instance_overlap: str = "skip"
    partition_count: int | None = None
    replication_factor: int | None = None
    extra_topic_config: dict[str, str] = field(default_factory=dict)
    truncate_fields: dict[str, int] = field(default_factory=dict)  # schema.table.column -> bytes
    terminate_on_instance_change: bool = False
    report_only: bool = False
    run_validations: bool = False
    batch_rows: int = 2000
    always_use_longs: bool = False
    metrics_namespace: str = ""
    serializer: str = "json"  # short name or dotted path of a codec
    reporters: tuple[str, ...] = ()  # of metrics
    snapshot_rows: int | None = None  # of a table in one micro-batch; batch_rows, if none are set
    max_lsns: int = 0  # log positions in one micro-batch, 0 for all there are
    original_topic_header: str = "original_topic"
    message_type_header: str = "message_type"

    def __post_init__(self) -> None:
        for name, value, allowed in (
            ("lsn_gap_handling", self.lsn_gap_handling, LSN_GAP_CHOICES), ("new_follow_start_point", self.new_follow_start_point, START_CHOICES), ("capture_strategy", self.capture_strategy, CAPTURE_STRATEGIES),
            ("new_instance_snapshot", self.new_instance_snapshot, NEW_INSTANCE_SNAPSHOT), ("new_instance_overlap", self.new_instance_overlap, NEW_INSTANCE_OVERLAP),
        ):
            if value not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, not {value!r}")
        for pattern in (self.table_include, self.table_exclude, self.snapshot_include, self.snapshot_exclude, self.capture_regex, *self.unified_topics.values()):
            if pattern is not None:
                re.compile(pattern)
        if self.capture_strategy == "regex" and not self.capture_regex:
            raise ValueError("the regex strategy needs capture_regex with one group")
        if self.batch_rows < 1 or (self.snapshot_rows is not None and self.snapshot_rows < 1):
            raise ValueError("batch_rows and snapshot_rows must be positive")
        if self.max_lsns < 0:
            raise ValueError("max_lsns must not be negative")
        self.topic_template.format(schema_name="s", table_name="t", capture_instance_name="c")

    def follows(self, qualified_name: str) -> bool:
        """Whether the filters let a table in; patterns match from the start, whatever the case."""
        return _allowed(qualified_name, self.table_include, self.table_exclude, True)

    def snapshots(self, qualified_name: str) -> bool:
        """Whether a table gets a snapshot; without an include pattern none does."""
        return _allowed(qualified_name, self.snapshot_include, self.snapshot_exclude, False)

    def combined(self, qualified_name: str) -> list[str]:
        return [topic for topic, pattern in self.unified_topics.items() if re.match(pattern, qualified_name, re.IGNORECASE)]

    def topic_options(self, partitions: int, brokers: int, progress: bool = False, log: bool = False) -> dict[str, str]:
        """Settings of a topic to be created: compacted by default; the progress topic in one partition of small segments, the snapshot log kept for a year."""
        out = {"partitions": str(1 if progress or log else self.partition_count or partitions), "replication_factor": str(self.replication_factor or min(brokers, 3))}
        if log:
            out |= {"cleanup.policy": "delete", "retention.ms": str(365 * 24 * 3600 * 1000)}
        else:
            out |= {"cleanup.policy": "compact"} | ({"segment.bytes": str(16 << 20)} if progress else {})
        return out | ({} if progress or log else self.extra_topic_config)


def _allowed(name: str, include: str | None, exclude: str | None, default: bool) -> bool:
    allowed = default if include is None else re.match(include, name, re.IGNORECASE) is not None
    return allowed and not (exclude is not None and re.match(exclude, name, re.IGNORECASE))
