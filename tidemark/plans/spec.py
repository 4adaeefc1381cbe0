"""Declarative descriptions of a log reader and writer, checked when a plan is built."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import types as T

# Offsets that stand for a position.
END, BEGINNING, NO_SEEK = -1, -2, -3
LEAST_COMMIT_PERIOD = 0.1

TYPES = {
    "string": T.StringType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "blob": T.BinaryType(),
}
WRITABLE = (T.StringType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BinaryType, T.DecimalType)


class SpecError(ValueError):
    """A description that contradicts itself or its schema."""


class StartPosition(Enum):
    # Accepted spellings.
    BEGINNING = ("beginning", "begin", "first", "start")
    END = ("end", "last", "latest", "oldest")
    DEFAULT = ("default",)
    TIME = ("time", "timestamp")
    OFFSET = ("offset", "offs")

    @staticmethod
    def of(text: str | StartPosition) -> StartPosition:
        if isinstance(text, StartPosition):
            return text
        for p in StartPosition:
            if text.lower() in p.value:
                if text.lower() == "oldest":
                    warnings.warn("'oldest' means the end here", stacklevel=2)
                return p
        raise SpecError(f"unknown start position {text}")


class Region(Enum):
    NONE = "none"
    PERIODIC = "periodic"
    OPERATOR_DRIVEN = "operator driven"


class Commit(Enum):
    TIME = "time"
    COUNT = "count"
    DRAIN = "drain"


def listed(value) -> list[str]:
    """Topics as given, each parted at commas, without blanks and empty names."""
    values = [value] if isinstance(value, str) else list(value or ())
    return [x.strip() for v in values for x in v.split(",") if x.strip()]


def need(ok: bool, why: str) -> None:
    if not ok:
        raise SpecError(why)


@dataclass
class ConsumerSpec:
    """What to read: topics, a pattern or partitions, from where, and into which columns."""

    topics: str | list[str] | None = None
    pattern: str | None = None
    partitions: list[int] | None = None
    start_position: StartPosition | None = None
    start_position_str: str | None = None
    start_time: int | None = None
    start_offsets: list[int] | None = None
    control: T.StructType | None = None
    region: Region = Region.NONE
    trigger_count: int | None = None
    commit_period: float | None = None
    commit_count: int | None = None
    group_id: str | None = None
    static_group_member: bool = False
    legacy_groups: bool = False
    has_offset_store: bool = True
    message_type: str = "string"
    key_type: str = "string"
    message_column: str = "message"
    key_column: str = "key"
    topic_column: str = "topic"
    timestamp_column: str = "messageTimestamp"
    offset_column: str = "offset"
    partition_column: str = "partition"
    null_key_as_default: bool = True
    isolation: str = "read_committed"
    auto_offset_reset: str = "latest"
    position: StartPosition = field(init=False)
    commit: Commit = field(init=False)

    def __post_init__(self):
        self.topics = listed(self.topics)
        self.partitions = list(self.partitions or [])
        self.start_offsets = list(self.start_offsets or [])
        given = self.start_position is not None or self.start_position_str is not None
        if self.control is None:
            need(bool(self.topics) or self.pattern is not None, "topics or a pattern are needed without a control stream")
        else:
            need(not (self.topics or self.pattern or self.partitions or given), "a control stream excludes topics, pattern, partitions and start position")
            need(len(self.control.fields) > 0 and isinstance(self.control.fields[0].dataType, T.StringType), "the first column of a control stream must be a string")
            if self.region is not Region.NONE:
                warnings.warn("a control stream in a consistent region is deprecated", stacklevel=2)
        need(not (self.pattern and (self.partitions or self.topics)), "a pattern excludes topics and partitions")
        need(self.start_position is None or self.start_position_str is None, "give the start position once")
        # Checked for both spellings, after commas have been parted.
        self.position = StartPosition.of(self.start_position or self.start_position_str or StartPosition.DEFAULT)
        need(not self.start_offsets or bool(self.partitions), "start offsets need partitions")
        if self.position is StartPosition.TIME:
            need(self.start_time is not None, "start position Time needs a start time")
        if self.position is StartPosition.OFFSET:
            need(self.pattern is None, "a pattern can't start at offsets")
            need(bool(self.start_offsets), "start position Offset needs start offsets")
            need(len(self.partitions) == len(self.start_offsets), "there must be as many start offsets as partitions")
            need(len(self.topics) == 1, "start offsets need exactly one topic")
            need(self.region is Region.NONE or not self.group_managed, "a group in a consistent region can't start at offsets")
        if self.region is Region.NONE:
            need(self.commit_count is None or self.commit_period is None, "commit by count or by time, not both")
            if self.trigger_count is not None:
                warnings.warn("trigger_count is ignored outside a consistent region", stacklevel=2)
        else:
            if self.commit_count is not None or self.commit_period is not None:
                warnings.warn("commits follow the consistent region; count and period are ignored", stacklevel=2)
            if self.region is Region.OPERATOR_DRIVEN:
                need(self.trigger_count is not None and self.trigger_count > 0, "an operator driven region needs a positive trigger count")
            elif self.trigger_count is not None:
                warnings.warn("trigger_count is ignored in a periodic region", stacklevel=2)
        if self.commit_count is not None:
            need(self.commit_count > 0, "the commit count must be positive")
        if self.commit_period is not None and self.commit_period < LEAST_COMMIT_PERIOD:
            self.commit_period = LEAST_COMMIT_PERIOD
        need(self.pattern is None or self.group_managed, "a pattern needs group management")
        need(self.position is StartPosition.DEFAULT or self.has_offset_store, "a start position needs an offset store")
        for kind in (self.message_type, self.key_type):
            need(kind in TYPES, f"unsupported type {kind}")
        self.commit = Commit.DRAIN if self.region is not Region.NONE else Commit.COUNT if self.commit_count else Commit.TIME
        if self.commit is Commit.TIME and self.commit_period is None:
            self.commit_period = 5.0

    @property
    def group_managed(self) -> bool:
        """Whether the group assigns partitions: no partitions given (in legacy mode, also a group id)."""
        return not self.partitions and (not self.legacy_groups or self.group_id is not None)

    @property
    def client(self) -> str:
        """Which kind of reader the description asks for."""
        if self.control is not None and not self.topics:
            return "dummy"
        kind = "group" if self.group_managed else "static"
        return f"region-{kind}" if self.region is not Region.NONE else kind

    def bind(self, columns: list[str], named: dict[str, str] | None = None) -> dict[str, str]:
        """Which output columns exist: a default name that is absent is left out, a name that was asked for must be there."""
        roles = {"message": self.message_column, "key": self.key_column, "topic": self.topic_column, "timestamp_ms": self.timestamp_column, "offset": self.offset_column, "partition": self.partition_column}
        for role, name in (named or {}).items():
            need(name in columns, f"column {name} for {role} is not in the schema")
            roles[role] = name
        need(roles["message"] in columns, "there is no column for the message")
        return {role: name for role, name in roles.items() if name in columns}


def check_group(specs: list[ConsumerSpec]) -> None:
    """The readers of each group are all in one consistent region or all in none, and a group in a region can't start at offsets."""
    kinds: dict[str, set[Region]] = {}
    for s in specs:
        if s.group_id is not None and s.group_managed:
            kinds.setdefault(s.group_id, set()).add(s.region)
            need(s.region is Region.NONE or s.position is not StartPosition.OFFSET, f"group {s.group_id} in a consistent region can't start at offsets")
    for group, regions in kinds.items():
        need(len(regions) == 1, f"the readers of group {group} must be in the same consistent region or in none")


@dataclass
class SinkSpec:
    """What to write: topics, and the columns of message, key, partition and timestamp."""

    topics: str | list[str] | None = None
    topic_column: str | None = None
    message_column: str = "message"
    key_column: str | None = None
    partition_column: str | None = None
    timestamp_column: str | None = None
    guarantee_ordering: bool = False
    transactional: bool = False
    errors_only: bool = True
    flush: int = 0
    starts_region: bool = False
    max_generations: int = 3

    def __post_init__(self):
        self.topics = [self.topics] if isinstance(self.topics, str) else list(self.topics or ())
        need(not self.starts_region, "a writer can't start a consistent region")

    def bind(self, schema: T.StructType) -> dict[str, str]:
        """Roles to columns of the input, checked against its schema."""
        kinds = {f.name: f.dataType for f in schema.fields}
        out: dict[str, str] = {}
        if not self.topics:
            name = self.topic_column or "topic"
            need(name in kinds and isinstance(kinds[name], T.StringType), "topics or a string column of topics are needed")
            out["topic"] = name
        need(self.message_column in kinds, "there is no column for the message")
        need(isinstance(kinds[self.message_column], WRITABLE), f"messages can't be {kinds[self.message_column].simpleString()}")
        out["message"] = self.message_column
        for role, given, default, allowed in (
            ("key", self.key_column, "key", WRITABLE),
            ("partition", self.partition_column, "partition", (T.IntegerType,)),
            ("timestamp_ms", self.timestamp_column, "messageTimestamp", (T.LongType,)),
        ):
            need(given is None or given in kinds, f"column {given} for {role} is not in the schema")
            name = given or default
            if name in kinds:
                need(isinstance(kinds[name], allowed), f"{role} can't be {kinds[name].simpleString()}")
                out[role] = name
        return out


def check_status_schema(schema: T.StructType, input_schema: T.StructType) -> None:
    """A status stream has at most one row of the input's schema and one string."""
    rows = [f for f in schema.fields if isinstance(f.dataType, T.StructType)]
    texts = [f for f in schema.fields if isinstance(f.dataType, T.StringType)]
    need(len(schema.fields) <= 2 and len(rows) + len(texts) == len(schema.fields), "a status stream has a row and a string at most")
    need(len(rows) <= 1 and len(texts) <= 1, "a status stream has one row and one string at most")
    kinds = lambda s: [(f.name, f.dataType) for f in s.fields]
    need(not rows or kinds(rows[0].dataType) == kinds(input_schema), "the row of a status stream must have the input's schema")
