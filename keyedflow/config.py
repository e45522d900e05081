"""What differs between one kind of message and another, kept out of the operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import types as T

from keyedflow.functions.text import LEADING_LETTERS, TRAILING_DIGITS


@dataclass(frozen=True)
class Field:
    """One payload field, the column it becomes, and an optional clean-up expression."""

    source: str
    target: str
    clean: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class KeySpec:
    """Columns and patterns a business key is made of.

    The key reads ``carrier-number-day-place``; the fall-back words stand in for nulls only; where
    there is no such word the part is left out.
    """

    number: str = "number"
    day: str = "day"
    place: str = "place"
    kind: str | None = None
    key: str = "key"
    carrier: str = "carrier"
    carrier_pattern: str = LEADING_LETTERS
    number_pattern: str = TRAILING_DIGITS
    no_carrier: str | None = None
    no_number: str | None = None
    no_day: str | None = None
    no_place: str | None = None


@dataclass(frozen=True)
class MapGroup:
    """A map column with fixed keys, plus further keys for rows of one kind."""

    target: str
    keys: tuple[str, ...]
    kind: str | None = None
    kind_keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class Envelope:
    """Column names of a decoded message."""

    body: str = "json_body"
    received: str = "ingestiontime"
    enqueued: str = "enqueuedTime"
    lag: str = "time_difference_seconds"
    sequence: str = "sequenceNumber"


@dataclass(frozen=True)
class MessageConfig:
    schema: T.StructType
    fields: tuple[Field, ...]
    required: tuple[str, ...]
    day: str
    key: KeySpec
    items: str
    names: Mapping[str, str]
    groups: tuple[MapGroup, ...]
    document_columns: tuple[str, ...]
    envelope: Envelope = field(default_factory=Envelope)
    aliases: Mapping[str, str] = field(default_factory=dict)
    lifted: tuple[str, ...] = ()
    normalized: tuple[str, ...] = ()
    #: Columns stamped with the time of processing: of documents with their patterns, and of the key log.
    document_stamps: Mapping[str, str] = field(default_factory=dict)
    log_stamps: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        clash = set(self.aliases) & set(self.names.values())
        if clash:
            raise ValueError(f"alias keys repeat dictionary names: {sorted(clash)}")

    def narrowed(self) -> MessageConfig:
        """The same messages with only the fields that decide on rejects and make up the key."""
        needed = {*self.required, self.day, self.key.number, self.key.day, self.key.place}
        fields = tuple(f for f in self.fields if f.target in needed)
        sources = {f.source for f in fields}
        schema = T.StructType([f for f in self.schema if f.name in sources])
        return replace(self, fields=fields, schema=schema)
