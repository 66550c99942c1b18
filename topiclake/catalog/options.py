"""Table options and their rules.

Options are a plain dict of strings.  Messages state which option is wrong; they are
raised on the driver before any job runs.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from topiclake.functions.topic_names import full_name

STARTUP_MODES = ("earliest", "latest", "specific-offsets", "external-subscription", "timestamp")
SEMANTICS = ("at-least-once", "exactly-once", "none")
ALL, EXCEPT_KEY = "ALL", "EXCEPT_KEY"
#: formats whose rows are inserts only; a changelog format may carry updates itself
CHANGELOG_FORMATS = ("debezium-json", "canal-json", "maxwell-json")
READER_PREFIX, PRODUCER_PREFIX, PROPERTIES_PREFIX = "reader.", "producer.", "properties."
SCHEMA_MODES = ("SPECIAL", "ATOMIC", "POJO", "ROW")
# Defaults of the options that have one.
DEFAULTS = {
    "scan.startup.mode": "latest",
    "scan.startup.sub-start-offset": "latest",
    "sink.semantic": "at-least-once",
    "value.fields-include": ALL,
    "generic": "false",
    "partition-discovery-interval-ms": "-1",
    "commit-max-retries": "3",
    "fail-on-write": "true",
    "failondataloss": "true",
    "flush-on-checkpoint": "true",
}

# Options without a default, and the prefixes below which options are passed on.
PLAIN = (
    "connector", "topic", "topic-pattern", "service-url", "admin-url", "format", "key.format", "value.format", "key.fields",
    "key.fields-prefix", "scan.startup.specific-offsets", "scan.startup.sub-name", "scan.startup.timestamp-millis",
    "sink.message-router", "sink.parallelism",
)
PREFIXES = (READER_PREFIX, PRODUCER_PREFIX, PROPERTIES_PREFIX)
FORMATS = ("json", "avro", "raw", "atomic", "protobuf", "csv", *CHANGELOG_FORMATS)


# Texts of the errors, as users of such table options know them.
MESSAGES = {
    "both topics": "Option 'topic' and 'topic-pattern' shouldn't be set together.",
    "no topic": "Either 'topic' or 'topic-pattern' must be set.",
    "startup mode": "Invalid value for option 'scan.startup.mode'. Supported values are "
    "[earliest, latest, specific-offsets, external-subscription, timestamp], but was: {mode}",
    "startup option": "'{option}' is required in '{mode}' startup mode but missing.",
    "single topic": "the sink currently only supports single topic, but got '{option}': {value}.",
    "router": "Option 'sink.message-router' should be a non-empty string.",
    "semantic": "Unsupported value '{semantic}' for 'sink.semantic'. "
    "Supported values are ['at-least-once', 'exactly-once', 'none'].",
    "key format": "The option 'key.fields' can only be declared if a key format is defined using 'key.format'.",
    "key fields": "A key format 'key.format' requires the declaration of one or more of key fields using 'key.fields'.",
    "key field": "Could not find the field '{name}' in the table schema for usage in the key format. "
    "A key field must be a regular, physical column. "
    "The following columns can be selected in the 'key.fields' option:\n{columns}",
    "key prefix": "All fields in 'key.fields' must be prefixed with '{prefix}' when option "
    "'key.fields-prefix' is set but field '{name}' is not prefixed.",
    "prefix with all": "A key prefix is not allowed when option 'value.fields-include' is set to 'ALL'. "
    "Set it to 'EXCEPT_KEY' instead to avoid field overlaps.",
    "primary key": "The table with '{format}' format doesn't support defining PRIMARY KEY constraint "
    "on the table, because it can't guarantee the semantic of primary key.",
    "upsert topics": "The upsert table doesn't support topic list now. "
    "Please use single topic as the value of the parameter 'topic'.",
    "upsert format": "upsert table doesn't support '{format}' as {part} format, because '{format}' is not in insert-only mode.",
    "upsert key": "upsert tables require to define a PRIMARY KEY constraint. "
    "The PRIMARY KEY specifies which columns should be read from or write to the message key.",
}


class OptionError(ValueError):
    """An option that is missing, wrong or does not go with another."""


def refuse(message: str, **values: object) -> OptionError:
    return OptionError(MESSAGES[message].format(**values))


def case_folded(options: Mapping[str, str]) -> dict[str, str]:
    return {k.lower(): v for k, v in options.items()}


def with_prefix(options: Mapping[str, str], prefix: str) -> dict[str, str]:
    """Options below a prefix, without it."""
    return {k[len(prefix) :]: v for k, v in options.items() if k.startswith(prefix)}


def topic_list(value: str | None) -> list[str]:
    """Topics of a list option; blanks are trimmed and empty names dropped."""
    return [t.strip() for t in (value or "").replace(";", ",").split(",") if t.strip()]


def check_known(options: Mapping[str, str]) -> None:
    """Refuse options that nothing reads: a misspelt one must not mean its default."""
    formats = tuple(f"{part}{fmt}." for part in ("", "key.", "value.") for fmt in FORMATS)
    unknown = sorted(o for o in options if o not in DEFAULTS and o not in PLAIN and not o.startswith((*PREFIXES, *formats)))
    if unknown:
        raise OptionError(f"Unsupported options found: {unknown}. Supported options: {sorted([*DEFAULTS, *PLAIN])}")


def validate_source(options: Mapping[str, str]) -> None:
    """Topic and startup mode of a table that is read."""
    if "topic" in options and "topic-pattern" in options:
        raise refuse("both topics")
    if "topic" not in options and "topic-pattern" not in options:
        raise refuse("no topic")
    mode = options.get("scan.startup.mode", DEFAULTS["scan.startup.mode"]).lower()
    if mode not in STARTUP_MODES:
        raise refuse("startup mode", mode=mode)
    needed = {
        "external-subscription": "scan.startup.sub-name",
        "specific-offsets": "scan.startup.specific-offsets",
        "timestamp": "scan.startup.timestamp-millis",
    }
    if mode in needed and needed[mode] not in options:
        raise refuse("startup option", option=needed[mode], mode=mode)


def validate_sink(options: Mapping[str, str]) -> None:
    """Topic, router and semantic of a table that is written."""
    if len(topic_list(options.get("topic"))) != 1:
        option = "topic-pattern" if "topic-pattern" in options else "topic"
        raise refuse("single topic", option=option, value=options.get(option))
    if options.get("sink.message-router") == "":
        raise refuse("router")
    semantic = options.get("sink.semantic", DEFAULTS["sink.semantic"])
    if semantic not in SEMANTICS:
        raise refuse("semantic", semantic=semantic)


def key_columns(schema: T.StructType, options: Mapping[str, str]) -> list[str]:
    """Columns stored in the key, in the order of ``key.fields``."""
    fields = topic_list(options.get("key.fields"))
    if "key.format" not in options:
        if "key.fields" in options:
            raise refuse("key format")
        return []
    if not fields:
        raise refuse("key fields")
    prefix = options.get("key.fields-prefix", "")
    for name in fields:
        if name not in schema.names:
            raise refuse("key field", name=name, columns=schema.names)
        if not name.startswith(prefix):
            raise refuse("key prefix", prefix=prefix, name=name)
    return fields


def value_columns(schema: T.StructType, options: Mapping[str, str]) -> list[str]:
    """Columns stored in the value: all of them, or those that are not in the key."""
    include = options.get("value.fields-include", ALL)
    if include == EXCEPT_KEY:
        keys = set(key_columns(schema, options))
        return [n for n in schema.names if n not in keys]
    if include != ALL:
        raise OptionError(f"Invalid value for option 'value.fields-include': {include}")
    if options.get("key.fields-prefix"):
        raise refuse("prefix with all")
    return list(schema.names)


def check_schema_mode(mode: str | None) -> str:
    """Exactly one way to state the schema a writer uses."""
    if mode is None or mode.upper() not in SCHEMA_MODES:
        raise OptionError(f"one schema mode of {list(SCHEMA_MODES)} must be set")
    return mode.upper()


@dataclass(frozen=True)
class TableOptions:
    """Validated options of one table."""

    schema: T.StructType
    options: Mapping[str, str]
    primary_key: list[str] = field(default_factory=list)
    upsert: bool = False

    def __post_init__(self) -> None:
        opts = case_folded(self.options)
        object.__setattr__(self, "options", opts)
        check_known(opts)
        if self.upsert:
            self._check_upsert(opts)
        elif self.primary_key and self.value_format not in CHANGELOG_FORMATS:
            raise refuse("primary key", format=self.value_format)
        self.key_columns, self.value_columns  # noqa: B018  the rules are checked by computing them

    def _check_upsert(self, opts: dict[str, str]) -> None:
        if len(topic_list(opts.get("topic"))) > 1:
            raise refuse("upsert topics")
        for part in ("key", "value"):
            fmt = opts.get(f"{part}.format")
            if fmt in CHANGELOG_FORMATS:
                raise refuse("upsert format", format=fmt, part=part)
        if not self.primary_key:
            raise refuse("upsert key")
        if "key.fields" in opts:
            raise OptionError("'key.fields' cannot be set, an upsert table uses its PRIMARY KEY")
        opts["key.fields"] = ",".join(self.primary_key)
        opts.setdefault("key.format", "json")
        # an upsert topic is always read from its first message
        opts["scan.startup.mode"] = "earliest"

    def get(self, name: str) -> str | None:
        return self.options.get(name, DEFAULTS.get(name))

    @property
    def value_format(self) -> str | None:
        return self.options.get("value.format", self.options.get("format"))

    @property
    def key_columns(self) -> list[str]:
        return key_columns(self.schema, self.options)

    @property
    def value_columns(self) -> list[str]:
        return value_columns(self.schema, self.options)

    @property
    def topics(self) -> list[str]:
        return [full_name(t) for t in topic_list(self.options.get("topic"))]
