"""Options of a job and the rules between them, checked when a plan is built."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from .operators.route import MAX_MAPPINGS, NAMESPACE_LENGTH

# What a dataset or namespace may not contain.
FORBIDDEN = set('\\/*?"<>| ,#-:')
STREAM_TYPES = ("", "logs", "metrics")
NULL_POLICIES = ("ignore", "delete", "fail")
MALFORMED_POLICIES = ("ignore", "warn", "fail")
WRITE_METHODS = ("insert", "upsert")


@dataclass(frozen=True)
class Options:
    key_ignore: bool = False
    topic_key_ignore: tuple[str, ...] = ()
    schema_ignore: bool = False
    topic_schema_ignore: tuple[str, ...] = ()
    compact_map_entries: bool = True
    drop_invalid: bool = False
    generated_ids: bool = False
    null_policy: str = "fail"
    malformed_policy: str = "fail"
    version_header: str = ""
    write_method: str = "insert"
    #: The target's fields and their Spark SQL types; with them documents are checked before they are written.
    declared_fields: dict[str, str] = field(default_factory=dict)
    declared_strict: bool = True
    stream_type: str = ""
    stream_dataset: str = ""
    stream_namespace: str = "${topic}"
    timestamp_fields: tuple[str, ...] = ()
    topic_resources: dict[str, str] = field(default_factory=dict)
    use_external_resources: bool = False
    topics: tuple[str, ...] = ()
    max_mappings: int = MAX_MAPPINGS
    batch_size: int = 2000
    bulk_bytes: int = 5 << 20
    max_in_flight: int = 5
    max_buffered: int = 20_000
    linger_ms: int = 1
    flush_timeout_ms: int = 180_000
    max_retries: int = 5
    backoff_ms: int = 100

    @property
    def is_stream(self) -> bool:
        return bool(self.stream_type and self.stream_dataset)

    def __post_init__(self):
        def need(ok: bool, message: str) -> None:
            if not ok:
                raise ValueError(message)

        need(self.null_policy in NULL_POLICIES, f"null_policy must be one of {NULL_POLICIES}")
        need(self.malformed_policy in MALFORMED_POLICIES, f"malformed_policy must be one of {MALFORMED_POLICIES}")
        need(self.write_method in WRITE_METHODS, f"write_method must be one of {WRITE_METHODS}")
        need(self.stream_type in STREAM_TYPES, f"stream_type must be one of {STREAM_TYPES}")
        need(not (self.key_ignore and self.topic_key_ignore), "key_ignore and topic_key_ignore exclude each other")
        need(not (self.schema_ignore and self.topic_schema_ignore), "schema_ignore and topic_schema_ignore exclude each other")
        need(bool(self.stream_type) == bool(self.stream_dataset), "stream_type and stream_dataset must both be set or neither")
        need(self.is_stream or not self.timestamp_fields, "timestamp_fields are only for data streams")
        need(not self.is_stream or self.write_method != "upsert", "data streams can't be upserted")
        need(not self.is_stream or self.null_policy != "delete", "data streams can't be deleted from")
        need(self.use_external_resources == bool(self.topic_resources), "external resources need a mapping, and a mapping needs them")
        need(not (self.use_external_resources and self.is_stream), "external resources exclude data stream options")
        need(len(self.topic_resources) <= self.max_mappings, f"at most {self.max_mappings} topics can be mapped")
        need(len(set(self.topic_resources.values())) == len(self.topic_resources), "two topics can't share a resource")
        need(not (self.topics and self.topic_resources) or set(self.topics) == set(self.topic_resources), "the mapped topics must be the topics read")
        need(1 <= self.batch_size <= 1_000_000, "batch_size must be from 1 to 1000000")
        need(self.bulk_bytes == -1 or self.bulk_bytes > 0, "bulk_bytes must be positive, or -1 for no limit")
        need(self.max_buffered >= self.batch_size * self.max_in_flight, "max_buffered must hold max_in_flight batches")
        need(self.linger_ms <= self.flush_timeout_ms, "linger_ms can't exceed flush_timeout_ms")
        need(self.max_retries >= 0 and self.backoff_ms >= 0, "max_retries and backoff_ms can't be negative")
        for name, text in (("stream_dataset", self.stream_dataset), ("stream_namespace", re.sub(r"\$\{topic\}", "", self.stream_namespace))):
            need(len(text) <= NAMESPACE_LENGTH, f"{name} can't be longer than {NAMESPACE_LENGTH}")
            need(text == text.lower() and not FORBIDDEN & set(text), f"{name} must be lower case without {''.join(sorted(FORBIDDEN))}")
