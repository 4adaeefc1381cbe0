"""Client properties: merging, expansion, defaults and adjustments, and generated identifiers.

Plain functions from dictionaries to dictionaries; they build options for a
message-log client and need neither Spark nor a broker.
"""

from __future__ import annotations

import os
import warnings

# Defaults and limits in milliseconds.
MAX_POLL_INTERVAL_MS = 300_000
SESSION_TIMEOUT_MS = 20_000
STATIC_SESSION_TIMEOUT_MS = 120_000
REQUEST_MARGIN_MS = 5_000
METADATA_MAX_AGE_MS = 2_000
REGION_TIMEOUT_FACTOR = 3
TRANSACTION_MARGIN_MS, MAX_TRANSACTION_MS = 120_000, 900_000
CONNECTION_DEFAULTS = {
    "client.dns.lookup": "use_all_dns_ips",
    "reconnect.backoff.max.ms": "10000",
    "reconnect.backoff.ms": "250",
    "retry.backoff.ms": "500",
}
RANGE = "org.apache.kafka.clients.consumer.RangeAssignor"
ROUND_ROBIN = "org.apache.kafka.clients.consumer.RoundRobinAssignor"
COOPERATIVE = ("org.apache.kafka.clients.consumer.CooperativeStickyAssignor",)


def read_properties(path: str, application_dir: str = ".") -> dict[str, str]:
    """A properties file; a relative path is in the application's directory. A missing file gives a warning and nothing."""
    where = path if os.path.isabs(path) else os.path.join(application_dir, path)
    if not os.path.exists(where):
        warnings.warn(f"properties file {where} not found", stacklevel=2)
        return {}
    out: dict[str, str] = {}
    held = ""
    with open(where, encoding="utf-8") as f:
        for line in f:
            line = held + line.strip() if held else line.strip()
            held = ""
            if not line or line[0] in "#!":
                continue
            if line.endswith("\\"):
                held = line[:-1]
                continue
            cut = min((line.find(c) for c in "=:" if c in line), default=len(line))
            out[line[:cut].strip()] = line[cut + 1 :].strip()
    return out


def merge(file: dict[str, str], app_config: dict[str, str], params: dict[str, str]) -> dict[str, str]:
    """File before application configuration, the first writer wins; explicit parameters override both."""
    if app_config is not None and not app_config:
        warnings.warn("the application configuration is empty", stacklevel=2)
    return {**(app_config or {}), **file, **{k: str(v) for k, v in params.items() if v is not None}}


def expand(props: dict[str, str], application_dir: str) -> dict[str, str]:
    return {k: v.replace("{applicationDir}", application_dir) for k, v in props.items()}


def java_hash(text: str) -> int:
    """The 32-bit string hash of Java, over UTF-16 code units."""
    h = 0
    raw = text.encode("utf-16-be", "surrogatepass")
    for i in range(0, len(raw), 2):
        h = (31 * h + (raw[i] << 8 | raw[i + 1])) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def signed_tag(text: str) -> str:
    h = java_hash(text)
    return f"N{-h}" if h < 0 else f"P{h}"


def group_id(instance: str, job: str | int, operator: str) -> str:
    """Stable over restarts of a job, different for each submission."""
    return f"i{signed_tag(instance)}-j{job}-o{signed_tag(operator)}"


def group_instance_id(instance: str, operator: str) -> str:
    return f"i{signed_tag(instance)}-o{signed_tag(operator)}"


def with_member_id(props: dict[str, str], static: bool, group_managed: bool, instance: str, operator: str) -> dict[str, str]:
    """Properties of a reader with its member id: a static member of a group has one, its own or a made one; readers of given partitions have none."""
    key = "group.instance.id"
    if not group_managed:
        return {k: v for k, v in props.items() if k != key}
    return {**props, key: group_instance_id(instance, operator)} if static and not props.get(key, "").strip() else dict(props)


def client_id(is_source: bool, job: str | int, operator: str, given: str | None = None, channel: int = -1) -> str:
    if given is None:
        return f"{'C' if is_source else 'P'}-J{job}-{operator}"
    return f"{given}-{channel}" if channel >= 0 else given


def with_defaults(props: dict[str, str], defaults: dict[str, str]) -> dict[str, str]:
    return {**defaults, **props}


def consumer_properties(props: dict[str, str], *, region: bool = False, reset_ms: int = 0, drain_ms: int = 0) -> dict[str, str]:
    """Timeouts that belong together, isolation, and no automatic commit."""
    out = with_defaults(props, {**CONNECTION_DEFAULTS, "isolation.level": "read_committed"})
    least_poll = REGION_TIMEOUT_FACTOR * max(reset_ms, drain_ms) if region else MAX_POLL_INTERVAL_MS
    if int(out.get("max.poll.interval.ms", -1)) < least_poll:
        out["max.poll.interval.ms"] = str(least_poll)
    member = bool(out.get("group.instance.id", "").strip())
    out.setdefault("session.timeout.ms", str(max(int(1.2 * reset_ms), STATIC_SESSION_TIMEOUT_MS) if member else SESSION_TIMEOUT_MS))
    session = SESSION_TIMEOUT_MS if member else int(out["session.timeout.ms"])
    if int(out.get("request.timeout.ms", -1)) < session + REQUEST_MARGIN_MS:
        out["request.timeout.ms"] = str(session + REQUEST_MARGIN_MS)
    if int(out.get("metadata.max.age.ms", METADATA_MAX_AGE_MS)) >= METADATA_MAX_AGE_MS:
        out["metadata.max.age.ms"] = str(METADATA_MAX_AGE_MS)
    if out.get("enable.auto.commit", "false") != "false":
        warnings.warn("enable.auto.commit is always false", stacklevel=2)
    out["enable.auto.commit"] = "false"
    return out


def assignor(props: dict[str, str], *, region: bool, single_topic: bool) -> dict[str, str]:
    """Round robin for several topics (range for one in a consistent region); regions do without cooperative assignors."""
    key = "partition.assignment.strategy"
    default = RANGE if region and single_topic else ROUND_ROBIN
    if key not in props:
        return {**props, key: default} if region or not single_topic else dict(props)
    if not region:
        return dict(props)
    eager = [x.strip() for x in props[key].split(",") if x.strip() not in COOPERATIVE]
    return {**props, key: ",".join(eager) or default}


def producer_properties(props: dict[str, str], guarantee_ordering: bool = False) -> dict[str, str]:
    out = with_defaults(props, {**CONNECTION_DEFAULTS, "linger.ms": "100", "batch.size": "32768"})
    if guarantee_ordering:
        out["enable.idempotence"] = "true"
    idempotent = out.get("enable.idempotence", "false").strip().lower() == "true"
    if idempotent:
        if out.get("acks", "all") not in ("all", "-1"):
            warnings.warn("acks has been changed to all for idempotence", stacklevel=2)
            out["acks"] = "all"
        out.setdefault("acks", "all")
        if int(out.get("retries", 1)) < 1:
            out["retries"] = "1"
    most = 5 if idempotent else 10
    key = "max.in.flight.requests.per.connection"
    if key not in out or (idempotent and int(out[key]) > most):
        out[key] = str(most)
    return out


def transaction_timeout_ms(drain_ms: int) -> int:
    return min(drain_ms + TRANSACTION_MARGIN_MS, MAX_TRANSACTION_MS)


def reader_options(props: dict[str, str], *, topics=None, pattern=None, partitions=None, starting=None, starting_time_ms=None) -> dict[str, str]:
    """Options for Spark's own reader of a broker, for the same subscription."""
    import json

    out = {f"kafka.{k}": v for k, v in props.items() if k not in ("enable.auto.commit", "group.id", "auto.offset.reset")}
    if "group.id" in props:
        out["kafka.group.id"] = props["group.id"]
    if pattern:
        out["subscribePattern"] = pattern
    elif partitions:
        out["assign"] = json.dumps({t: list(partitions) for t in topics})
    else:
        out["subscribe"] = ",".join(topics)
    if starting_time_ms is not None:
        out["startingTimestamp"] = str(starting_time_ms)
        out["startingOffsetsByTimestampStrategy"] = "latest"
    elif isinstance(starting, dict):
        out["startingOffsets"] = json.dumps({t: {str(p): o for p, o in ps.items()} for t, ps in starting.items()})
    elif starting:
        out["startingOffsets"] = starting
    return out
