"""The protobuf runtime, message by message, as a measure for the library's reader."""

from __future__ import annotations

from functools import lru_cache

from kelvane.sources import otlp

try:
    from google.protobuf import descriptor_pool, message_factory
except ImportError:
    descriptor_pool = None


def available() -> bool:
    return descriptor_pool is not None


@lru_cache(maxsize=1)
def message_class():
    pool = descriptor_pool.DescriptorPool()
    pool.Add(otlp._file_descriptor())
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(otlp.ROOT_MESSAGE))


def _signed(value: int) -> int:
    """An unsigned 64-bit field as the signed long a JVM reader sees."""
    return value - 2**64 if value >= 2**63 else value


def _value_row(value) -> dict:
    kind = value.WhichOneof("value")
    names = ("string_value", "int_value", "double_value", "bool_value")
    return {n: getattr(value, n) if n == kind else None for n in names}


def _attribute_rows(attributes) -> list[dict]:
    return [{"key": a.key, "value": _value_row(a.value)} for a in attributes]


def _metric_row(metric) -> dict:
    gauge = None
    if metric.HasField("gauge"):
        gauge = {"data_points": [{
            "attributes": _attribute_rows(p.attributes),
            "time_unix_nano": _signed(p.time_unix_nano),
            "as_double": p.as_double if p.WhichOneof("value") == "as_double" else None,
            "as_int": p.as_int if p.WhichOneof("value") == "as_int" else None,
        } for p in metric.gauge.data_points]}
    return {"name": metric.name, "gauge": gauge}


def batch_row(data: bytes | None) -> list[dict] | None:
    """Resources of one message, or None where the bytes are no message."""
    if not data:
        return None
    batch = message_class()()
    try:
        batch.ParseFromString(data)
    except Exception:
        return None
    return [{
        "resource": {"attributes": _attribute_rows(r.resource.attributes)},
        "scope_metrics": [{"metrics": [_metric_row(m) for m in s.metrics]}
                          for s in r.scope_metrics],
    } for r in batch.resource_metrics]


def _set(**fields) -> dict:
    return {name: value for name, value in fields.items() if value is not None}


def _attribute_messages(attributes) -> list[dict]:
    return [_set(key=a["key"], value=_set(**(a["value"] or {}))) for a in attributes or []]


def _point_message(point) -> dict:
    whole = point["as_int"] if point["as_double"] is None else None
    return _set(
        attributes=_attribute_messages(point["attributes"]),
        time_unix_nano=(point["time_unix_nano"] or 0) % 2**64,
        as_double=point["as_double"], as_int=whole)


def _metric_message(metric) -> dict:
    gauge = metric["gauge"]
    if gauge is not None:
        gauge = {"data_points": [_point_message(p) for p in gauge["data_points"] or []]}
    return _set(name=metric["name"], gauge=gauge)


def batch_bytes(resources: list[dict] | None) -> bytes:
    """One message from the rows of its resources."""
    return message_class()(resource_metrics=[{
        "resource": {"attributes": _attribute_messages((r["resource"] or {}).get("attributes"))},
        "scope_metrics": [{"metrics": [_metric_message(m) for m in s["metrics"] or []]}
                          for s in r["scope_metrics"] or []],
    } for r in resources or []]).SerializeToString()
