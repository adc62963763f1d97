"""Protobuf wire format to nested Arrow arrays, many messages at a time.

Messages of one kind are read in step: each pass of ``fields`` takes the next
tag and value of every message that is not yet at its end, as numpy operations
on the buffers Arrow delivers. What it finds are places in the buffer, which
serve as messages of the next kind or become columns; no object is made for a
message or a field.

As the format asks, a repeated single message merges with the one before it, the
last of a oneof counts, unknown fields are skipped. A message that ends within a
field, holds a group (which the protocol never had) or text that is not UTF-8
makes its whole batch null.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VARINT, FIXED64, BYTES, FIXED32 = 0, 1, 2, 5
_WIDTH = {FIXED64: 8, FIXED32: 4}
# Longest varint; no read goes further behind a message's end.
_PAD = 10
# Bytes of messages that are read in step, and messages that are coded at once.
RUN_BYTES = 1 << 20
CODED_ROWS = 64


def _varints(data: np.ndarray, at: np.ndarray, stop: np.ndarray):
    """Value, next place and soundness of the varints that begin at ``at``."""
    value, ok, more = np.zeros(len(at), np.uint64), at < stop, np.ones(len(at), bool)
    at = at.copy()
    for k in range(_PAD):
        byte = data[at]
        value |= np.where(more, (byte & 0x7F).astype(np.uint64) << np.uint64(7 * k), np.uint64(0))
        at += more
        more &= byte > 0x7F
        if not more.any():
            return value, at, ok & (at <= stop)
        ok &= ~more | (at < stop)
        more &= ok
    return value, at, ok & ~more & (at <= stop)


@dataclass
class Fields:
    """Fields of ``size`` messages, in order within each.

    ``row`` is the message, ``low``/``high`` the place of the value, ``value``
    the number of a varint.
    """

    row: np.ndarray
    number: np.ndarray
    kind: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    size: int
    root: np.ndarray

    def pick(self, chosen: np.ndarray) -> Fields:
        return Fields(self.row[chosen], self.number[chosen], self.kind[chosen], self.low[chosen], self.high[chosen],
                      self.value[chosen], self.size, self.root)

    def of(self, *specs: tuple[int, int]) -> Fields:
        """Fields of these (number, kind); one with another kind is unknown."""
        chosen = np.zeros(len(self.row), bool)
        for number, kind in specs:
            chosen |= (self.number == number) & (self.kind == kind)
        return self.pick(chosen)

    def last(self) -> tuple[Fields, np.ndarray]:
        """The last field of each message, and which messages have one."""
        end = np.searchsorted(self.row, np.arange(self.size), "right")
        has = np.diff(end, prepend=0) > 0
        return self.pick(end[has] - 1), has

    def offsets(self) -> np.ndarray:
        return np.searchsorted(self.row, np.arange(self.size + 1)).astype(np.int32)


class Reader:
    """The buffer of a batch and which of its roots turned out unsound."""

    def __init__(self, values: pa.Array) -> None:
        values = values.cast(pa.large_binary())
        self.size = len(values)
        _, offsets, data = values.buffers()
        at = np.frombuffer(offsets, np.int64)[values.offset:values.offset + self.size + 1]
        raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
        at = at - at[0]  # of a slice, only its own bytes
        self.data = np.append(raw, np.zeros(_PAD, np.uint8))
        self.low, self.high = at[:-1].copy(), at[1:].copy()
        nothing = values.is_null().to_numpy(zero_copy_only=False) | (self.low == self.high)
        self.high[nothing] = self.low[nothing]
        self.unsound = nothing

    def fields(self, low: np.ndarray, high: np.ndarray, row: np.ndarray, size: int, root: np.ndarray) -> Fields:
        """All fields of the messages at ``low``..``high``; those with one ``row`` merge."""
        found, at, live = [], low.astype(np.int64), np.flatnonzero(low < high)
        while len(live):
            stop = high[live]
            tag, place, ok = _varints(self.data, at[live], stop)
            kind, number = (tag & np.uint64(7)).astype(np.int64), (tag >> np.uint64(3)).astype(np.int64)
            ok &= (number > 0) & (tag < 2**32)
            value, first = np.zeros(len(live), np.uint64), place.copy()
            counted = np.flatnonzero(ok & ((kind == VARINT) | (kind == BYTES)))
            value[counted], place[counted], sound = _varints(self.data, place[counted], stop[counted])
            ok[counted] &= sound
            sized = kind == BYTES
            ok &= ~sized | (value < 2**31)
            first[sized] = place[sized]
            place[sized] += np.where(ok[sized], value[sized], 0).astype(np.int64)
            for width_kind, width in _WIDTH.items():
                place[kind == width_kind] += width
            ok &= np.isin(kind, (VARINT, FIXED64, BYTES, FIXED32)) & (place <= stop)
            self.unsound[root[row[live[~ok]]]] = True
            live = live[ok]
            found.append((live, number[ok], kind[ok], first[ok], place[ok], value[ok]))
            at[live] = place[ok]
            live = live[at[live] < high[live]]
        columns = [np.concatenate(c) for c in zip(*found)] or [np.zeros(0, np.int64)] * 5 + [np.zeros(0, np.uint64)]
        order = np.argsort(columns[0], kind="stable")
        message, *rest = [c[order] for c in columns]
        return Fields(row[message], *rest, size, root)

    def repeated(self, parent: Fields, number: int) -> tuple[Fields, np.ndarray]:
        """Messages of a repeated field, and where each parent's begin among them."""
        at = parent.of((number, BYTES))
        n = len(at.row)
        return self.fields(at.low, at.high, np.arange(n), n, parent.root[at.row]), at.offsets()

    def single(self, at: Fields) -> Fields:
        """The one message of each row, merged from its parts."""
        return self.fields(at.low, at.high, at.row, at.size, at.root)

    def texts(self, at: Fields, has: np.ndarray, absent: bytes | None) -> pa.Array:
        """One text for each message: of those that have one, in order, else ``absent``."""
        length = np.zeros(len(has), np.int64)
        length[has] = at.high - at.low
        offsets = np.append(0, np.cumsum(length))
        places = np.repeat(at.low - offsets[:-1][has], length[has]) + np.arange(offsets[-1])
        missing = None if absent is not None else pa.array(has).buffers()[1]
        parts = [missing, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(self.data[places])]
        try:
            return pa.Array.from_buffers(pa.binary(), len(has), parts).cast(pa.string())
        except pa.ArrowInvalid:
            bad = np.array([_not_text(self.data[a:b].tobytes()) for a, b in zip(at.low, at.high)])
            self.unsound[at.root[at.row[bad]]] = True
            keep = has.copy()
            keep[np.flatnonzero(has)[bad]] = False
            return self.texts(at.pick(~bad), keep, absent)

    def words(self, at: Fields) -> np.ndarray:
        """Eight bytes each, as unsigned numbers."""
        return self.data[at.low[:, None] + np.arange(8)].view("<u8").ravel()


def _not_text(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return True
    return False


def _numbers(values: np.ndarray, has: np.ndarray, kind: str) -> pa.Array:
    """One number for each message, null where it has none."""
    out = np.zeros(len(has), values.dtype)
    out[has] = values
    return pa.array(out.view(kind), mask=~has)


def _structs(kind: pa.StructType, columns: dict[str, pa.Array], missing: np.ndarray | None = None) -> pa.Array:
    return pa.StructArray.from_arrays(
        [columns[f.name] for f in kind], fields=list(kind), mask=None if missing is None else pa.array(missing))


def _listed(kind: pa.ListType, offsets: np.ndarray, values: pa.Array, missing: np.ndarray | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(offsets), values, type=kind, mask=None if missing is None else pa.array(missing))


# Field numbers below are fixed values of the public metrics protocol.

def _any_value(reader: Reader, message: Fields, kind: pa.StructType) -> pa.Array:
    value, has = message.of((1, BYTES), (2, VARINT), (3, VARINT), (4, FIXED64), (5, BYTES), (6, BYTES), (7, BYTES)).last()

    def chosen(number: int) -> tuple[Fields, np.ndarray]:
        mine, which = value.number == number, has.copy()
        which[has] = mine
        return value.pick(mine), which

    for number in (5, 6):
        reader.single(chosen(number)[0])
    (text, is_text), (flag, is_flag), (whole, is_whole), (real, is_real) = map(chosen, (1, 2, 3, 4))
    flags = np.zeros(len(has), bool)
    flags[is_flag] = flag.value != 0
    return _structs(kind, {
        "string_value": reader.texts(text, is_text, None), "bool_value": pa.array(flags, mask=~is_flag),
        "int_value": _numbers(whole.value, is_whole, "int64"),
        "double_value": _numbers(reader.words(real), is_real, "float64")})


def _attributes(reader: Reader, parent: Fields, number: int, kind: pa.ListType) -> pa.Array:
    entries, offsets = reader.repeated(parent, number)
    value = kind.value_type.field("value").type
    return _listed(kind, offsets, _structs(kind.value_type, {
        "key": reader.texts(*entries.of((1, BYTES)).last(), b""),
        "value": _any_value(reader, reader.single(entries.of((2, BYTES))), value)}))


def _points(reader: Reader, gauge: Fields, kind: pa.ListType) -> pa.Array:
    points, offsets = reader.repeated(gauge, 1)
    element = kind.value_type
    time, timed = points.of((3, FIXED64)).last()
    nanos = np.zeros(points.size, np.uint64)
    nanos[timed] = reader.words(time)
    value, has = points.of((4, FIXED64), (6, FIXED64)).last()
    real, whole = has.copy(), has.copy()
    real[has], whole[has] = value.number == 4, value.number == 6
    return _listed(kind, offsets, _structs(element, {
        "attributes": _attributes(reader, points, 7, element.field("attributes").type),
        "time_unix_nano": pa.array(nanos.view(np.int64)),
        "as_double": _numbers(reader.words(value.pick(value.number == 4)), real, "float64"),
        "as_int": _numbers(reader.words(value.pick(value.number == 6)), whole, "int64")}))


def _metrics(reader: Reader, scopes: Fields, kind: pa.ListType) -> pa.Array:
    metrics, offsets = reader.repeated(scopes, 2)
    gauge_kind = kind.value_type.field("gauge").type
    data = metrics.of(*[(number, BYTES) for number in (5, 7, 9, 10, 11)])
    other = data.number != 5
    reader.single(data.pick(other))
    for number in (2, 3):  # text that is not kept must be sound all the same
        reader.texts(*metrics.of((number, BYTES)).last(), b"")
    # A gauge in front of another kind of data is gone.
    gone = np.full(metrics.size, -1)
    gone[data.row[other]] = np.flatnonzero(other)
    gauge = data.pick(~other & (np.arange(len(other)) > gone[data.row]))
    missing = np.diff(gauge.offsets()) == 0
    points = _points(reader, reader.single(gauge), gauge_kind.field("data_points").type)
    return _listed(kind, offsets, _structs(kind.value_type, {
        "name": reader.texts(*metrics.of((1, BYTES)).last(), b""),
        "gauge": _structs(gauge_kind, {"data_points": points}, missing)}))


def resource_metrics(values: pa.Array, kind: pa.ListType) -> pa.Array:
    """The resources of each batch of ``values``, null where it cannot be read.

    Arrow delivers thousands of messages at once; they are read in runs of about
    ``RUN_BYTES``, as what is held meanwhile is many times as large.
    """
    runs = [_read(run, kind) for run in _runs(values)]
    return runs[0] if len(runs) == 1 else pa.concat_arrays(runs)


def _runs(values: pa.Array) -> list[pa.Array]:
    """``values`` in runs that begin within the same ``RUN_BYTES`` of the bytes."""
    sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // RUN_BYTES
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    stops = np.append(starts[1:], len(values))
    return [values.slice(a, b - a) for a, b in zip(starts.tolist(), stops.tolist())] or [values]


def _read(values: pa.Array, kind: pa.ListType) -> pa.Array:
    reader = Reader(values)
    everyone = np.arange(reader.size)
    batches = reader.fields(reader.low, reader.high, everyone, reader.size, everyone)
    resources, offsets = reader.repeated(batches, 1)
    element = kind.value_type
    scope_kind = element.field("scope_metrics").type
    scopes, scope_offsets = reader.repeated(resources, 2)
    nested = _structs(element, {
        "resource": _structs(element.field("resource").type, {"attributes": _attributes(
            reader, reader.single(resources.of((1, BYTES))), 1, element.field("resource").type.field("attributes").type)}),
        "scope_metrics": _listed(scope_kind, scope_offsets, _structs(scope_kind.value_type, {
            "metrics": _metrics(reader, scopes, scope_kind.value_type.field("metrics").type)}))})
    return _listed(kind, offsets, nested, reader.unsound)


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, kind: int, value: bytes) -> bytes:
    size = _varint(len(value)) if kind == BYTES else b""
    return _varint(number << 3 | kind) + size + value


def _coded_attributes(number: int, attributes: list[dict] | None) -> bytes:
    out = b""
    for entry in attributes or []:
        given = entry["value"] or {}
        value = b""
        if given.get("string_value") is not None:
            value = _field(1, BYTES, given["string_value"].encode())
        elif given.get("int_value") is not None:
            value = _field(3, VARINT, _varint(given["int_value"] % 2**64))
        elif given.get("double_value") is not None:
            value = _field(4, FIXED64, struct.pack("<d", given["double_value"]))
        elif given.get("bool_value") is not None:
            value = _field(2, VARINT, _varint(given["bool_value"]))
        key = _field(1, BYTES, entry["key"].encode()) if entry["key"] else b""
        out += _field(number, BYTES, key + _field(2, BYTES, value))
    return out


def _coded_point(point: dict) -> bytes:
    out = _coded_attributes(7, point["attributes"])
    if point["time_unix_nano"]:
        out += _field(3, FIXED64, struct.pack("<q", point["time_unix_nano"]))
    if point["as_double"] is not None:
        return out + _field(4, FIXED64, struct.pack("<d", point["as_double"]))
    return out + (_field(6, FIXED64, struct.pack("<q", point["as_int"])) if point["as_int"] is not None else b"")


def all_coded(values: pa.Array) -> pa.Array:
    """Bytes of each batch; only a few are Python objects at a time."""
    parts = (values.slice(at, CODED_ROWS).to_pylist() for at in range(0, len(values), CODED_ROWS))
    return pa.array((coded(v) for part in parts for v in part), type=pa.binary(), size=len(values))


def coded(resources: list[dict] | None) -> bytes:
    """One batch from the rows of its resources; for tests and made-up input, row by row."""
    out = b""
    for entry in resources or []:
        scopes = b""
        for scope in entry["scope_metrics"] or []:
            metrics = b""
            for metric in scope["metrics"] or []:
                data = _field(1, BYTES, metric["name"].encode()) if metric["name"] else b""
                if metric["gauge"] is not None:
                    points = metric["gauge"]["data_points"] or []
                    data += _field(5, BYTES, b"".join(_field(1, BYTES, _coded_point(p)) for p in points))
                metrics += _field(2, BYTES, data)
            scopes += _field(2, BYTES, metrics)
        own = _coded_attributes(1, (entry["resource"] or {}).get("attributes"))
        out += _field(1, BYTES, _field(1, BYTES, own) + scopes)
    return out
