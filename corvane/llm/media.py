"""Media columns: MPEG transport streams written from and read back to binary payloads.

``write_streams`` puts a payload into one program of a transport stream (188-byte packets): program
tables with checksums, access units as packetised elementary packets with presentation times, and a
random-access mark with a clock reference at every unit that can be entered. ``read_streams`` parses
such streams: program association and map tables, continuity counters, adaptation fields and
elementary packets of all programs and streams, and returns the payload with the time line of its
units. Both are mapped where the rows lie and work on whole arrays of packets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BINARY, LONG, mapped, schema

PACKET, SYNC = 188, 0x47  # fixed values of the format
PAT_PID, PMT_PID, DATA_PID, PROGRAM, PRIVATE_DATA = 0x0000, 0x1000, 0x0100, 1, 0x06
UNIT, CLOCK, STEP = 16_384, 90_000, 3_003  # bytes of an access unit; ticks a second; ticks a unit
ENTRY = 4  # every how many units a random-access point stands


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        r = i << 24
        for _ in range(8):
            r = ((r << 1) ^ 0x04C11DB7 if r & 0x80000000 else r << 1) & 0xFFFFFFFF
        out.append(r)
    return out


_CRC = _crc_table()


def section_crc(data: bytes) -> int:
    r = 0xFFFFFFFF
    for b in data:
        r = ((r << 8) & 0xFFFFFFFF) ^ _CRC[(r >> 24) ^ b]
    return r


def _table_packet(pid: int, table: int, number: int, body: bytes) -> bytes:
    length = 5 + len(body) + 4
    section = bytes([table, 0xB0 | length >> 8, length & 255, number >> 8, number & 255, 0xC1, 0, 0]) + body
    section += section_crc(section).to_bytes(4, "big")
    packet = bytes([SYNC, 0x40 | pid >> 8, pid & 255, 0x10, 0]) + section
    return packet + b"\xff" * (PACKET - len(packet))


_PAT = _table_packet(PAT_PID, 0x00, 1, bytes([PROGRAM >> 8, PROGRAM & 255, 0xE0 | PMT_PID >> 8, PMT_PID & 255]))
_PMT = _table_packet(PMT_PID, 0x02, PROGRAM, bytes([0xE0 | DATA_PID >> 8, DATA_PID & 255, 0xF0, 0, PRIVATE_DATA, 0xE0 | DATA_PID >> 8, DATA_PID & 255, 0xF0, 0]))


def _time_bytes(ticks: int) -> bytes:
    t = ticks & (1 << 33) - 1
    return bytes([0x21 | t >> 29 & 0x0E, t >> 22 & 255, t >> 14 & 254 | 1, t >> 7 & 255, t << 1 & 254 | 1])


def write_stream(payload: bytes) -> bytes:
    """The payload as a transport stream; an empty payload has tables only."""
    parts, counter = [_PAT, _PMT], 0
    for number, at in enumerate(range(0, len(payload), UNIT)):
        data = payload[at : at + UNIT]
        unit = b"\x00\x00\x01\xbd" + (len(data) + 8).to_bytes(2, "big") + b"\x80\x80\x05" + _time_bytes(number * STEP) + data
        entry = number % ENTRY == 0
        field = b""
        if entry:
            clock = number * STEP
            field = bytes([0x50]) + (clock << 15 | 0x7E00).to_bytes(6, "big")
        room = PACKET - 4 - (len(field) + 1 if field else 0)
        first, rest = unit[:room], unit[room:]
        full, tail = divmod(len(rest), PACKET - 4)
        count = 1 + full + bool(tail)
        out = np.full((count, PACKET), 0xFF, np.uint8)
        out[:, 0], out[:, 1], out[:, 2] = SYNC, DATA_PID >> 8, DATA_PID & 255
        out[0, 1] |= 0x40
        out[:, 3] = 0x10 | (counter + np.arange(count)) & 15
        counter = (counter + count) & 15
        _fill(out[0], field, first)
        if full:
            out[1 : 1 + full, 4:] = np.frombuffer(rest, np.uint8, full * (PACKET - 4)).reshape(full, PACKET - 4)
        if tail:
            _fill(out[-1], b"", rest[-tail:])
        parts.append(out.tobytes())
    return b"".join(parts)


def _fill(packet: np.ndarray, field: bytes, data: bytes) -> None:
    """Puts data at the packet's end; an adaptation field takes the space before it."""
    spare = PACKET - 4 - len(data)
    if spare:
        packet[3] |= 0x20
        packet[4] = spare - 1
        if spare > 1:
            packet[5] = 0
            packet[5 : 5 + len(field)] = np.frombuffer(field, np.uint8)
    packet[PACKET - len(data) :] = np.frombuffer(data, np.uint8)


def _payload_starts(packets: np.ndarray) -> np.ndarray:
    """Where each packet's payload begins: after the header and the adaptation field, at most at its end."""
    return np.minimum(np.where(packets[:, 3] & 0x20 > 0, 5 + packets[:, 4].astype(np.int64), 4), PACKET)


def _without_repeats(packets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packets with payload of one id without those sent twice, and whether packets are missing before each.

    A repeat has its predecessor's counter and payload; a break that the packet itself announces is none.
    """
    packets = packets[packets[:, 3] & 0x10 > 0]
    if not len(packets):
        return packets, np.zeros(0, bool)
    counter, start = packets[:, 3] & 15, _payload_starts(packets)
    again = np.zeros(len(packets), bool)
    for k in (np.flatnonzero(counter[1:] == counter[:-1]) + 1).tolist():
        again[k] = start[k] == start[k - 1] and (packets[k, start[k] :] == packets[k - 1, start[k] :]).all()
    packets, counter = packets[~again], counter[~again].astype(np.int64)
    announced = (packets[:, 3] & 0x20 > 0) & (packets[:, 4] > 0) & (packets[:, 5] & 0x80 > 0)
    return packets, np.append(False, (np.diff(counter) & 15) != 1) & ~announced


def _whole(data: bytes) -> bytes:
    """The table section at the start of ``data`` if it is there to its end and its checksum holds."""
    size = 3 + ((data[1] & 15) << 8 | data[2]) if len(data) >= 3 else 0
    return data[:size] if 0 < size <= len(data) and section_crc(data[:size]) == 0 else b""


def _found_sections(packets: np.ndarray, pid: np.ndarray, wanted: int) -> Iterator[bytes]:
    """The whole table sections of this id in their order, each over as many packets as it takes."""
    own, missing = _without_repeats(packets[pid == wanted])
    data = b""  # what is not yet a whole section
    for packet, lost, start in zip(own, missing, _payload_starts(own)):
        raw = packet[start:].tobytes()
        if lost:
            data = b""
        if packet[1] & 0x40 and raw:  # a section begins; the first byte says after how many of the one before
            after = 1 + raw[0]
            if data and (found := _whole(data + raw[1:after])):
                yield found
            data = raw[after:]
        elif data:
            data += raw
        while found := _whole(data):  # several may stand one behind the other
            yield found
            data = data[len(found) :]


def _sections(packets: np.ndarray, pid: np.ndarray, wanted: int) -> list[bytes]:
    """A table's sections 0 to the last that it names, of the version that is whole first; else what is there of the version seen last."""
    held: dict[int, bytes] = {}
    version = None
    for found in _found_sections(packets, pid, wanted):
        if len(found) < 12:
            continue
        if found[5] != version:
            held, version = {}, found[5]
        held[found[6]] = found
        if len(held) > found[7]:
            break
    return [held[n] for n in sorted(held)]


def _units(own: np.ndarray, missing: np.ndarray, counts: dict[str, int]) -> tuple[list[bytes], list[tuple[int, bool, bool]]]:
    """Data of each access unit, and its time (-1: none), whether it can be entered, whether a part is missing."""
    skip = _payload_starts(own)
    marked = (own[:, 3] & 0x20 > 0) & (own[:, 4] > 0) & (own[:, 5] & 0x40 > 0)
    body = own[np.arange(PACKET) >= skip[:, None]].tobytes()
    place = np.concatenate([[0], np.cumsum(PACKET - skip)]).tolist()
    starts = np.flatnonzero(own[:, 1] & 0x40 > 0).tolist()
    if starts[:1] != [0]:
        counts["damaged"] += 1  # what stands before the first start belongs to no unit
    parts, met = [], []
    for k, stop in zip(starts, [*starts[1:], len(own)]):
        unit = body[place[k] : place[stop]]
        if len(unit) < 9 or unit[:3] != b"\x00\x00\x01":
            counts["damaged"] += 1
            continue
        length, head = unit[4] << 8 | unit[5], unit[8]
        t = unit[9:14]
        time = (t[0] & 0x0E) << 29 | t[1] << 22 | (t[2] & 254) << 14 | t[3] << 7 | t[4] >> 1 if unit[7] & 0x80 and len(t) == 5 else -1
        data = unit[9 + head : 6 + length if length else len(unit)]  # a length of 0: up to the next unit
        broken = bool(missing[k + 1 : stop].any() or stop < len(own) and missing[stop]) or bool(length) and len(unit) < 6 + length
        parts.append(data)
        met.append((time, bool(marked[k]), broken))
    return parts, met


def read_stream(media: bytes) -> tuple[bytes, list[tuple[int, bool, int, int, int, int, bool]], dict[str, int]]:
    """Payload, units, and counts of what was met.

    A unit: time (-1 if it has none), random access, payload start, length, program, packet id, and
    whether a part of it is missing. Units of all programs and of all their streams are read, one stream
    after the other; the payload is their data joined. A unit ends where its length says, and at the
    latest where the next one of its stream starts, so a lost packet never pulls in another unit's bytes;
    packets sent twice count once. Packets without the sync byte count as damaged and are skipped, and
    so do units without a start code; breaks in the continuity counters are counted; units that miss a
    part are counted as broken. Without a valid program table there is no payload.
    """
    counts = {"packets": len(media) // PACKET, "damaged": int(len(media) % PACKET > 0), "discontinuities": 0, "programs": 0, "broken": 0}
    packets = np.frombuffer(media, np.uint8, counts["packets"] * PACKET).reshape(-1, PACKET)
    good = packets[:, 0] == SYNC
    counts["damaged"] += int((~good).sum())
    packets = packets[good & (packets[:, 1] & 0x80 == 0)]
    pid = (packets[:, 1] & 0x1F).astype(np.int64) << 8 | packets[:, 2]
    maps = [(pat[i] << 8 | pat[i + 1], (pat[i + 2] & 0x1F) << 8 | pat[i + 3]) for pat in _sections(packets, pid, PAT_PID) for i in range(8, len(pat) - 4, 4) if pat[i] or pat[i + 1]]
    counts["programs"] = len(maps)
    parts, units, done, read = [], [], 0, set()
    for program, pmt in ((program, pmt) for program, map_pid in maps for pmt in _sections(packets, pid, map_pid) if pmt[3] << 8 | pmt[4] == program):
        at = 12 + ((pmt[10] & 15) << 8 | pmt[11]) if pmt else 0
        while at and at + 5 <= len(pmt) - 4:
            stream = (pmt[at + 1] & 0x1F) << 8 | pmt[at + 2]
            at += 5 + ((pmt[at + 3] & 15) << 8 | pmt[at + 4])
            own, missing = _without_repeats(packets[pid == stream])
            if stream in read or not len(own):  # programs may share a stream
                continue
            read.add(stream)
            counts["discontinuities"] += int(missing.sum())
            for data, (time, entry, broken) in zip(*_units(own, missing, counts)):
                parts.append(data)
                units.append((time, entry, done, len(data), program, stream, broken))
                counts["broken"] += broken
                done += len(data)
    return b"".join(parts), units, counts


def padded(text: str | None, block: int = 64) -> tuple[int, bytes]:
    """UTF-8 bytes of the text with zeros up to a positive multiple of ``block``, and their number before."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw.ljust(max(block, -(-len(raw) // block) * block), b"\0")


STREAMS = schema(doc_id=LONG, n_bytes=LONG, media=BINARY)


def write_streams(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes (of the unpadded text) and media (a transport stream) of every row of ``docs``.

    A null or empty text is 64 zero bytes; texts are stored whole; equal texts give equal streams;
    an empty table gives an empty result; further columns are ignored.
    """

    def work(frames):
        for frame in frames:
            found = [padded(t) for t in frame.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array([write_stream(p) for _, p in found], pa.binary())], names=STREAMS.names)

    return mapped(docs.select("doc_id", "text"), work, STREAMS)


UNITS = T.ArrayType(T.StructType([T.StructField("time", LONG), T.StructField("random_access", T.BooleanType()), *[T.StructField(n, LONG) for n in ("start", "length", "program", "pid")], T.StructField("broken", T.BooleanType())]))
COUNTS = ("packets", "damaged", "discontinuities", "programs", "broken")
READ = T.StructType([*schema(doc_id=LONG, n_bytes=LONG, media=BINARY, payload=BINARY, units=UNITS).fields, *[T.StructField(n, LONG) for n in COUNTS], T.StructField("entropy", T.DoubleType())])


def read_streams(streams: DataFrame) -> DataFrame:
    """The streams with payload, time line, counts of the parse and the payload's entropy in bits a byte.

    ``streams``: doc_id, n_bytes, media; other columns are ignored. A null, empty or damaged stream is a
    row with what could be read, an empty payload at the least; tables of several sections are read whole,
    and streams of any length; repeated rows are read alike; an empty table gives an empty result.
    """
    kind = pa.list_(pa.struct([("time", pa.int64()), ("random_access", pa.bool_()), *[(n, pa.int64()) for n in ("start", "length", "program", "pid")], ("broken", pa.bool_())]))

    def work(frames):
        for frame in frames:
            payloads, lines, counts, entropy = [], [], [], []
            for media in frame.column("media").to_pylist():
                payload, units, met = read_stream(media or b"")
                share = np.bincount(np.frombuffer(payload, np.uint8), minlength=1) / max(1, len(payload))
                share = share[share > 0]
                payloads.append(payload)
                lines.append([dict(zip(("time", "random_access", "start", "length", "program", "pid", "broken"), u)) for u in units])
                counts.append(met)
                entropy.append(float(-(share * np.log2(share)).sum()) + 0.0)
            columns = [frame.column(c) for c in STREAMS.names] + [pa.array(payloads, pa.binary()), pa.array(lines, kind)]
            columns += [pa.array([c[k] for c in counts], pa.int64()) for k in COUNTS] + [pa.array(entropy, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=READ.names)

    return mapped(streams.select(*STREAMS.names), work, READ)


def digest(docs: DataFrame) -> DataFrame:
    """Writes and reads back every text of ``docs`` (doc_id, text) and describes both forms, one row a document.

    A null or empty text is stored as 64 zero bytes; texts of any length are stored whole; equal texts
    and repeated rows give equal values; a null id stays null; an empty table gives an empty result;
    further columns are ignored.
    """
    read = read_streams(write_streams(docs))
    points = F.size(F.filter("units", lambda u: u["random_access"]))
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, greatest(octet_length(payload) - 63, 1), 64)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.format_string("packets=%d;programs=%d;units=%d;random_access=%d;last_time=%d;discontinuities=%d;entropy=%.4f", "packets", "programs", F.size("units"), points, F.coalesce(F.array_max(F.transform("units", lambda u: u["time"])), F.lit(-1)), "discontinuities", "entropy").alias("feature"),
    )
