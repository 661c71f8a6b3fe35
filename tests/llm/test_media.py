import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corvane.llm import media as M


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=3000))
def test_round_trip(payload):
    stream = M.write_stream(payload)
    back, units, counts = M.read_stream(stream)
    assert back == payload and len(stream) % 188 == 0 and all(stream[i] == 0x47 for i in range(0, len(stream), 188))
    assert counts["damaged"] == counts["discontinuities"] == 0 and counts["programs"] == 1


def test_every_packet_boundary():
    for n in [*range(1, 600), M.UNIT - 1, M.UNIT, M.UNIT + 1, 5 * M.UNIT + 7]:
        payload = random.Random(n).randbytes(n)
        assert M.read_stream(M.write_stream(payload))[0] == payload


def test_time_line_and_entries():
    _, units, _ = M.read_stream(M.write_stream(bytes(9 * M.UNIT)))
    assert [u[0] for u in units] == [i * M.STEP for i in range(9)]
    assert [u[1] for u in units] == [i % M.ENTRY == 0 for i in range(9)]
    assert [u[2] for u in units] == [i * M.UNIT for i in range(9)]


def test_time_wraps_at_33_bits():
    for ticks in (0, 1, 2**33 - 1, 2**33 + 5, 123456789012):
        t = M._time_bytes(ticks)
        assert (t[0] & 0x0E) << 29 | t[1] << 22 | (t[2] & 254) << 14 | t[3] << 7 | t[4] >> 1 == ticks % 2**33


def test_damage_is_counted():
    stream = bytearray(M.write_stream(bytes(3000)))
    lost = bytes(stream[: 188 * 5] + stream[188 * 6 :])
    assert M.read_stream(lost)[2]["discontinuities"] == 1
    stream[188 * 4] = 0
    assert M.read_stream(bytes(stream))[2]["damaged"] == 1
    stream = bytearray(M.write_stream(b"x" * 100))
    stream[10] ^= 255  # the association table's checksum fails
    assert M.read_stream(bytes(stream))[:2] == (b"", [])
    assert M.read_stream(b"")[0] == b"" and M.read_stream(b"junk" * 100)[0] == b""


def _pieces(stream):
    return [stream[i : i + 188] for i in range(0, len(stream), 188)]


def test_packets_sent_twice_count_once():
    payload = random.Random(1).randbytes(3 * M.UNIT + 100)
    packets = _pieces(M.write_stream(payload))
    for k in (0, 1, 2, 3, 50, len(packets) - 1):
        back, units, counts = M.read_stream(b"".join(packets[: k + 1] + packets[k:]))
        assert back == payload and counts["discontinuities"] == counts["broken"] == 0 and not any(u[6] for u in units)


def test_a_lost_packet_touches_its_own_unit_only():
    payload = random.Random(2).randbytes(4 * M.UNIT)
    packets = _pieces(M.write_stream(payload))
    starts = [i for i, p in enumerate(packets) if i > 1 and p[1] & 0x40]
    for lost, unit in ((starts[1] + 5, 1), (starts[2] - 1, 1), (len(packets) - 1, 3), (starts[2], None)):
        back, units, counts = M.read_stream(b"".join(packets[:lost] + packets[lost + 1 :]))
        whole = {u[0] // M.STEP: back[u[2] : u[2] + u[3]] for u in units if not u[6]}
        assert all(data == payload[n * M.UNIT : (n + 1) * M.UNIT] for n, data in whole.items())
        assert counts["discontinuities"] == (lost != len(packets) - 1) and counts["broken"] == 1
        assert set(whole) == {0, 1, 2, 3} - ({1, 2} if unit is None else {unit})


def test_a_unit_without_a_length_runs_to_the_next():
    payload = random.Random(3).randbytes(3 * M.UNIT + 9)
    packets = [bytearray(p) for p in _pieces(M.write_stream(payload))]
    for p in packets[2:]:
        if p[1] & 0x40:
            at = 4 + (1 + p[4] if p[3] & 0x20 else 0)
            p[at + 4] = p[at + 5] = 0
    back, units, counts = M.read_stream(b"".join(map(bytes, packets)))
    assert back == payload and len(units) == 4 and counts["broken"] == 0


def test_programs_streams_and_sections_over_packets():
    one, two = random.Random(4).randbytes(20_000), random.Random(5).randbytes(700)
    first, second = _pieces(M.write_stream(one))[2:], []
    for p in _pieces(M.write_stream(two))[2:]:
        p = bytearray(p)
        p[1], p[2] = p[1] & 0xE0 | 0x02, 0x22
        second.append(bytes(p))
    section = bytes([0, 0xB0, 5 + 4 * 60 + 4, 0, 1, 0xC1, 0, 0]) + b"".join(bytes([0, n, 0xE1, n]) for n in range(1, 61))
    section += M.section_crc(section).to_bytes(4, "big")
    tables = [bytes([0x47, 0x40, 0, 0x10, 0]) + section[:183], (bytes([0x47, 0, 0, 0x11]) + section[183:]).ljust(188, b"\xff")]
    maps = []
    for n, pids in ((1, [0x100]), (7, [0x222, 0x100])):
        body = bytes([0xE1, 0, 0xF0, 0]) + b"".join(bytes([6, 0xE0 | pid >> 8, pid & 255, 0xF0, 0]) for pid in pids)
        maps.append(M._table_packet(0x100 | n, 2, n, body))
    mixed = tables + maps + [p for pair in zip(first, second) for p in pair] + first[len(second) :] + second[len(first) :]
    back, units, counts = M.read_stream(b"".join(mixed))
    assert back == one + two and counts["programs"] == 60 and counts["discontinuities"] == counts["broken"] == 0
    assert [(u[4], u[5]) for u in units] == [(1, 0x100)] * 2 + [(7, 0x222)]


@pytest.mark.parametrize("order", [(0, 1), (1, 0), (1, 1, 0)])
def test_tables_of_several_sections(order):
    """Programs 1 to 3 in the first section, 4 to 6 in the second, both in one packet or in several; the map of program 5 has two sections."""
    payload = random.Random(6).randbytes(30_000)
    data = _pieces(M.write_stream(payload))[2:]

    def section(kind, number, n, body):
        head = bytes([kind, 0xB0, len(body) + 9]) + number.to_bytes(2, "big") + bytes([0xC1, n, 1])
        return head + body + M.section_crc(head + body).to_bytes(4, "big")

    def packets(pid, sections):
        return [bytes([0x47, 0x40 | pid >> 8, pid & 255, 0x10 | k & 15, 0]) + s.ljust(183, b"\xff") for k, s in enumerate(sections)]

    pats = [section(0, 1, n, b"".join(bytes([0, p, 0xE1, p]) for p in range(3 * n + 1, 3 * n + 4))) for n in (0, 1)]
    stream = lambda pid: bytes([6, 0xE0 | pid >> 8, pid & 255, 0xF0, 0])
    maps = [section(2, 5, n, bytes([0xE1, 0, 0xF0, 0]) + stream(pid)) for n, pid in ((0, 0x333), (1, 0x100))]
    joined = b"".join(pats[n] for n in order)
    for tables in (packets(0, [pats[n] for n in order]), packets(0, [joined])):
        back, units, counts = M.read_stream(b"".join(tables + packets(0x105, maps) + data))
        assert back == payload and counts["programs"] == 6 and {u[4] for u in units} == {5}


def test_known_checksum():
    assert M.section_crc(b"123456789") == 0x0376E6E7


def test_whole_table(few_docs):
    rows = {r["doc_id"]: r for r in M.digest(few_docs).collect()}
    for d in few_docs.collect():
        raw = d["text"].encode()
        p = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        r, stream = rows[d["doc_id"]], M.write_stream(p)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(stream), hashlib.sha256(stream).hexdigest())


def test_edges(edge_docs, no_docs):
    rows = M.digest(edge_docs).collect()
    assert len(rows) == 9 and {r["payload_bytes"] for r in rows if r["doc_id"] in (1, 2)} == {64} and M.digest(no_docs).count() == 0
    assert len({tuple(r) for r in rows if r["doc_id"] == 4}) == 1
