"""MPEG transport streams as a media column: multiplexing, program tables, demultiplexing.

``mux`` stores a payload losslessly as the single elementary stream (private data) of a
program: a program association table, a program map table, then one packetized
elementary packet (PES) for each access unit, cut into 188-byte transport packets with
continuity counters.  The first transport packet of a unit carries an adaptation field
with a clock reference and, for the first unit and every eighth after it, the
random-access flag; the last one is filled up by its adaptation field.

``demux`` reads any transport stream: it finds packet alignment, parses the program
tables (with their CRC-32/MPEG-2), checks continuity counters per PID (a duplicate
packet is dropped, a gap is counted, a signalled discontinuity is accepted), reassembles
the PES packets and returns timestamps and random-access points with byte offsets.
Fields are read by numpy over all packets at once; loops run over sections and PES
packets only.

Defined results: null or empty bytes have no packets; bytes that are no transport stream
have no programs; a packet with the error flag, without sync byte or cut short is
skipped and counted; streams that no program table names are left out.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np

PACKET, SYNC, NULL_PID = 188, 0x47, 0x1FFF
PMT_PID, DATA_PID, PROGRAM, PRIVATE_DATA = 0x1000, 0x0100, 1, 0x06
#: Payload bytes of an access unit, 90 kHz ticks between units, units between random-access points.
UNIT, TICKS, RANDOM_ACCESS = 32_768, 3_600, 8
FIRST_PTS = 90_000


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def _section(table_id: int, extension: int, body: bytes) -> bytes:
    head = struct.pack(">BHHBBB", table_id, 0xB000 | len(body) + 9, extension, 0xC1, 0, 0)
    return head + body + struct.pack(">I", crc32_mpeg(head + body))


def _table_packet(pid: int, section: bytes) -> bytes:
    return (struct.pack(">BHBB", SYNC, 0x4000 | pid, 0x10, 0) + section).ljust(PACKET, b"\xff")


_TABLES = _table_packet(0, _section(0, 1, struct.pack(">HH", PROGRAM, 0xE000 | PMT_PID))) + _table_packet(
    PMT_PID, _section(2, PROGRAM, struct.pack(">HHBHH", 0xE000 | DATA_PID, 0xF000, PRIVATE_DATA, 0xE000 | DATA_PID, 0xF000))
)


def _stamp(pts: int) -> bytes:
    return struct.pack(">BHH", 0x21 | pts >> 29 & 0x0E, pts >> 14 & 0xFFFE | 1, pts << 1 & 0xFFFE | 1)


def mux(payload: bytes) -> bytes:
    out, counter = [_TABLES], 0
    for k, at in enumerate(range(0, len(payload), UNIT)):
        unit = payload[at : at + UNIT]
        pts = FIRST_PTS + k * TICKS
        size = len(unit) + 8
        pes = struct.pack(">IHBBB", 0x1BD, size if size < 65_536 else 0, 0x84, 0x80, 5) + _stamp(pts) + unit
        pcr = (pts - FIRST_PTS) << 15 | 0x7E00
        first = struct.pack(">BB", 7, 0x10 | 0x40 * (k % RANDOM_ACCESS == 0)) + pcr.to_bytes(6, "big")
        n = 1 + max(0, -(-(len(pes) - 176) // 184))
        packets = np.full((n, PACKET), 0xFF, np.uint8)
        packets[:, 0], packets[:, 1], packets[:, 2] = SYNC, DATA_PID >> 8, DATA_PID & 0xFF
        packets[0, 1] |= 0x40
        packets[:, 3] = 0x10 | (counter + np.arange(n)) & 15
        counter += n
        packets[0, 3] |= 0x20
        packets[0, 4:12] = np.frombuffer(first, np.uint8)
        data = np.frombuffer(pes, np.uint8)
        if n == 1:
            fill = 176 - len(pes)
            packets[0, 4] += fill
            packets[0, 12 + fill :] = data
        else:
            packets[0, 12:] = data[:176]
            whole = n - 2
            packets[1 : 1 + whole, 4:] = data[176 : 176 + 184 * whole].reshape(whole, 184)
            rest = data[176 + 184 * whole :]
            fill = 184 - len(rest)
            if fill:
                packets[n - 1, 3] |= 0x20
                packets[n - 1, 4] = fill - 1
                if fill > 1:
                    packets[n - 1, 5] = 0
            packets[n - 1, 4 + fill :] = rest
        out.append(packets.tobytes())
    return b"".join(out)


@dataclass
class Stream:
    pid: int
    stream_type: int
    program: int
    payload: bytes = b""
    units: int = 0
    gaps: int = 0
    duplicates: int = 0
    pts: list[int] = field(default_factory=list)
    offsets: list[int] = field(default_factory=list)  # in the payload, of each unit
    random_access: list[int] = field(default_factory=list)  # numbers of units


@dataclass
class Media:
    packets: int = 0
    skipped: int = 0
    bad_sections: int = 0
    programs: dict[int, int] = field(default_factory=dict)  # program to the PID of its map
    streams: list[Stream] = field(default_factory=list)


def _sections(data: np.ndarray, lo: np.ndarray, start: np.ndarray, media: Media):
    """Whole sections, with a right CRC, of one PID's packets."""
    held = b""
    for row, at, begins in zip(data, lo.tolist(), start.tolist()):
        part = row[at:].tobytes()
        if begins and part:
            pointer = part[0]
            held = (held + part[1 : 1 + pointer], part[1 + pointer :])
        else:
            held = (held + part,) if held else ()
        for i, buffer in enumerate(held):
            while len(buffer) >= 3 and buffer[0] != 0xFF:
                size = 3 + ((buffer[1] & 0x0F) << 8 | buffer[2])
                if len(buffer) < size:
                    break
                if size >= 12 and crc32_mpeg(buffer[:size]) == 0:
                    yield buffer[:size]
                else:
                    media.bad_sections += 1
                buffer = buffer[size:]
            else:
                buffer = b""
        held = buffer if held else b""


def _pes(stream: Stream, raw: bytes, random: bool) -> bytes:
    if len(raw) < 9 or raw[:3] != b"\0\0\1":
        return b""
    size = int.from_bytes(raw[4:6], "big")
    body = raw[6 : 6 + size] if size else raw[6:]
    pts = -1
    if body[1] & 0x80 and len(body) >= 8:
        a, b, c = struct.unpack(">BHH", body[3:8])
        pts = (a >> 1 & 7) << 30 | (b >> 1) << 15 | c >> 1
    stream.pts.append(pts)
    if random:
        stream.random_access.append(stream.units)
    stream.units += 1
    return body[3 + body[2] :]


def demux(raw: bytes | None) -> Media:
    media = Media()
    if not raw:
        return media
    data = np.frombuffer(raw, np.uint8)
    first = next((i for i in range(min(PACKET, len(data))) if (data[i::PACKET][:5] == SYNC).all()), 0)
    n = (len(data) - first) // PACKET
    data = data[first : first + n * PACKET].reshape(n, PACKET)
    good = (data[:, 0] == SYNC) & (data[:, 1] & 0x80 == 0)
    media.packets, media.skipped = n, int(n - good.sum())
    data = data[good]
    pid = (data[:, 1] & 0x1F).astype(np.int64) << 8 | data[:, 2]
    start, control, counter = data[:, 1] & 0x40 > 0, data[:, 3] >> 4 & 3, data[:, 3] & 15
    field_size = np.where(control & 2, data[:, 4].astype(np.int64) + 1, 0)
    flags = np.where(field_size > 1, data[:, 5], 0)
    lo = 4 + field_size
    carries = (control & 1 > 0) & (lo < PACKET)
    of = lambda p: np.flatnonzero((pid == p) & carries)
    i = of(0)
    for s in _sections(data[i], lo[i], start[i], media):
        if s[0] == 0:
            for program, at in struct.iter_unpack(">HH", s[8 : 8 + (len(s) - 12) // 4 * 4]):
                if program:
                    media.programs[program] = at & NULL_PID
    named: dict[int, Stream] = {}
    for program, at in media.programs.items():
        i = of(at)
        for s in _sections(data[i], lo[i], start[i], media):
            if s[0] == 2 and s[3:5] == struct.pack(">H", program):
                k = 12 + (int.from_bytes(s[10:12], "big") & 0x0FFF)
                while k + 5 <= len(s) - 4:
                    kind, p, info = struct.unpack(">BHH", s[k : k + 5])
                    named.setdefault(p & NULL_PID, Stream(p & NULL_PID, kind, program))
                    k += 5 + (info & 0x0FFF)
    for p, stream in sorted(named.items()):
        i = of(p)
        if len(i):
            step = (counter[i][1:].astype(int) - counter[i][:-1]) & 15
            same = (step == 0) & (data[i][1:, 4:] == data[i][:-1, 4:]).all(axis=1)
            signalled = (flags[i][1:] & 0x80) > 0
            stream.duplicates, stream.gaps = int(same.sum()), int(((step != 1) & ~same & ~signalled).sum())
            i = i[np.concatenate([[True], ~same])]
        begins = np.flatnonzero(start[i])
        parts, offset = [], 0
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(i)]):
            rows = data[i[a:b]]
            keep = np.arange(PACKET) >= lo[i[a:b], None]
            part = _pes(stream, rows[keep].tobytes(), bool(flags[i[a]] & 0x40))
            if stream.units > len(stream.offsets):
                stream.offsets.append(offset)
            offset += len(part)
            parts.append(part)
        stream.payload = b"".join(parts)
        media.streams.append(stream)
    return media


def padded(text: str | None, unit: int = 64) -> bytes:
    """UTF-8 with zeros up to a positive multiple of ``unit``."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + b"\0" * (-len(data) % unit or (0 if data else unit))


def feature(media: Media) -> str:
    """Program, timing and access structure of the streams as text."""
    parts = [f"packets={media.packets} skipped={media.skipped} bad_sections={media.bad_sections}"]
    for s in media.streams:
        span = s.pts[-1] - s.pts[0] if s.pts else 0
        entry = ",".join(f"{u}@{s.offsets[u]}" for u in s.random_access[:4])
        parts.append(
            f"program={s.program} pid={s.pid} type={s.stream_type} units={s.units} gaps={s.gaps} duplicates={s.duplicates} "
            f"pts_span={span} random_access={len(s.random_access)} first={entry} bytes={len(s.payload)}"
        )
    return "; ".join(parts)
