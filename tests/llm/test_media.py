import hashlib
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import media, media_table


@settings(max_examples=80, deadline=None)
@given(st.binary(min_size=1, max_size=900))
def test_round_trip(data):
    stream = media.mux(data)
    m = media.demux(stream)
    assert len(stream) % 188 == 0 and m.skipped == m.bad_sections == 0
    (s,) = m.streams
    assert s.payload == data and (s.pid, s.program, s.stream_type, s.gaps) == (0x100, 1, 6, 0)


def test_long_payload_has_units_stamps_and_random_access():
    data = bytes(range(256)) * 2_000
    (s,) = media.demux(media.mux(data)).streams
    assert s.payload == data and s.units == 16
    assert s.pts == [90_000 + 3_600 * k for k in range(16)]
    assert s.random_access == [0, 8] and s.offsets[8] == 8 * media.UNIT


def test_lost_doubled_and_broken_packets():
    stream = media.mux(b"x" * 5_000)
    p = [stream[i : i + 188] for i in range(0, len(stream), 188)]
    assert media.demux(b"".join(p[:6] + p[7:])).streams[0].gaps == 1
    twice = media.demux(b"".join(p[:6] + [p[5]] + p[6:])).streams[0]
    assert (twice.gaps, twice.duplicates, twice.payload) == (0, 1, b"x" * 5_000)
    bad = media.demux(b"".join([*p[:6], b"\0" * 188, *p[6:]]))
    assert bad.skipped == 1 and bad.streams[0].payload == b"x" * 5_000
    assert media.demux(b"junk" + stream).streams[0].payload == b"x" * 5_000
    assert media.demux(stream[188:]).streams == []  # no association table
    broken = bytearray(stream)
    broken[200] ^= 1
    assert media.demux(bytes(broken)).bad_sections == 1
    assert media.demux(None).packets == media.demux(b"").packets == 0 and media.demux(b"abc" * 100).streams == []


def test_crc_is_the_standard_one():
    assert media.crc32_mpeg(b"123456789") == 0x0376E6E7


def test_odd_rows(odd, empty, odd_rows):
    got = media_table.digests(media_table.store(odd)).collect()
    want = []
    for r in odd_rows:
        b = (r.text or "").encode()
        padded = b + b"\0" * (-len(b) % 64 or (0 if b else 64))
        want.append((r.doc_id, len(b), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:])))
    assert sorted(((r.id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got), key=str) == sorted(want, key=str)
    assert len({r.media_sha256 for r in got}) == len({r.text or "" for r in odd_rows})
    assert media_table.digests(media_table.store(empty)).collect() == []


def test_streams_of_a_column(spark):
    df = spark.createDataFrame([(1, media.mux(b"abc")), (2, None), (3, b"junk")], "id int, media binary")
    got = media_table.streams(df).collect()
    assert [(r.id, r.pid, bytes(r.payload), r.pts) for r in got] == [(1, 0x100, b"abc", [90_000])]
