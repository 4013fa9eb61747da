"""Hand-made streams: tags of each version, tables, mixed rates, layers, checksums."""

import random
import zlib
from fractions import Fraction

import pytest

from spanwright.llm import mpeg


def synchsafe(n):
    return bytes((n >> s) & 0x7F for s in (21, 14, 7, 0))


def frame(rate=0, bitrate=9, version=3, layer=3, mode=3, body=b"", protect=False):
    head = bytes((0xFF, 0xE0 | version << 3 | (4 - layer) << 1 | (not protect), bitrate << 4 | rate << 2, mode << 6))
    h = mpeg.Header.of(head)
    rest = bytes(2 if protect else 0) + bytes(h.side) + body
    return (head + rest).ljust(h.size, b"\x00")[: h.size]


def v24(fields, flags=0, extended=b""):
    body = extended + b"".join(n.encode() + synchsafe(len(b)) + f + b for n, f, b in fields)
    return b"ID3\x04\x00" + bytes([flags]) + synchsafe(len(body)) + body


def v23(fields, flags=0, extended=b"", unsync=False):
    body = extended + b"".join(n.encode() + len(b).to_bytes(4, "big") + f + b for n, f, b in fields)
    body = body.replace(b"\xff", b"\xff\x00") if unsync else body
    return b"ID3\x03\x00" + bytes([flags]) + synchsafe(len(body)) + body


def v22(fields, flags=0):
    body = b"".join(n.encode() + len(b).to_bytes(3, "big") + b for n, b in fields)
    return b"ID3\x02\x00" + bytes([flags]) + synchsafe(len(body)) + body


NO = b"\x00\x00"
LONG = "x" * 199


@pytest.mark.parametrize(("tag", "want"), [
    (v23([("TIT2", NO, b"\x00" + LONG.encode()), ("TPE1", NO, b"\x03artist")]), {"TIT2": LONG, "TPE1": "artist"}),
    (v24([("TIT2", NO, b"\x00" + LONG.encode()), ("TPE1", NO, b"\x03artist")]), {"TIT2": LONG, "TPE1": "artist"}),
    (v22([("TT2", b"\x00title"), ("TP1", b"\x01" + "bänd".encode("utf-16")), ("TXX", b"\x00key\x00value")]), {"TIT2": "title", "TPE1": "bänd", "key": "value"}),
    (v23([("TIT2", NO, b"\x00title")], 0x40, (6).to_bytes(4, "big") + bytes(6)), {"TIT2": "title"}),
    (v24([("TIT2", NO, b"\x00title")], 0x40, synchsafe(6) + b"\x01\x00"), {"TIT2": "title"}),
    (v23([("TIT2", NO, b"\x01" + "﻿ÿ".encode("utf-16-le")), ("TPE1", NO, b"\x00ab")], 0x80, unsync=True), {"TIT2": "ÿ", "TPE1": "ab"}),
    (v24([("TIT2", b"\x00\x02", (b"\x01" + "﻿ÿ".encode("utf-16-le")).replace(b"\xff", b"\xff\x00")), ("TPE1", NO, b"\x00ab")]), {"TIT2": "ÿ", "TPE1": "ab"}),
    (v23([("TIT2", b"\x00\x80", (6).to_bytes(4, "big") + zlib.compress(b"\x00title"))]), {"TIT2": "title"}),
    (v24([("TIT2", b"\x00\x09", synchsafe(6) + zlib.compress(b"\x00title"))]), {"TIT2": "title"}),
    (v24([("TIT2", b"\x00\x04", b"secret"), ("TPE1", b"\x00\x40", b"g\x00ab")]), {"TPE1": "ab"}),
    (v23([("TXXX", NO, b"\x01" + "k".encode("utf-16") + b"\x00\x00" + "v".encode("utf-16"))]), {"k": "v"}),
    (v22([("TT2", b"\x00title")], 0x40), {}),
])
def test_tags_of_each_version(tag, want):
    stream = mpeg.read_stream(tag + frame() * 3)
    assert stream["tags"] == want and len(stream["offsets"]) == 3 and stream["skipped"] == 0


def test_tags_at_the_end():
    item = (5).to_bytes(4, "little") + bytes(4) + b"Title\x00" + b"a-tag"
    footer = b"APETAGEX" + (2000).to_bytes(4, "little") + (len(item) + 32).to_bytes(4, "little") + (1).to_bytes(4, "little") + bytes(12)
    old = b"TAG" + b"title".ljust(30, b"\x00") + b"band".ljust(30, b"\x00") + bytes(65)
    stream = mpeg.read_stream(frame() * 4 + item + footer + old)
    assert stream["tags"] == {"Title": "a-tag", "TIT2": "title", "TPE1": "band"} and len(stream["offsets"]) == 4 and stream["skipped"] == 0


def test_durations_are_exact_for_mixed_rates():
    data = frame(rate=0) * 10 + frame(rate=2) * 10
    stream = mpeg.read_stream(data)
    assert stream["duration"] == Fraction(11520, 44100) + Fraction(11520, 32000) and stream["rates"] == {32000: 11520, 44100: 11520}
    assert mpeg.read_stream(b"")["duration"] == 0


@pytest.mark.parametrize(("layer", "version", "samples"), [(1, 3, 384), (2, 3, 1152), (3, 3, 1152), (1, 2, 384), (2, 2, 1152), (3, 2, 576), (3, 0, 576)])
def test_frames_of_each_layer_and_version(layer, version, samples):
    data = frame(layer=layer, version=version, bitrate=5) * 7
    stream = mpeg.read_stream(data)
    assert (len(stream["offsets"]), stream["samples"], stream["skipped"], stream["layers"]) == (7, 7 * samples, 0, [layer])


def test_first_layer_checksums():
    for mode, covered in ((3, 16), (0, 32), (1, 18)):
        data = bytearray(frame(layer=1, mode=mode, protect=True))
        data[4:6] = mpeg.crc16(bytes(data[2:4] + data[6 : 6 + covered])).to_bytes(2, "big")
        stream = mpeg.read_stream(bytes(data) * 2)
        assert (stream["checked"], stream["bad"]) == (2, 0), mode
        data[8] ^= 4
        assert mpeg.read_stream(bytes(data) * 2)["bad"] == 2


def test_seek_table_of_the_other_kind():
    frames = [frame(bitrate=b) for b in (5, 9, 7, 12, 9, 9, 10, 5)]
    head = frame(bitrate=9, mode=0)
    sizes = [len(head) + len(frames[0]) + len(frames[1]), len(frames[2]) + len(frames[3]), len(frames[4]) + len(frames[5]), len(frames[6]) + len(frames[7])]
    total = len(head) + sum(map(len, frames))
    for wide in (2, 4):
        body = b"VBRI" + bytes(6) + total.to_bytes(4, "big") + (8).to_bytes(4, "big") + (4).to_bytes(2, "big") + (1).to_bytes(2, "big") + wide.to_bytes(2, "big") + (2).to_bytes(2, "big")
        body += b"".join(s.to_bytes(wide, "big") for s in sizes)
        first = (head[:36] + body).ljust(len(head), b"\x00")
        stream = mpeg.read_stream(first + b"".join(frames))
        assert stream["table"]["frames"] == len(stream["offsets"]) == 8 and stream["table"]["bytes"] == stream["audio_bytes"]
        assert [b for _, b in stream["table"]["points"]] == [sum(sizes[: i + 1]) for i in range(4)] and stream["seek_error"] == 0
    wrong = first.replace(sizes[1].to_bytes(4, "big"), (sizes[1] + 50).to_bytes(4, "big"))
    assert mpeg.read_stream(wrong + b"".join(frames))["seek_error"] > 0


def test_payload_checksum_and_features_follow_the_bytes():
    payload = random.Random(3).randbytes(192 * 20)
    data = mpeg.write_stream(payload)
    stream = mpeg.read_stream(data)
    assert mpeg.payload_is_sound(stream) is True
    flipped = bytearray(data)
    flipped[stream["offsets"][2] + 100] ^= 1
    changed = mpeg.read_stream(bytes(flipped))
    assert changed["bad"] == 0 and mpeg.payload_is_sound(changed) is False and '"payload_sound": false' in mpeg.feature(changed)
    other = mpeg.write_stream(bytes(reversed(payload)))
    assert mpeg.feature(mpeg.read_stream(other)) != mpeg.feature(stream) == mpeg.feature(mpeg.read_stream(data))
    foreign = mpeg.read_stream(frame() * 5)
    assert mpeg.stored_payload(foreign) is None and mpeg.payload_is_sound(foreign) is None and '"rms": null' in mpeg.feature(foreign)


def test_any_bytes_are_read_without_an_error():
    r = random.Random(9)
    for _ in range(1500):
        data = bytearray(r.choice((v23([("TIT2", NO, b"\x01abc")], 0x40, bytes(4)), v24([("TIT2", b"\x00\x09", b"\x00\x00")]), b"APETAGEX" * 9, b"")) + frame(bitrate=1) * 3 + r.randbytes(r.randint(0, 90)))
        for _ in range(r.randint(0, 8)):
            data[r.randrange(len(data))] = r.randrange(256)
        mpeg.feature(mpeg.read_stream(bytes(data)))


def test_rows_of_any_table(spark):
    kind = "doc_id long, text string, feature int, n_frames int"
    assert mpeg.media_features(spark.createDataFrame([], kind)).count() == 0
    rows = [(1, "same", 1, 1), (1, "same", 2, 2), (None, None, 3, 3), (2, "long word " * 200_000, 4, 4)]
    got = sorted(mpeg.media_features(spark.createDataFrame(rows, kind)).collect(), key=lambda x: (x.doc_id or 0))
    assert got[1][1:] == got[2][1:] and got[0].payload_bytes == 192 and got[3].n_bytes == 2_000_000
    assert all(Fraction(x.duration_num, x.duration_den) == Fraction(1152, 48000) * x.n_frames for x in got)
