"""MPEG audio columns: an elementary stream written, parsed and verified.

``write_stream`` stores any bytes losslessly as an MPEG-1 Layer III stream (one
channel, 48 kHz) that players decode as silence: an ID3v2 tag, a frame with the
variable-bitrate table (frames, bytes and 100 seek points), and frames of
varying bitrate whose side information gives no main data, so all that follows
it is ancillary data and carries the bytes.  Every frame is protected by the
standard's CRC-16, and the tag holds the CRC-32 of the bytes.

``read_stream`` parses any stream of Layers I to III, MPEG-1, 2 or 2.5.  It
reads ID3v2.2 to 2.4 tags (with extended headers, unsynchronisation and packed
frames), ID3v1 and APE tags, and resynchronises after foreign bytes: a header
counts only if it is like that of the frame before, or if another header or the
end of the stream follows its frame.  It verifies checksums (Layers I and III;
those of Layer II cover bits whose number only decoding tells, and aren't
read), reads Xing, Info and VBRI tables with their seek points and compares
them with the frames that are there, and gives every frame's offset and the
exact duration: the sum of samples / rate over frames of any rate.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwright.llm.common import bounded_batches

UNIT = 192
ROWS = 256

# Fixed values of ISO/IEC 11172-3 and 13818-3: kbit/s by layer, of MPEG-1 and
# of MPEG-2; Hz by version bits.
BITRATES_1 = {
    1: (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    2: (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    3: (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
}
BITRATES_2 = {
    1: (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    2: (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    3: (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}

SIDE = 17
HEAD = 4 + 2 + SIDE


def _crc_table() -> list[int]:
    table = []
    for byte in range(256):
        value = byte << 8
        for _ in range(8):
            value = (value << 1) ^ (0x8005 if value & 0x8000 else 0)
        table.append(value & 0xFFFF)
    return table


_CRC = _crc_table()


def crc16(data: bytes) -> int:
    """CRC-16 of the standard: x16+x15+x2+1, all ones at the start."""
    value = 0xFFFF
    for byte in data:
        value = ((value << 8) & 0xFFFF) ^ _CRC[(value >> 8) ^ byte]
    return value


def _frame_start(index: int) -> bytes:
    """Header, checksum and empty side information of a 48 kHz mono frame."""
    header = bytes((0xFF, 0xFA, index << 4 | 1 << 2, 3 << 6))
    side = bytes(SIDE)
    return header + crc16(header[2:] + side).to_bytes(2, "big") + side


#: By bitrate index: the fixed start and the length of a whole frame.
_STARTS = {i: _frame_start(i) for i in range(1, 15)}
_SIZES = {i: 3 * BITRATES_1[3][i] for i in range(1, 15)}


def _tag(fields: dict[str, str]) -> bytes:
    frames = b""
    for name, value in fields.items():
        body = b"\x03" + name.encode() + b"\x00" + value.encode()
        frames += b"TXXX" + _synchsafe(len(body)) + b"\x00\x00" + body
    return b"ID3\x04\x00\x00" + _synchsafe(len(frames)) + frames


def _synchsafe(n: int) -> bytes:
    return bytes((n >> shift) & 0x7F for shift in (21, 14, 7, 0))


def write_stream(payload: bytes) -> bytes:
    """The stream whose ancillary data is ``payload``, to the byte."""
    most = _SIZES[14] - HEAD
    frames, offsets, at = [], [], _SIZES[9]
    for start in range(0, len(payload), most):
        part = payload[start : start + most]
        index = next(i for i in range(1, 15) if _SIZES[i] - HEAD >= len(part))
        frame = _STARTS[index] + part
        frames.append(frame + bytes(_SIZES[index] - len(frame)))
        offsets.append(at)
        at += _SIZES[index]
    n = len(frames)
    toc = bytes(min(255, offsets[i * n // 100] * 256 // at) if n else 0 for i in range(100))
    table = b"Xing" + (7).to_bytes(4, "big") + n.to_bytes(4, "big") + at.to_bytes(4, "big") + toc
    first = _STARTS[9] + table
    first += bytes(_SIZES[9] - len(first))
    tag = _tag({"payload_bytes": str(len(payload)), "payload_crc32": f"{zlib.crc32(payload):08x}"})
    return tag + first + b"".join(frames)


class Header:
    """A frame header's fields; ``None`` from ``of`` if the four bytes are none."""

    __slots__ = ("bitrate", "covered", "kind", "layer", "mono", "protected", "rate", "samples", "side", "size")
    _seen: dict[bytes, Header | None] = {}

    @classmethod
    def of(cls, four: bytes) -> Header | None:
        key = bytes(four)
        if key not in cls._seen:
            if len(cls._seen) > 4096:
                cls._seen.clear()
            cls._seen[key] = cls._parsed(key)
        return cls._seen[key]

    @classmethod
    def _parsed(cls, four: bytes) -> Header | None:
        if len(four) < 4 or four[0] != 0xFF or four[1] & 0xE0 != 0xE0:
            return None
        version, layer, bits, rate = four[1] >> 3 & 3, 4 - (four[1] >> 1 & 3), four[2] >> 4, four[2] >> 2 & 3
        if version == 1 or layer == 4 or bits in (0, 15) or rate == 3:
            return None
        self = cls()
        self.layer = layer
        self.bitrate = (BITRATES_1 if version == 3 else BITRATES_2)[layer][bits]
        self.rate = RATES[version][rate]
        self.samples = {1: 384, 2: 1152, 3: 1152 if version == 3 else 576}[layer]
        slot, padding = (4 if layer == 1 else 1), four[2] >> 1 & 1
        self.size = (self.samples // 8 // slot * self.bitrate * 1000 // self.rate + padding) * slot
        mode = four[3] >> 6
        self.mono = mode == 3
        self.protected = not four[1] & 1
        self.side = 0 if layer < 3 else (17 if self.mono else 32) if version == 3 else (9 if self.mono else 17)
        # Bytes after the checksum that it covers; None: not known from the header.
        shared = 4 + 4 * (four[3] >> 4 & 3) if mode == 1 else 0 if self.mono else 32
        self.covered = {1: (32 + shared) // 2, 2: None, 3: self.side}[layer]
        self.kind = (version, layer, self.rate, self.mono, self.protected)
        return self


def _plain(four: bytes) -> int:
    return int.from_bytes(four, "big")


def _unsafe(four: bytes) -> int:
    """The number of a synchsafe field."""
    return sum((b & 0x7F) << 7 * i for i, b in enumerate(reversed(four)))


def _resynchronised(data: bytes) -> bytes:
    return data.replace(b"\xff\x00", b"\xff")


#: Of version 2.2 the frames that have another name since, as far as they are common.
_NAMES_22 = {"TT1": "TIT1", "TT2": "TIT2", "TT3": "TIT3", "TP1": "TPE1", "TP2": "TPE2", "TAL": "TALB", "TYE": "TYER", "TRK": "TRCK", "TCO": "TCON", "TCM": "TCOM", "TEN": "TENC", "TXX": "TXXX"}
_MOST_TEXT = 1 << 20


def _frame_texts(major: int, name: str, body: bytes, found: dict) -> None:
    """Add the text of a text frame to ``found``; a described one by its description."""
    name = _NAMES_22.get(name, name) if major == 2 else name
    if not name.startswith("T") or not body:
        return
    text = body[1:].decode("utf-16-be" if body[0] == 2 else "utf-16" if body[0] == 1 else "utf-8" if body[0] == 3 else "latin-1", "replace")
    key, _, value = text.partition("\x00") if name == "TXXX" else (name, "", text)
    # After the first of two UTF-16 strings, the second has its own mark.
    found[key] = value.removeprefix("\ufeff").strip("\x00")


def _id3v2(major: int, flags: int, body: bytes, found: dict) -> None:
    """The text frames of a tag's body."""
    if flags & 0x80 and major < 4:
        body = _resynchronised(body)
    number = _unsafe if major == 4 else _plain
    at = 0
    if flags & 0x40:
        if major == 2:  # a scheme of compression that was never defined
            return
        at = number(body[:4]) + (4 if major == 3 else 0)
    wide = 3 if major == 2 else 4
    head = 6 if major == 2 else 10
    while at + head <= len(body) and body[at : at + wide].isalnum():
        n = number(body[at + wide : at + 2 * wide]) if wide == 4 else _plain(body[at + 3 : at + 6])
        form = body[at + 9] if head == 10 else 0
        part = body[at + head : at + head + n]
        packed, secret = (form & 0x80, form & 0x40) if major == 3 else (form & 0x08, form & 0x04)
        if major == 4:
            part = part[(form >> 6 & 1) + 4 * (form & 1) :]
            part = _resynchronised(part) if form & 0x02 or flags & 0x80 else part
        elif major == 3:
            part = part[4 * (form >> 7) + (form >> 5 & 1) :]
        if packed and not secret:
            try:
                part = zlib.decompressobj().decompress(part, _MOST_TEXT)
            except zlib.error:
                part = b""
        if not secret:
            _frame_texts(major, body[at : at + wide].decode(), part, found)
        at += head + n


def _tags(data: bytes) -> tuple[int, int, dict]:
    """Start and end of the frames between the tags, and the tags' texts."""
    start, end, found = 0, len(data), {}
    while data[start : start + 3] == b"ID3" and len(data) >= start + 10:
        major, flags, size = data[start + 3], data[start + 5], _unsafe(data[start + 6 : start + 10])
        if major in (2, 3, 4):
            _id3v2(major, flags, data[start + 10 : start + 10 + size], found)
        start += 10 + size + (10 if major == 4 and flags & 0x10 else 0)
    start = min(start, end)
    if end - start >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        for name, at, stop in (("TIT2", 3, 33), ("TPE1", 33, 63), ("TALB", 63, 93), ("TYER", 93, 97)):
            if value := data[end + at : end + stop].split(b"\x00")[0].rstrip().decode("latin-1"):
                found.setdefault(name, value)
    if end - start >= 32 and data[end - 32 : end - 24] == b"APETAGEX":
        size, items, flags = (int.from_bytes(data[end - 32 + i : end - 28 + i], "little") for i in (12, 16, 20))
        first = max(start, end - size)
        at, stop = first, end - 32
        for _ in range(min(items, 1000)):
            n, key_end = int.from_bytes(data[at : at + 4], "little"), data.find(b"\x00", at + 8, stop)
            if key_end < 0 or key_end + 1 + n > stop:
                break
            if data[at + 4] >> 1 & 3 == 0:
                found.setdefault(data[at + 8 : key_end].decode("latin-1"), data[key_end + 1 : key_end + 1 + n].decode("utf-8", "replace"))
            at = key_end + 1 + n
        end = max(start, first - 32) if flags >> 31 and data[first - 32 : first - 24] == b"APETAGEX" else first
    return start, end, found


def _table(frame: bytes, header: Header) -> dict | None:
    """The variable-bitrate table of a first frame: frames, bytes, and seek points
    as (share or number of frames, bytes from the table's frame)."""
    if header.layer != 3:
        return None
    at = 4 + header.side + (2 if header.protected else 0)
    for place in (at, 4 + header.side):  # some writers don't count the checksum
        if frame[place : place + 4] in (b"Xing", b"Info"):
            flags, place = _plain(frame[place + 4 : place + 8]), place + 8
            out: dict = {"frames": None, "bytes": None, "toc": None, "points": None}
            for bit, name in ((1, "frames"), (2, "bytes")):
                if flags & bit:
                    out[name] = _plain(frame[place : place + 4])
                    place += 4
            if flags & 4 and len(frame) >= place + 100:
                out["toc"] = frame[place : place + 100]
            return out
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        size, frames, entries, scale, wide, step = (_plain(frame[i:j]) for i, j in ((46, 50), (50, 54), (54, 56), (56, 58), (58, 60), (60, 62)))
        points, total = [], 0
        for i in range(entries if wide in (1, 2, 3, 4) and len(frame) >= 62 + entries * wide else 0):
            total += _plain(frame[62 + i * wide : 62 + (i + 1) * wide]) * scale
            points.append(((i + 1) * step, total))
        return {"frames": frames, "bytes": size, "toc": None, "points": points}
    return None


def read_stream(data: bytes) -> dict:
    """Frames, tags, table, checks and ancillary bytes of a stream.

    ``offsets`` and ``sizes`` are of the audio frames from the start of
    ``data``, without the table's frame.  ``skipped`` counts bytes between the
    tags that belong to no whole frame.  ``duration`` is a fraction of seconds.
    ``seek_error`` is the largest distance of a seek point from its frame, in
    256ths of the stream.  Empty or foreign data has no frames.
    """
    at, end, tags = _tags(data)
    table, offsets, sizes, skipped, bad, checked, samples, begin = None, [], [], 0, 0, 0, 0, at
    rates: Counter[int] = Counter()
    bitrates: set[int] = set()
    layers: set[int] = set()
    sums: dict[bytes, int] = {}
    ancillary, first = [], True
    last: Header | None = None  # of the frame that ends here
    of = Header.of
    while at + 4 <= end:
        header = of(data[at : at + 4])
        stop = at + header.size if header else 0
        alike = header and last and header.kind == last.kind
        sound = header and stop <= end and (alike or stop == end or stop + 4 <= end and of(data[stop : stop + 4]))
        if not sound:
            last = None
            following = data.find(b"\xff", at + 1, end)
            following = end if following < 0 else following
            skipped += following - at
            at = following
            continue
        last = header
        lead = 4 + (2 if header.protected else 0) + header.side
        if header.protected and header.covered is not None:
            covered = data[at + 2 : at + 4] + data[at + 6 : at + 6 + header.covered]
            if (value := sums.get(covered)) is None:
                if len(sums) > 4096:
                    sums.clear()
                value = sums[covered] = crc16(covered)
            checked += 1
            bad += value != _plain(data[at + 4 : at + 6])
        found = _table(data[at:stop], header) if first else None
        if first:
            begin = at
        first = False
        if found:
            table = found
        else:
            offsets.append(at)
            sizes.append(header.size)
            bitrates.add(header.bitrate)
            layers.add(header.layer)
            samples += header.samples
            rates[header.rate] += header.samples
            ancillary.append(data[at + lead : stop])
        at = stop
    skipped += max(0, end - at)
    seek_error, n = None, len(offsets)
    if table and table["bytes"] and offsets:
        points = []
        if table["toc"]:
            points = [(offsets[i * n // 100] - begin, t * table["bytes"] / 256) for i, t in enumerate(table["toc"])]
        elif table["points"]:
            points = [((offsets[i] if i < n else at) - begin, p) for i, p in table["points"] if i <= n]
        if points:
            seek_error = max(abs(p - q) for p, q in points) * 256 / table["bytes"]
    return {
        "tags": tags, "table": table, "offsets": offsets, "sizes": sizes, "skipped": skipped, "checked": checked, "bad": bad, "samples": samples,
        "rates": dict(sorted(rates.items())), "duration": sum((Fraction(k, rate) for rate, k in rates.items()), Fraction(0)), "layers": sorted(layers),
        "bitrates": sorted(bitrates), "ancillary": ancillary, "seek_error": seek_error, "audio_bytes": end - begin,
    }


def stored_payload(stream: dict) -> bytes | None:
    """The bytes that write_stream stored; None for a stream of another writer."""
    size = stream["tags"].get("payload_bytes", "")
    return b"".join(stream["ancillary"])[: int(size)] if size.isascii() and size.isdigit() else None


def payload_is_sound(stream: dict) -> bool | None:
    """Whether the stored bytes agree with the tag's length and checksum."""
    payload = stored_payload(stream)
    if payload is None:
        return None
    return len(payload) == int(stream["tags"]["payload_bytes"]) and f"{zlib.crc32(payload):08x}" == stream["tags"].get("payload_crc32")


def feature(stream: dict) -> str:
    """What was parsed, and what the stored bytes are as 8-bit samples, as JSON
    with sorted keys; without stored bytes those values are null."""
    table, payload = stream["table"] or {}, stored_payload(stream)
    values = np.frombuffer(payload or b"", np.uint8).astype(np.int64) - 128
    sound = lambda x: None if payload is None or not len(values) else round(float(x()), 6)
    return json.dumps(
        {
            "bitrates_kbps": stream["bitrates"],
            "checksums_bad": stream["bad"],
            "checksums_read": stream["checked"],
            "frames": len(stream["offsets"]),
            "mean": sound(values.mean),
            "payload_crc32": None if payload is None else zlib.crc32(payload),
            "payload_sound": payload_is_sound(stream),
            "peak": sound(lambda: np.abs(values).max()),
            "rms": sound(lambda: np.sqrt((values**2).mean())),
            "sample_rates": list(stream["rates"]),
            "samples": stream["samples"],
            "seek_error_256": None if stream["seek_error"] is None else round(stream["seek_error"], 3),
            "skipped_bytes": stream["skipped"],
            "steps": sound(lambda: np.abs(np.diff(values)).sum()),
            "table_agrees": table.get("frames") == len(stream["offsets"]) and table.get("bytes") == stream["audio_bytes"],
            "tags": len(stream["tags"]),
        },
        sort_keys=True,
    )


def _media(batches):
    fields = (
        ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()),
        ("media_sha256", pa.string()), ("feature", pa.string()), ("duration_us", pa.int64()), ("duration_num", pa.int64()), ("duration_den", pa.int64()),
        ("n_frames", pa.int64()), ("frame_offsets", pa.list_(pa.int64())),
    )
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for start in range(0, len(ids), ROWS):
            rows = []
            for text in texts.slice(start, ROWS):
                raw = (text.as_py() or "").encode("utf-8")
                payload = raw + b" " * (-len(raw) % UNIT if raw else UNIT)
                media = write_stream(payload)
                stream = read_stream(media)
                back = stored_payload(stream)
                duration = stream["duration"]
                rows.append((
                    len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media),
                    hashlib.sha256(media).hexdigest(), feature(stream), int(duration * 1_000_000), duration.numerator, duration.denominator, len(stream["offsets"]), stream["offsets"],
                ))
            columns = [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
            yield pa.RecordBatch.from_arrays([ids.slice(start, ROWS), *columns], names=["doc_id", *(n for n, _ in fields)])


def media_features(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The text of each row stored as an MPEG audio stream, read back and measured.

    doc_id, n_bytes (UTF-8), payload_bytes (padded with blanks to a positive
    multiple of 192, as read back), payload_sha256, tail_crc32 (of the last 16
    bytes read back), media_bytes, media_sha256, feature (JSON), duration_us
    (rounded down), duration_num / duration_den (exact seconds), n_frames,
    frame_offsets (bytes from the start of the stream, a seek point for every
    frame).  A null text counts as empty; equal texts give equal values; rows
    stand for themselves, whatever their keys; other columns are ignored, so
    none can clash; an empty table gives none.  A long text is as many frames
    as it needs.
    """
    rows = bounded_batches(documents).select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = (
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
        "media_sha256 string, feature string, duration_us long, duration_num long, duration_den long, n_frames long, frame_offsets array<long>"
    )
    return rows.mapInArrow(_media, schema)
