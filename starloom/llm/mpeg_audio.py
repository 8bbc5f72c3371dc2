"""Media columns: MPEG audio streams in a binary column.

`encode` stores any bytes losslessly: MPEG-2 Layer III, 16 kHz mono, 144 kbit/s, 648-byte frames of 576 samples. Each
frame is silent (its main data is empty) and carries 576 payload bytes, one a sample, as ancillary data after the side
information; header and side information are under the frame's CRC. An ID3v2 tag and an Info frame with the frame count, the
byte count and a seek table come first. The payload is padded with bytes 255 to a positive multiple of 576.

`parse` reads any MPEG audio stream: it skips ID3v2 tags and, beyond the last complete frame, ID3v1 and APE tags, finds frame headers, and after junk resynchronises
at the next header which another of the same kind follows (or the stream's end); it reads Xing, Info and VBRI tables, verifies the checksums of
Layer III frames, and gives the exact duration (samples and rate, no float) and every frame's byte offset.

Null text counts as empty; an empty or frameless stream has no frames and duration 0. Rows are independent: repeated rows and equal texts get equal values, an empty
table gives an empty result, other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches

UNIT = 576
# Fixed values of the MPEG audio formats: kbit/s by (version 1?, layer) and index, Hz by version bits and index.
KBITS = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HERTZ = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}


@dataclass(frozen=True)
class Header:
    version: int  # 3: MPEG-1, 2: MPEG-2, 0: MPEG-2.5
    layer: int
    crc: bool
    kbits: int
    hertz: int
    mono: bool
    size: int
    samples: int

    @property
    def kind(self) -> tuple:
        return self.version, self.layer, self.hertz

    @property
    def side(self) -> int:
        """Bytes of side information; Layer III only."""
        if self.layer != 3:
            return 0
        return (17 if self.mono else 32) if self.version == 3 else (9 if self.mono else 17)


@lru_cache(65536)
def header(word: int) -> Header | None:
    """A frame header from its 32 bits; None if they are no header (or of free format, whose frames have no stated size)."""
    version, layer = word >> 19 & 3, 4 - (word >> 17 & 3)
    rate, hz, pad = word >> 12 & 15, word >> 10 & 3, word >> 9 & 1
    if word >> 21 != 0x7FF or version == 1 or layer == 4 or rate in (0, 15) or hz == 3 or word & 3 == 2:
        return None
    kbits, hertz = KBITS[version == 3, layer][rate], HERTZ[version][hz]
    samples = 384 if layer == 1 else 576 if layer == 3 and version != 3 else 1152
    size = (12000 * kbits // hertz + pad) * 4 if layer == 1 else samples * 125 * kbits // hertz + pad
    return Header(version, layer, not word >> 16 & 1, kbits, hertz, word >> 6 & 3 == 3, size, samples)


@lru_cache(4096)
def crc16(data: bytes) -> int:
    """The format's checksum: polynomial 0x8005, all ones at first, most significant bit first."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


@dataclass
class Stream:
    offsets: list[int] = field(default_factory=list)  # of audio frames
    headers: list[Header] = field(default_factory=list)
    samples: int = 0
    crc_good: int = 0
    crc_bad: int = 0
    junk_bytes: int = 0
    resyncs: int = 0
    tags: list[str] = field(default_factory=list)
    table: str = ""  # Xing, Info or VBRI
    table_frames: int | None = None
    table_bytes: int | None = None
    toc: bytes = b""

    @property
    def duration(self) -> Fraction:
        """Seconds, exactly."""
        return sum((Fraction(n, hz) for hz, n in self._by_rate().items()), Fraction(0))

    def _by_rate(self) -> dict[int, int]:
        by: dict[int, int] = {}
        for h in self.headers:
            by[h.hertz] = by.get(h.hertz, 0) + h.samples
        return by

    def seek(self, sample: int) -> int | None:
        """Byte offset of the frame that holds this sample."""
        for at, h in zip(self.offsets, self.headers, strict=True):
            if sample < h.samples:
                return at
            sample -= h.samples
        return None


def _bounds(data: bytes, out: Stream) -> tuple[int, list[tuple[int, list[str]]]]:
    """Where the frames start, and where they may end, with the tags from there on: the nearest end first, the data's end last."""
    start, size = 0, len(data)
    while data[start : start + 3] == b"ID3" and start + 10 <= size:
        n = data[start + 6] << 21 | data[start + 7] << 14 | data[start + 8] << 7 | data[start + 9]
        out.tags.append(f"id3v2.{data[start + 3]}")
        start += 10 + n + (10 if data[start + 5] & 16 else 0)
    start = min(start, size)
    ends: list[tuple[int, list[str]]] = [(size, [])]
    if size - start >= 128 and data[size - 128 : size - 125] == b"TAG":
        ends.append((size - 128, ["id3v1"]))
    for end, tags in list(ends):
        if end - start >= 32 and data[end - 32 : end - 24] == b"APETAGEX":
            n, flags = struct.unpack("<I4xI", data[end - 20 : end - 8])
            ends.append((end - min(end - start, n + (32 if flags >> 31 else 0)), [*tags, "ape"]))
    return start, sorted(ends, key=lambda x: (x[0], -len(x[1])))


def _table(data: bytes, at: int, h: Header, out: Stream) -> bool:
    """Read a seek table in place of audio, if the first frame has one."""
    x = at + 4 + 2 * h.crc + h.side
    for x in dict.fromkeys((x, at + 4 + h.side)):
        if (name := data[x : x + 4]) in (b"Xing", b"Info") and x + 8 <= len(data):
            flags, x = int.from_bytes(data[x + 4 : x + 8]), x + 8
            out.table = name.decode()
            if flags & 1:
                out.table_frames, x = int.from_bytes(data[x : x + 4]), x + 4
            if flags & 2:
                out.table_bytes, x = int.from_bytes(data[x : x + 4]), x + 4
            if flags & 4:
                out.toc = data[x : x + 100]
            return True
    if data[at + 36 : at + 40] == b"VBRI":
        out.table, out.table_bytes, out.table_frames = "VBRI", int.from_bytes(data[at + 46 : at + 50]), int.from_bytes(data[at + 50 : at + 54])
        return True
    return False


def parse(data: bytes) -> Stream:
    out = Stream()
    at, ends = _bounds(data, out)
    end = ends[0][0]
    synced, first = False, True
    while at + 4 <= end:
        h = header(int.from_bytes(data[at : at + 4]))
        # What looks like a tag inside a complete frame is a part of it.
        if h and at + h.size > end and any(at + h.size == e or synced and at + h.size < e for e, _ in ends):
            ends = [x for x in ends if x[0] >= at + h.size]
            end = ends[0][0]
        if h and at + h.size > end:
            h = None  # cut off
        if h and not synced:
            after = at + h.size
            follows = header(int.from_bytes(data[after : after + 4])) if after + 4 <= end else None
            if after != end and (follows is None or follows.kind != h.kind):
                h = None
        if h is None:
            if synced or first:
                out.resyncs += 1
                synced = first = False
            found = data.find(b"\xff", at + 1, end)
            out.junk_bytes += (found if found >= 0 else end) - at
            at = found if found >= 0 else end
            continue
        synced = True
        if first and not out.offsets and not out.table and h.layer == 3 and _table(data, at, h, out):
            first = False
            at += h.size
            continue
        first = False
        if h.crc and h.layer == 3:
            if crc16(data[at + 2 : at + 4] + data[at + 6 : at + 6 + h.side]) == int.from_bytes(data[at + 4 : at + 6]):
                out.crc_good += 1
            else:
                out.crc_bad += 1
        out.offsets.append(at)
        out.headers.append(h)
        out.samples += h.samples
        at += h.size
    out.junk_bytes += end - at if at < end else 0
    out.tags += ends[0][1]
    return out


# MPEG-2, Layer III, protected; 144 kbit/s, 16 kHz, no padding; mono.
_HEAD = bytes((0xFF, 0xF2, 0xD8, 0xC0))
_SIDE = bytes(9)
_START = _HEAD + crc16(_HEAD[2:] + _SIDE).to_bytes(2) + _SIDE
_SIZE = header(int.from_bytes(_HEAD)).size
_TAIL = bytes(_SIZE - len(_START) - UNIT)
_ID3 = b"ID3\x04\0\0\0\0\0\x14" + b"TSSE\0\0\0\x0a\0\0\x03starloom\0"


def pad(payload: bytes) -> bytes:
    return payload + b"\xff" * (UNIT - len(payload) % UNIT if len(payload) % UNIT or not payload else 0)


def encode(payload: bytes) -> bytes:
    payload = pad(payload)
    n = len(payload) // UNIT
    size = (n + 1) * _SIZE
    toc = bytes(min(255, (1 + i * n // 100) * _SIZE * 256 // size) for i in range(100))
    info = _START + b"Info" + struct.pack(">III", 7, n, size) + toc
    return b"".join([_ID3, info.ljust(_SIZE, b"\0"), *(_START + payload[i : i + UNIT] + _TAIL for i in range(0, len(payload), UNIT))])


def payload_of(data: bytes, stream: Stream) -> bytes:
    """The bytes that `encode` stored."""
    return b"".join(data[(x := at + 4 + 2 * h.crc + h.side) : x + UNIT] for at, h in zip(stream.offsets, stream.headers, strict=True))


def feature(stream: Stream) -> str:
    """A digest of what was parsed: table, frames, exact duration, checksums, seek offsets."""
    d = stream.duration
    seek = hashlib.md5(b"".join(x.to_bytes(8) for x in stream.offsets)).hexdigest()[:16]
    return (
        f"tags={','.join(stream.tags)};table={stream.table}:{stream.table_frames}:{stream.table_bytes};frames={len(stream.offsets)};samples={stream.samples};"
        f"seconds={d.numerator}/{d.denominator};crc={stream.crc_good}+{stream.crc_bad};resyncs={stream.resyncs};seek={seek}"
    )


def _encode(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: encode((t or "").encode("utf-8", "surrogatepass")))


def _read(media: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in media:
        rows = []
        for data in batch:
            data = bytes(data or b"")
            stream = parse(data)
            rows.append((payload_of(data, stream), feature(stream)))
        yield pd.DataFrame(rows, columns=["payload", "feature"])


def _inspect(media: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in media:
        rows = []
        for data in batch:
            s = parse(bytes(data or b""))
            d = s.duration
            rows.append((s.tags, s.table, s.table_frames, len(s.offsets), s.samples, d.numerator, d.denominator, s.crc_good, s.crc_bad, s.junk_bytes, s.resyncs, s.offsets))
        yield pd.DataFrame(rows, columns=["tags", "table", "table_frames", "frames", "samples", "seconds_num", "seconds_den", "crc_good", "crc_bad", "junk_bytes", "resyncs", "offsets"])


def encode_text(text: Column) -> Column:
    """Texts (null: empty) as MPEG audio streams that hold their UTF-8."""
    return F.pandas_udf(_encode, "binary")(text)


def read_media(media: Column) -> Column:
    """What streams hold: the payload as stored, and the feature digest of the parse; a null stream has neither frames nor payload."""
    return F.pandas_udf(_read, "struct<payload binary, feature string>")(media)


def inspect_media(media: Column) -> Column:
    """Any MPEG audio column: tags, tables, exact duration as a fraction, checksum counts and all frame offsets."""
    return F.pandas_udf(
        _inspect,
        "struct<tags array<string>, table string, table_frames long, frames long, samples long, seconds_num long, seconds_den long,"
        " crc_good long, crc_bad long, junk_bytes long, resyncs long, offsets array<long>>",
    )(media)


def store_and_read(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `media` and `read` (payload, feature) to every row; columns of these names are replaced."""
    arrow_batches(docs.sparkSession, 500)
    out = docs.withColumn("media", encode_text(F.col(text)))
    return out.withColumn("read", read_media(F.col("media")))


def digests(docs: DataFrame) -> DataFrame:
    """The digest row of each document: sizes, hashes of what was read back and of the stored form, the feature."""
    payload: Column = F.col("read.payload")
    return store_and_read(docs.select("doc_id", "text")).select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(payload, -32, 32)).alias("tail_crc32"),
        F.octet_length("media").cast("bigint").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.col("read.feature").alias("feature"),
    )
