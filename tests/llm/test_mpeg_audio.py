import hashlib
import zlib
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import mpeg_audio as m


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=3000))
def test_round_trip(payload):
    data = m.encode(payload)
    s = m.parse(data)
    padded = m.pad(payload)
    assert m.payload_of(data, s) == padded and len(padded) % 576 == 0 and len(padded) - len(payload) <= 576 and padded
    assert s.samples == len(padded) and s.duration == Fraction(len(padded), 16000) and s.crc_good == len(s.offsets) and not s.crc_bad and not s.resyncs
    assert s.table_frames == len(s.offsets) and s.tags == ["id3v2.4"] and s.seek(577) == (s.offsets[1] if len(s.offsets) > 1 else None)


def test_sync_words_in_the_payload():
    payload = (m._HEAD + b"\xff\xfb\x90\x64") * 500
    assert m.payload_of(m.encode(payload), m.parse(m.encode(payload))) == m.pad(payload)


def test_header_fields():
    h = m.header(0xFFFB9064)  # MPEG-1 Layer III, 128 kbit/s, 44.1 kHz, joint stereo
    assert (h.layer, h.kbits, h.hertz, h.mono, h.size, h.samples, h.crc) == (3, 128, 44100, False, 417, 1152, False)
    assert m.header(0xFFFD9004).layer == 2 and m.header(0xFFFF9004).size == (12000 * 288 // 44100) * 4
    assert all(m.header(x) is None for x in (0, 0xFFFBF064, 0xFFFB0064, 0xFFFB9C64, 0xFFEB9064, 0xFFF99064 | 0x60000 & 0, 0xFFFB9066))


def test_resynchronises_after_damage():
    data = m.encode(b"abc" * 2000)
    whole = m.parse(data)
    cut = bytearray(data)
    del cut[3000:3100]
    s = m.parse(bytes(cut))
    assert s.resyncs == 1 and len(s.offsets) == len(whole.offsets) - 1 and s.junk_bytes == 648 - 100
    noise = m.parse(b"\xff\xf2junk\xff" * 9 + data)
    assert len(noise.offsets) >= len(whole.offsets) and noise.resyncs == 1
    flipped = bytearray(data)
    flipped[whole.offsets[2] + 8] ^= 1
    assert m.parse(bytes(flipped)).crc_bad == 1


def test_tags_and_tables():
    data = m.encode(b"x" * 2000)
    tagged = data + b"APETAGEX" + (2000).to_bytes(4, "little") + (32).to_bytes(4, "little") + bytes(16) + b"TAG" + bytes(125)
    s = m.parse(tagged)
    assert s.tags == ["id3v2.4", "id3v1", "ape"] and len(s.offsets) == 4
    frame = b"\xff\xfb\x90\x64" + bytes(413)
    vbri = frame[:36] + b"VBRI" + bytes(6) + (834).to_bytes(4) + (1).to_bytes(4) + frame[54:]
    s = m.parse(vbri + frame * 2)
    assert (s.table, s.table_bytes, s.table_frames, len(s.offsets)) == ("VBRI", 834, 1, 2) and s.duration == Fraction(2304, 44100)
    assert len(m.parse(frame * 3 + frame[:100]).offsets) == 3


def test_checksum_polynomial():
    # The remainder of a message followed by its own checksum is zero.
    assert m.crc16(b"123456789" + m.crc16(b"123456789").to_bytes(2)) == 0


def test_digests(docs, texts, odd, none):
    for frame, rows in ((docs, texts), (odd, {r["doc_id"]: r["text"] for r in odd.collect()})):
        got = m.digests(frame.withColumn("media", F.lit(1)).withColumn("read", F.lit(2))).collect()
        assert len(got) == frame.count()
        for r in got:
            raw = (rows[r["doc_id"]] or "").encode()
            padded = m.pad(raw)
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))
            assert r["media_sha256"] == hashlib.sha256(m.encode(raw)).hexdigest() and r["media_bytes"] == len(m.encode(raw))
            assert f"seconds={Fraction(len(padded), 16000).numerator}/" in r["feature"]
    assert m.digests(none).count() == 0


def test_any_bytes_parse(spark):
    df = spark.createDataFrame([(None,), (b"",), (b"\xff" * 5000,), (bytes(range(256)) * 20,), (m.encode(b"q"),)], "media binary")
    got = df.select(m.inspect_media(F.col("media")).alias("x")).select("x.*").collect()
    assert [r["frames"] for r in got] == [0, 0, 0, 0, 1] and [r["seconds_num"] for r in got[:2]] == [0, 0] and got[4]["offsets"] == [m.parse(m.encode(b"q")).offsets[0]]


def test_tag_marks_in_the_payload(spark):
    """'TAG' 128 bytes before the end of the stored stream is text, in one frame or many, with and without real tags after it, and beside damage."""
    ape = b"APETAGEX" + (2000).to_bytes(4, "little") + (32).to_bytes(4, "little") + bytes(16)
    for n in (0, 1, 5):
        payload = b"a" * (576 * n + 505) + b"TAG" + b"b" * 40
        data = m.encode(payload)
        assert data[-128:-125] == b"TAG"
        for tail, tags in ((b"", []), (b"TAG" + bytes(125), ["id3v1"]), (ape, ["ape"]), (ape + b"TAG" + bytes(125), ["id3v1", "ape"])):
            s = m.parse(data + tail)
            assert m.payload_of(data + tail, s) == m.pad(payload) and s.tags == ["id3v2.4", *tags] and not s.junk_bytes and not s.resyncs
    cut = data[:3000] + data[3050:]
    assert len(m.parse(cut).offsets) == len(m.parse(data).offsets) - 1
    row = m.digests(spark.createDataFrame([(1, "a" * 505 + "TAG")], "doc_id long, text string")).first()
    assert (row["n_bytes"], row["payload_bytes"]) == (508, 576)
