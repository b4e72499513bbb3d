"""Archives: round trip, salvage of damaged members, plain archives."""

import base64
import gzip
import hashlib
import io
import random
import zlib

import pytest

from starmart.llm import warc


def archive(payloads):
    return [warc.member(warc.record("response", str(i), None, f"http://x/{i}", p, warc.digest(p), len(p))) for i, p in enumerate(payloads)]


def names(found):
    return [x["fields"]["warc-record-id"] if "fields" in x else (x["offset"], x["length"]) for x in found]


def test_round_trip(spark, tmp_path):
    rows = [(1, "u", "same"), (2, "u v", "same"), (2, "w", "same"), (3, None, None), (4, "u", ""), (5, "u", "é" * 40_000), (None, "u", "same"), (None, "n", "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS sha1", "1 AS first")
    made = warc.write(pages, str(tmp_path)).collect()
    assert sum(r.records for r in made) == len(rows)
    found = warc.read(spark, f"file://{tmp_path}").collect()
    want = sorted(
        (str(p), len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), str(refers))
        for (p, _, h), refers in zip(rows, [None, "1", "1", None, "3", None, "1", None], strict=True)
    )
    assert sorted((r.id, r.payload_bytes, r.payload_digest, str(r.refers_to)) for r in found) == want
    assert all((r.type == "revisit") == (r.refers_to is not None) == (r.payload is None) for r in found)
    kept = warc.write(pages, str(tmp_path / "two"), least_bytes=5)
    assert kept.collect() and {r.type for r in warc.read(spark, f"file://{tmp_path / 'two'}").collect()} == {"response"}


def test_nothing(spark, tmp_path):
    assert warc.write(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path)).where("records > 0").count() == 0
    assert warc.read(spark, f"file://{tmp_path}").collect() == []


@pytest.mark.parametrize("damage", ["flip", "cut", "junk", "zero"])
def test_salvage(damage):
    r = random.Random(damage)
    members = archive([r.randbytes(r.randrange(1, 5000)) for _ in range(12)])
    bad = {3, 4, 9}
    parts = []
    for i, m in enumerate(members):
        if i in bad:
            m = bytearray(m)
            if damage == "flip":
                m[len(m) // 2] ^= 0xFF
            elif damage == "cut":
                m = m[: len(m) // 2]
            elif damage == "junk":
                m = m[:5] + b"\x1f\x8b\x08junk" + m[5:]
            else:
                m = bytes(len(m))
        parts.append(bytes(m))
    found = list(warc.salvaged(Sized(b"".join(parts))))
    starts = [sum(map(len, parts[:i])) for i in range(13)]
    want = [f"<urn:page:{i}>" for i in range(12)]
    want[9:10] = [(starts[9], len(parts[9]))]
    want[3:5] = [(starts[3], len(parts[3]) + len(parts[4]))]
    assert names(found) == want


def test_every_byte_is_a_record_or_a_gap():
    r = random.Random(5)
    data = bytearray(b"".join(archive([r.randbytes(300) for _ in range(8)])))
    for _ in range(4):
        data[r.randrange(len(data))] ^= 1 << r.randrange(8)
    at = 0
    for x in warc.salvaged(Sized(bytes(data))):
        assert x["offset"] == at
        at += x["length"]
    assert at == len(data)


def test_plain_archive_and_small_buffer(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 64)
    records = [gzip.decompress(m) for m in archive([b"one" * 50, b"two" * 50, b"three"])]
    records[1] = records[1].replace(b"twotwo", b"tootwo", 1)
    found = list(warc.salvaged(Sized(b"".join(records))))
    assert names(found) == ["<urn:page:0>", (len(records[0]), len(records[1])), "<urn:page:2>"]
    assert names(warc.salvaged(Sized(b"".join(archive([b"x" * 500, b"y"]))))) == ["<urn:page:0>", "<urn:page:1>"]


class Sized(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def plain(i, payload):
    return warc.record("response", str(i), None, f"http://x/{i}", payload, warc.digest(payload), len(payload))


def ids(found):
    return [x["fields"]["warc-record-id"].removeprefix("<urn:page:").removesuffix(">") for x in found if "fields" in x]


def test_a_damaged_head_hides_nothing():
    # The first magic number is that of a body, not of the archive.
    records = [plain(0, gzip.compress(b"a" * 900)), *(plain(i, b"b" * i) for i in range(1, 6))]
    data = bytearray(b"".join(records))
    assert ids(warc.salvaged(Sized(bytes(data)))) == list("012345")
    data[0] ^= 1
    found = list(warc.salvaged(Sized(bytes(data))))
    assert ids(found) == list("12345")
    assert [(x["offset"], x["length"]) for x in found if "reason" in x] == [(0, len(records[0]))]
    # Plain records after members and members after plain records.
    mixed = [warc.member(records[1]), records[2], b"junk", warc.member(records[3]), b"WARC/1.1\r\nX", records[4]]
    found = list(warc.salvaged(Sized(b"".join(mixed))))
    assert ids(found) == list("1234") and sum("reason" in x for x in found) == 2


@pytest.mark.parametrize("held", [16 << 20, 50_000])
def test_members_of_several_records(monkeypatch, held):
    monkeypatch.setattr(warc, "HELD", held)
    r = random.Random(3)
    records = [plain(i, r.randbytes(r.choice([0, 10, 30_000]))) for i in range(40)]
    whole = warc.member(b"".join(records))
    found = list(warc.salvaged(Sized(whole + warc.member(plain(99, b"z")))))
    assert ids(found) == [str(i) for i in range(40)] + ["99"] and not any("reason" in x for x in found)
    assert {(x["offset"], x["length"]) for x in found} == {(0, len(whole)), (len(whole), len(warc.member(plain(99, b"z"))))}
    # A bad record in a sound member: only it is lost.
    bad = list(records)
    bad[7] = bad[7].replace(b"Content-Length: ", b"Content-Length: 9", 2)
    found = list(warc.salvaged(Sized(warc.member(b"".join(bad)))))
    assert ids(found) == [str(i) for i in range(40) if i != 7] and sum("reason" in x for x in found) == 1
    # A damaged member: the record that holds the damage is lost (random bytes are stored, so decompression goes on).
    broken = bytearray(whole)
    broken[len(whole) // 2] ^= 255
    found = list(warc.salvaged(Sized(bytes(broken) + warc.member(plain(99, b"z")))))
    assert ids(found) == [str(i) for i in range(40) if i != 22] + ["99"]
    assert [(x["offset"], x["length"]) for x in found if "reason" in x] == [(0, len(whole))]


def test_records_before_the_damage_of_a_member():
    text = random.Random(4).choices(b"abcdefgh \n", k=400_000)
    records = [plain(i, bytes(text[i * 9000 : i * 9000 + 9000])) for i in range(40)]
    broken = bytearray(warc.member(b"".join(records)))
    broken[len(broken) // 2 : len(broken) // 2 + 40] = bytes(40)
    found = list(warc.salvaged(Sized(bytes(broken) + warc.member(plain(99, b"z")))))
    *before, last = ids(found)
    assert last == "99" and len(before) > 10 and before == [str(i) for i in range(len(before))]
    assert [(x["offset"], x["length"]) for x in found if "reason" in x] == [(0, len(broken))]


def test_stored_members_are_read_once():
    records = [plain(i, b"q" * 50) for i in range(5)]
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    data = bytearray(packer.compress(b"".join(records)) + packer.flush())
    data[-6] ^= 1  # the checksum
    found = list(warc.salvaged(Sized(bytes(data))))
    assert ids(found) == list("01234") and sum("reason" in x for x in found) == 1


@pytest.mark.parametrize("packed", [False, True])
def test_long_headers(packed):
    long = plain(1, b"y").replace(b"\r\nContent-Type", b"\r\nX-Long: " + b"v" * 300_000 + b"\r\n more\r\nContent-Type", 1)
    parts = [plain(0, b"x"), long, plain(2, b"")]
    found = list(warc.salvaged(Sized(b"".join(map(warc.member, parts) if packed else parts))))
    assert ids(found) == list("012") and len(found[1]["fields"]["x-long"]) == 300_005


def test_a_second_attempt_leaves_no_archives_of_the_first(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, "u", str(i) * 50) for i in range(30)], "page_id long, url string, html string")
    monkeypatch.setattr(warc, "ROLL_BYTES", 1000)
    first = [r.archive for r in warc.write(pages.coalesce(1), str(tmp_path)).collect()]
    (tmp_path / ".attempt-999999").mkdir()
    (tmp_path / ".attempt-999999" / "part-0000.warc.gz").write_bytes(b"cut off")
    monkeypatch.setattr(warc, "ROLL_BYTES", 1 << 20)
    again = [r.archive for r in warc.write(pages.coalesce(1), str(tmp_path)).collect()]
    assert len(first) > len(again) == 1
    found = warc.read(spark, f"file://{tmp_path}").collect()
    assert sorted(int(r.id) for r in found) == list(range(30)) and {r.kind for r in found} == {"record"}
