import base64
import gzip
import hashlib
import random

import duckdb
import pyarrow as pa
import pytest

from qualmart.llm import warc as W


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "page_id long, url string, html string, payload_bytes int, digest string")


COLS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_round_trip_matches_sql(spark):
    rng = random.Random(1)
    big = ["x" * 1000, "é" * 500, "y" * 999, "z" * 5000 + "\r\n\r\nWARC/1.0\r\n"]
    rows = [(i, f"http://h/{i} a\nb", rng.choice([*big, "", None, f"p{i}" * 600])) for i in range(200)]
    rows += [(i, None, big[0]) for i in range(300, 500)] + [(499, None, big[0]), (7, "u", "dup"), (7, "u", "dup")]
    pages = pages_of(spark, rows)
    records, gaps = W.archived(pages)
    got = sorted(map(tuple, records.select(COLS).collect()), key=str)
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": [r[0] for r in rows], "html": [r[2] for r in rows]}))
    assert got == sorted(con.execute(W.SQL).fetchall(), key=str)
    assert gaps.count() == 0


def test_null_ids_and_empty_table(spark):
    big = "x" * 2000
    records, _ = W.archived(pages_of(spark, [(None, "u", big), (3, "u", big), (None, None, None)]))
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in records.collect()}
    assert got == {(None, "revisit", 3, 2000), (3, "response", None, 2000), (None, "response", None, 0)}
    assert W.archived(pages_of(spark, []))[0].count() == 0


def read(data):
    return list(W.salvage(pa.BufferReader(data)))


def covered(found, data):
    assert [f[0] for f in found] == [0, *[f[1] for f in found[:-1]]] and found[-1][1] == len(data)


def test_payloads_are_stored_whole(spark):
    manifest = W.write_archives(W.plan_records(pages_of(spark, [(1, "u", "a\r\n\r\nb"), (2, "v", "")])),
                                W.scratch_path(spark, "warc"), roll_bytes=1)
    assert manifest.count() == 2
    got = {r.page_id: bytes(r.payload) for r in W.read_archives(manifest).collect()}
    assert got == {1: b"a\r\n\r\nb", 2: b""}


def test_salvage_of_damaged_gzip():
    rng = random.Random(3)
    parts = [W._member(W.record(i, "u", bytes(rng.randrange(256) for _ in range(400 * i)), None)) for i in range(9)]
    whole = b"".join(parts)
    assert [f[2]["head"]["WARC-Record-ID"] for f in read(whole)] == [f"<urn:page:{i}>" for i in range(9)]
    for trial in range(60):
        data = bytearray(whole)
        hurt = trial % 9
        start = sum(map(len, parts[:hurt]))
        kind = trial % 3
        if kind == 0:
            data[start + rng.randrange(len(parts[hurt]))] ^= 1 << rng.randrange(8)
        elif kind == 1:
            data[start:start] = bytes(rng.randrange(256) for _ in range(rng.randrange(1, 3000))) + W._MAGIC
        else:
            del data[start + 5:start + len(parts[hurt]) - 3]
        found = read(bytes(data))
        covered(found, bytes(data))
        ids = [f[2]["head"]["WARC-Record-ID"] for f in found if f[2]]
        want = [f"<urn:page:{i}>" for i in range(9) if kind == 1 or i != hurt]
        assert [i for i in ids if i != f"<urn:page:{hurt}>"] == [i for i in want if i != f"<urn:page:{hurt}>"]
        assert kind == 0 or any(f[3] for f in found)


def test_salvage_of_damaged_plain_and_truncated_files():
    parts = [W.record(i, "u", b"p" * 300 * i, None) for i in range(6)]
    data = bytearray(b"".join(parts))
    data[len(parts[0]) + 3] ^= 255  # version line of the second
    found = read(bytes(data[:-10]))
    covered(found, bytes(data[:-10]))
    assert [f[3] for f in found] == [None, "no version line", None, None, None, "truncated"]
    assert read(b"") == []
    assert [f[3] for f in read(b"junk" * 9)] == ["no version line"]
    torn = gzip.compress(parts[3])[:-20]
    assert [f[3] for f in read(torn)] == ["truncated"]


def test_wrong_digests_are_caught():
    good = W.record(1, "u", b"payload", None)
    bad = good.replace(b"payload\r\n\r\n", b"paxload\r\n\r\n")
    found = read(good + bad + good)
    assert [f[3] for f in found] == [None, "wrong block digest", None]


def test_salvage_of_plain_records_behind_gzip_bytes_and_mixed_files():
    parts = [W.record(i, "u", gzip.compress(b"body %d" % i * 50), None) for i in range(4)]
    data = bytearray(b"".join(parts))
    data[3] ^= 255  # first version line; the first payload is gzip
    found = read(bytes(data))
    covered(found, bytes(data))
    assert [f[3] for f in found] == ["no version line", None, None, None]
    mixed = parts[0] + W._member(parts[1]) + b"junk" + parts[2] + b"junk" + W._member(parts[3])
    found = read(mixed)
    covered(found, mixed)
    assert [f[2] and f[2]["head"]["WARC-Record-ID"] for f in found] == [
        "<urn:page:0>", "<urn:page:1>", None, "<urn:page:2>", None, "<urn:page:3>"]


def plain(head, block, version="1.1"):
    text = "".join(f"{line}\r\n" for line in head)
    return f"WARC/{version}\r\n{text}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def digests(data, kind):
    raw = hashlib.new(kind, data).digest()
    b32 = base64.b32encode(raw).decode()
    return [f"{kind}:{raw.hex()}", f"{kind.upper()}:{raw.hex().upper()}", f"{kind}:{b32}", f"{kind}:{b32.lower()}",
            f"{kind}: {b32.rstrip('=')}"]


@pytest.mark.parametrize("kind", ["md5", "sha1", "sha256", "sha512"])
def test_digests_of_any_known_form_are_checked(kind):
    block = b"HTTP/1.1 200 OK\r\n\r\n<p>body"
    for value in digests(block, kind):
        head = ["WARC-Type: response", f"WARC-Block-Digest: {value}"]
        good, bad = plain(head, block), plain(head, block.replace(b"body", b"bodY"))
        assert [f[3] for f in read(good)] == [None]
        assert [f[3] for f in read(bad)] == ["wrong block digest"]


def test_unknown_and_broken_digests_crash_nothing(spark, tmp_path):
    revisit = b"HTTP/1.1 304 Not Modified\r\nContent-Length: 7\r\n\r\n"
    values = ["sha256:" + "0" * 64, "md5:xyz", "sha1:!!!!", "crc32:1234", "sha1", "", ":", "blake3:00"]
    data = b"".join(W._member(plain(["WARC-Type: revisit", f"WARC-Payload-Digest: {v}"], revisit)) for v in values)
    response = b"HTTP/1.1 200 OK\r\n\r\nabc"
    data += W._member(plain(["WARC-Type: response", "WARC-Payload-Digest: sha256:" + hashlib.sha256(b"abc").hexdigest()], response))
    (tmp_path / "a.warc.gz").write_bytes(data)
    manifest = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",)], "path string")
    rows = sorted(W.read_archives(manifest).collect(), key=lambda r: r.start)
    assert [r.gap for r in rows] == [None] * 9 and {r.payload_digest for r in rows[:8]} == {None}
    assert rows[8].payload_digest == hashlib.sha1(b"abc").hexdigest() and rows[0].payload_bytes == 7


def test_foreign_headers_are_read():
    block = b"HTTP/1.1 200 OK\r\n\r\nx"
    heads = [["warc-type: response", "warc-record-id: <urn:page:1>"], ["WARC-Type:response", "WARC-Record-ID:<urn:page:2>"],
             ["WARC-Type: response", "WARC-Target-URI: http://h/a", "\tb c", "WARC-RECORD-ID:  <urn:page:3>  "]]
    data = b"".join(plain(h, block, v) for h, v in zip(heads, ["0.17", "0.18", "1.0"]))
    data += data.replace(b"Content-Length: ", b"content-length :")
    found = read(data)
    assert [f[2]["head"]["WARC-Record-ID"] for f in found] == [f"<urn:page:{i}>" for i in (1, 2, 3)] * 2
    assert found[2][2]["head"]["warc-target-uri"] == "http://h/a b c"
    assert [f[2]["head"]["WARC-Record-ID"] for f in read(b"".join(map(W._member, map(plain, heads, [block] * 3))))] == [
        f"<urn:page:{i}>" for i in (1, 2, 3)]


def test_reads_are_bounded(monkeypatch):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + b"x" * 50
    good = plain(["WARC-Type: response", "WARC-Record-ID: <urn:page:9>"], block)
    long = plain(["WARC-Type: response"], b"y" * 5000)
    # a length that was made longer ends inside another record: the body isn't read
    wrong = good.replace(f"Content-Length: {len(block)}".encode(), b"Content-Length: 4000")
    asked = []
    whole = W._Reader.get
    monkeypatch.setattr(W._Reader, "get", lambda self, at, n: (asked.append(n), whole(self, at, n))[1])
    found = read(wrong + long + good)
    assert [f[3] for f in found] == ["wrong length", None, None] and max(asked) <= W._CHUNK
    monkeypatch.setattr(W, "MAX_RECORD", 2000)
    assert [f[3] for f in read(long + good)] == ["too long", None]
    assert [f[3] for f in read(W._member(long) + W._member(good))] == ["too long", None]
