import base64
import gzip
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import warc


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def record(i, body=b"payload", kind="response"):
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    return (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{i}>\r\nWARC-Block-Digest: sha1:{digest(block)}\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def ids(data):
    return [r["record_id"].split(":")[-1][:-1] for r in warc.salvage(data) if r["kind"] == "record"]


def covered(data):
    at = 0
    for r in warc.salvage(data):
        assert r["offset"] == at
        at += r["length"]
    return at == len(data)


def test_whole_archives():
    data = b"".join(record(i) for i in range(5))
    assert ids(data) == list("01234") and covered(data)
    assert not list(warc.salvage(b""))


def test_damage_is_skipped_and_logged():
    parts = [record(i, b"see WARC/1.1\r\nin the text " * i) for i in range(6)]
    for broken in (parts[2][:40] + b"?" * 20 + parts[2][60:], parts[2][:-30], parts[2].replace(b"text", b"tEXt", 1), b"junk\n" + parts[2].replace(b"WARC/1.1", b"WARK/1.1", 1)):
        data = b"".join([*parts[:2], broken, *parts[3:]])
        assert ids(data) == list("01345") and covered(data)
        gaps = [r for r in warc.salvage(data) if r["kind"] == "gap"]
        assert len(gaps) == 1 and gaps[0]["reason"] and gaps[0]["offset"] == len(parts[0] + parts[1])
        assert gaps[0]["length"] == len(broken)


def test_members():
    members = [gzip.compress(record(i)) for i in range(5)]
    assert ids(b"".join(members)) == list("01234")
    bad = bytearray(members[2])
    bad[20:30] = b"\0" * 10
    assert ids(b"".join([*members[:2], bytes(bad), *members[3:]])) == list("0134")
    assert ids(b"".join(members)[:-8]) == list("0123")
    assert ids(members[0] + b"\x1f\x8b\x08junk" + members[1]) == list("01")
    assert ids(gzip.compress(b"".join(record(i) for i in range(3)))) == list("012")


def test_gzip_archives_with_a_damaged_front():
    members = [gzip.compress(record(i)) for i in range(4)]
    whole = b"".join(members)
    for broken in (b"\0" + whole[1:], whole[:1] + b"\0" + whole[2:], whole[7:]):
        assert ids(broken) == list("123") and covered(broken)
    assert ids(b"junk" + whole) == list("0123") and covered(b"junk" + whole)
    assert ids(record(7) + whole) == list("70123")


def test_a_broken_member_gives_what_comes_before_the_damage():
    noise = [hashlib.sha512(b"%d" % i).hexdigest().encode() * 30 for i in range(40)]
    one = gzip.compress(b"".join(record(i, b) for i, b in enumerate(noise)))
    kept = ids(one[: len(one) // 2])
    assert 10 < len(kept) < 40 and kept == [str(i) for i in range(len(kept))]
    bad = bytearray(one)
    bad[len(bad) // 2 : len(bad) // 2 + 9] = b"\xff" * 9
    kept = ids(bytes(bad) + gzip.compress(record(99)))
    assert kept[-1] == "99" and len(kept) > 10 and kept[:10] == [str(i) for i in range(10)]
    assert ids(one[:-8] + b"\1" * 8) == [str(i) for i in range(39)]
    gaps = [r for r in warc.salvage(one[:-8]) if r["kind"] == "gap"]
    assert [(r["offset"], r["length"], r["reason"]) for r in gaps] == [(0, len(one) - 8, "truncated member")]


@settings(max_examples=80, deadline=None)
@given(st.data())
def test_any_damage_loses_only_what_it_touches(data):
    parts = [record(i, bytes([65 + i]) * 20) for i in range(4)]
    whole = bytearray(b"".join(parts))
    a = data.draw(st.integers(0, len(whole) - 1))
    b = data.draw(st.integers(a, min(a + 40, len(whole))))
    whole[a:b] = data.draw(st.binary(max_size=20))
    starts = [sum(map(len, parts[:i])) for i in range(5)]
    safe = [str(i) for i in range(4) if starts[i + 1] <= a or starts[i] >= b]
    assert set(safe) <= set(ids(bytes(whole))) and covered(bytes(whole))


def test_round_trip(spark):
    rows = [(3, "http://a", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "x y\r\nz", ""), (5, "u", None), (4, "u", "long " * 20000), (4, "u", "long " * 20000), (None, "u", "<p>é</p>"), (None, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for least in (0, 1000):
        got = sorted((tuple(r) for r in warc.archive_pages(pages, least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
        wanted = []
        for i, _, html in rows:
            body = (html or "").encode()
            same = [p for p, _, h in rows if (h or "") == (html or "")]
            first = min((p for p in same if p is not None), default=None)
            again = len(same) > 1 and len(body) >= least and i != first
            wanted.append((i, len(body), digest(body), "revisit" if again else "response", first if again else None))
        assert got == sorted(wanted, key=str)
    assert warc.archive_pages(pages.filter("false")).count() == 0


def test_compressed_archives_are_read(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"p{i}") for i in range(30)], "page_id long, url string, html string")
    warc.write_warc(pages, str(tmp_path / "w"), warc.repeated_payloads(pages), records_per_file=7, compression="gzip")
    got = warc.read_warc(spark, str(tmp_path / "w"), payloads=True, pattern="*.gz")
    assert sorted(bytes(r.payload).decode() for r in got.collect()) == sorted(f"p{i}" for i in range(30))
    for file in (tmp_path / "w").glob("*.gz"):
        data = file.read_bytes()
        bad = bytearray(data)
        bad[20] ^= 255  # in the first of a member for each record
        assert len(ids(bytes(bad))) == len([r for r in warc.salvage(data) if r["kind"] == "record"]) - 1


def test_every_character_in_a_url(spark):
    """Only line feeds end a header's line, whatever other code points separate lines elsewhere."""
    separators = [0x0B, 0x0C, 0x0D, 0x0A, 0x1C, 0x1D, 0x1E, 0x85, 0xA0, 0x2028, 0x2029, 0x3000, 0xFEFF, 0x1F600]
    pages = spark.createDataFrame([(i, f"{chr(c)}http://h/{chr(c)}x{chr(c)}", f"p{i}") for i, c in enumerate(separators)], "page_id long, url string, html string")
    assert sorted(r.page_id for r in warc.archive_pages(pages).collect()) == list(range(len(separators)))


def test_header_lines_that_go_on():
    head = record(1).replace(b"Content-Type: application/http", b"WARC-Target-URI: a\r\n  b\r\n\tc\r\nContent-Type: application/http")
    assert [r["target_uri"] for r in warc.salvage(head)] == ["a b c"]


def test_a_record_in_a_damaged_payload_is_none():
    inner = record("inner")
    broken = record(1, b"before " + inner + b" after").replace(b"before", b"BEFORE", 1)
    for after in (b"", record(2), record(2).replace(b"payload", b"PAYLOAD", 1), gzip.compress(record(2))):
        data = record(0) + broken + after
        assert "inner" not in ids(data) and covered(data)
        gap = next(r for r in warc.salvage(data) if r["kind"] == "gap")
        assert (gap["offset"], gap["length"], gap["reason"]) == (len(record(0)), len(broken), "block digest")


def test_digests_of_every_kind():
    def declared(name, value):
        body = b"payload"
        block = b"HTTP/1.1 200 OK\r\n\r\n" + body
        return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\n{name}: {value}\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    for kind in ("sha1", "sha256", "md5", "SHA-256"):
        h = hashlib.new(kind.lower().replace("-", ""), b"payload")
        for value in (h.hexdigest(), base64.b32encode(h.digest()).decode()):
            assert ids(declared("WARC-Payload-Digest", f"{kind}:{value}")) == ["1"]
            wrong = value[:3] + ("A" if value[3] != "A" else "B") + value[4:]
            assert [r["reason"] for r in warc.salvage(declared("WARC-Payload-Digest", f"{kind}:{wrong}"))] == ["payload digest"]
    assert ids(declared("WARC-Payload-Digest", "crc99:1234")) == ["1"]


def test_members_are_read_in_linear_time():
    import time

    member = gzip.compress(record(1, b"x" * 900))
    took = []
    for many in (4_000, 32_000):
        began = time.process_time()
        assert sum(1 for r in warc.salvage(member * many) if r["kind"] == "record") == many
        took.append(time.process_time() - began)
    assert took[1] < 20 * took[0]


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([(1, "u", "a"), (2, "u", "a")], "page_id long, url string, html string")
    wide = pages.select("*", *[F.lit("x").alias(c) for c in ("digest", "id", "payload", "first_id", "copies", "bytes", "revisit", "block", "value")])
    got = sorted(tuple(r) for r in warc.archive_pages(wide).select("page_id", "record_type", "refers_to").collect())
    assert got == [(1, "response", None), (2, "revisit", 1)]


def test_archives_are_bounded_in_bytes(spark, tmp_path):
    sizes = [10] * 40 + [999, 1000, 1001, 7000] + [9000] * 7 + [70000, 90000, 0]
    noise = lambda i, n: "".join(hashlib.sha512(b"%d %d" % (i, k)).hexdigest() for k in range(n // 128 + 1))[:n]  # noqa: E731  does not compress to much under half
    pages = spark.createDataFrame([(i, "u", noise(i, n)) for i, n in enumerate(sizes)] + [(99, "u", None)], "page_id long, url string, html string").repartition(1)
    firsts = warc.repeated_payloads(pages).filter("false")
    for compression in ("none", "gzip"):
        out = tmp_path / compression
        warc.write_warc(pages, str(out), firsts, records_per_file=64, compression=compression, bytes_per_file=64_000)
        files = [f for f in out.iterdir() if f.name.startswith("part-")]
        for file in files:
            held = [r for r in warc.salvage(file.read_bytes()) if r["kind"] == "record"]
            assert len(held) <= 64 and (len(held) == 1 or sum(r["payload_bytes"] for r in held) <= 64_000 or compression == "gzip")
        got = warc.read_warc(spark, str(out), pattern="part-*")
        assert sorted(r.payload_bytes for r in got.collect()) == sorted([*sizes, 0]) and len(files) > 1
    whole = warc.size_classes(2000, 256 << 20)
    assert all((a[1], a[2] // 8 or 1) == (b[0], b[2]) or b[2] == 1 for a, b in zip(whole, whole[1:], strict=False)) and whole[-1][1:] == (None, 1)
    assert all(most * records <= 256 << 20 for _, most, records in whole[:-1])


def test_version_lines_without_a_header_are_passed_in_linear_time():
    import time

    for tail in (b"", b"\r\n\r\n"):
        took = []
        for many in (50_000, 400_000):
            data = record(1) + b"WARC/1.1\r\n" * many + tail + record(2)
            began = time.process_time()
            assert ids(data) == ["1", "2"] and covered(data)
            took.append(time.process_time() - began)
        assert took[1] < 24 * took[0]
