"""Archives: exact round trips of bytes, damaged and legacy files, ties and empty tables."""

import base64
import gzip
import hashlib

from formfields.llm import web_archive as A

SCHEMA = "page_id long, url string, html binary, record_id string, http string"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", "clash") for i, u, h in rows], SCHEMA)


def read_back(spark, at):
    A.archive_to_warc(spark, f"{at}/arc", f"{at}/warc")
    return A.read_warc(spark, f"{at}/warc").collect()


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_round_trip_of_bytes(spark, tmp_path):
    tricky = [b"", b"caf\xe9 latin-1", "é".encode(), b"\x00\xff\r\n\r\nWARC/1.1\r\nHTTP/1.0\n\n", b"\r\n" * 50, b"x" * 200_000, bytes(range(256)) * 300]
    rows = [(k, f"http://a/{k} with blanks", p) for k, p in enumerate(tricky)] + [(20, None, None), (21, "", b"caf\xe9 latin-1")]
    for version in (1, 2):
        at = f"file://{tmp_path}/{version}"
        A.write_arc(table(spark, rows), f"{at}/arc", version)
        found = {r.page_id: r for r in read_back(spark, at)}
        assert len(found) == len(rows)
        for k, p in enumerate(tricky):
            r = found[k]
            assert r.payload_bytes == len(p) and r.payload_digest == sha(p)
            assert bytes(r.payload) == (b"" if r.record_type == "revisit" else p)
        assert found[1].record_type == "revisit" and found[1].refers_to == 21 and found[21].record_type == "response"
        assert found[0].refers_to == 20 and found[20].url == "unknown:"


def test_repeated_rows_and_null_ids(spark, tmp_path):
    at = f"file://{tmp_path}/r"
    A.write_arc(table(spark, [(5, "http://a", b"same"), (5, "http://a", b"same"), (None, "http://b", b"same"), (None, "http://c", b"own")]), f"{at}/arc")
    found = read_back(spark, at)
    assert len(found) == 4 and len({r.record_id for r in found}) == 4
    same = [r for r in found if r.payload_digest == sha(b"same")]
    assert sorted(r.record_type for r in same) == ["response", "revisit", "revisit"]
    assert all(r.refers_to == 5 for r in same if r.record_type == "revisit")


def test_an_empty_table(spark, tmp_path):
    at = f"file://{tmp_path}/e"
    A.write_arc(table(spark, []), f"{at}/arc")
    assert read_back(spark, at) == []


def legacy(version, *records):
    about = f"{version} 0 someone\n{A.ARC_FIELDS[version]}\n".encode()
    return b"filedesc://x.arc 0.0.0.0 19970101000000 text/plain " + (b"200 - - 0 x.arc " if version == 2 else b"") + f"{len(about)}\n".encode() + about + b"\n" + b"\n".join(records) + b"\n"


def record(line, block):
    return f"{line} {len(block)}\n".encode("latin-1") + block


def test_legacy_files_with_damage(spark, tmp_path):
    page = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\n<p>caf\xe9</p>"
    unix = b"HTTP/1.0 200 OK\nServer: y\n\n<p>two</p>"
    content = legacy(
        1, record("http://a/one 1.2.3.4 19970203040506 text/html", page), b"garbage that is no record line",
        record("http://a/with blank in it 1.2.3.4 19970203040507 text/html", unix), record("dns:a 1.2.3.4 19970203 text/dns", b"a. 1 IN A 1.2.3.4"), b"http://a/x 1.2.3.4 1997 text/html NaN",
        record("http://a/three 1.2.3.4 bad-date text/html", page),
    )
    for name, data in (("plain.arc", content), ("packed.arc.gz", gzip.compress(content))):
        at = tmp_path / name.split(".")[0]
        (at / "arc").mkdir(parents=True)
        (at / "arc" / name).write_bytes(data)
        found = {r.url: r for r in read_back(spark, f"file://{at}")}
        assert set(found) == {"http://a/one", "http://a/with blank in it", "dns:a", "http://a/three"}
        kinds = {u: r.record_type for u, r in found.items()}
        assert kinds["dns:a"] == "resource" and bytes(found["dns:a"].payload) == b"a. 1 IN A 1.2.3.4"
        assert sorted([kinds["http://a/one"], kinds["http://a/three"]]) == ["response", "revisit"]
        assert bytes(found["http://a/with blank in it"].payload) == b"<p>two</p>"
        assert found["http://a/one"].date == "1997-02-03T04:05:06Z" and found["dns:a"].date == "1997-02-03T00:00:00Z"
        lost = A.skipped_bytes(spark, f"file://{at}/arc").collect()
        assert [r.skipped for r in lost] == [len(b"garbage that is no record line\n") + len(b"http://a/x 1.2.3.4 1997 text/html NaN\n")]


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(A, "FILE_RECORDS", 8)
    monkeypatch.setattr(A.size_class, "__defaults__", (None, 800))
    monkeypatch.setattr(A, "WARC_BYTES", 800)
    rows = [(k, f"http://a/{k}", b"s%3d" % k + b"s" * 46) for k in range(20)] + [(100 + k, f"http://b/{k}", b"m" * 700 + b"%d" % k) for k in range(5)]
    A.write_arc(table(spark, rows).coalesce(1), f"file://{tmp_path}/arc")
    counts = sorted(sum("skipped" not in r for r in A.arc_records(gzip.decompress(f.read_bytes()))) for f in (tmp_path / "arc").glob("*.gz"))
    assert counts == [1] * 5 + [4, 8, 8]
    assert len(read_back(spark, f"file://{tmp_path}")) == 25
    held = [[int(h["X-Payload-Length"]) for h, _ in A.warc_records(gzip.decompress(f.read_bytes()))] for f in (tmp_path / "warc").glob("*.gz")]
    assert sum(map(len, held)) == 25 and all(len(sizes) == 1 or sum(sizes) <= 800 for sizes in held)


def test_empty_archives(spark, tmp_path):
    A.write_arc(table(spark, []), f"file://{tmp_path}/arc")
    assert read_back(spark, f"file://{tmp_path}") == []
