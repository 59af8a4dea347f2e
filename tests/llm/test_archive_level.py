"""Archives are packed at a level at which the time of packing doesn't outweigh the rest."""

import glob
import gzip
import zlib

from formfields.llm import web_archive as W


def test_archives_are_packed_lightly(spark, tmp_path):
    text = " ".join(f"word{k * k % 977} of {k % 61} in {k * 7 % 113}" for k in range(40000))
    pages = spark.createDataFrame([(1, "http://a.org/", text)], "page_id long, url string, html string").coalesce(1)
    W.write_arc(pages, str(tmp_path / "arc"))
    W.archive_to_warc(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    for kind in ("arc", "warc"):
        [file] = glob.glob(str(tmp_path / kind / "*.gz"))
        content = gzip.open(file).read()
        size = {level: len(zlib.compress(content, level)) for level in (4, 6)}
        held = len(open(file, "rb").read())
        assert abs(held - size[4]) < abs(held - size[6])
    [row] = W.read_warc(spark, str(tmp_path / "warc")).collect()
    assert row["payload"].decode() == text
