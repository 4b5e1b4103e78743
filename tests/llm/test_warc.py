import base64
import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from episodeframe.llm import warc

ROWS = [(1, "http://a.com/x y", "<p>one</p>"), (2, "http://b.com/\r\nX: y", "<p>one</p>"), (3, None, None), (0, "u", ""), (5, "u", "é" * 70_000),
        (None, "n", "<p>one</p>"), (7, "u", "WARC/1.1\r\n\r\n"), (9, "u", "\x1f\x8b\x08 not a member"), (9, "u", "\x1f\x8b\x08 not a member")]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")


@pytest.mark.parametrize("split", [1 << 20, 97, 1])
def test_round_trip_for_any_split(spark, split):
    files = warc.archive(pages(spark).coalesce(2))
    got = warc.read(files, split).collect() if split > 1 else warc.read(files.where("bytes < 3000"), split).collect()
    if split == 1:
        assert len(got) == files.where("bytes < 3000").agg(F.sum("records")).first()[0]
        return
    assert sum(r.records for r in files.collect()) == len(got) == len(ROWS)
    html = {}
    for i, _, h in ROWS:
        html[i] = (h or "").encode()
    for r in got:
        want = html[r.page_id]
        assert r.payload_bytes == len(want)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(want).digest()).decode()
        assert (r.payload is None) == (r.record_type == "revisit") and (r.payload is None or r.payload == want)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert kinds[1] == ("response", None) and kinds[2] == kinds[None] == ("revisit", 1)
    assert kinds[0] == ("response", None) and kinds[3] == ("revisit", 0)
    assert Counter(r.record_type for r in got if r.page_id == 9) == {"response": 2}
    assert next(r.url for r in got if r.page_id == 2) == "http://b.com/%0D%0AX:%20y"


def test_least_bytes_and_empty_table(spark):
    got = warc.read(warc.archive(pages(spark), least_bytes=1)).collect()
    assert {r.page_id for r in got if r.record_type == "response"} >= {0, 3}
    assert warc.read(warc.archive(pages(spark).limit(0))).count() == 0


def test_foreign_bytes_and_false_magic_are_skipped(tmp_path):
    def record(i, body):
        return warc.gzip_member(warc.record_bytes(i, "u", body, warc.base32_sha1(body), False, None))
    inner = warc.gzip_member(b"not a record") + b"\x1f\x8b\x08garbage"
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)  # the magic stands verbatim in a stored block
    data = b"junk" + record(1, b"a") + inner + record(2, inner * 3) + (stored.compress(warc.record_bytes(
        3, "u", inner, warc.base32_sha1(inner), False, None)) + stored.flush()) + record(4, b"end")
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    for step in (len(data), 50, 7):
        got = [r["page_id"] for low in range(0, len(data), step) for r in warc.records_in(str(path), low, low + step)]
        assert got == [1, 2, 3, 4], step


def test_a_wrong_digest_is_an_error(tmp_path):
    path = tmp_path / "x.warc.gz"
    path.write_bytes(warc.gzip_member(warc.record_bytes(1, "u", b"a", warc.base32_sha1(b"b"), False, None)))
    with pytest.raises(ValueError):
        list(warc.records_in(str(path), 0, 10_000))
