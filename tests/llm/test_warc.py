import gzip
import hashlib
import json

import pytest

from gridlake.llm import warc


def brute(pages):
    groups = {}
    for i, _, h in pages:
        body = (h or "").encode()
        if len(body) >= 1000:
            groups.setdefault(body, []).append(i)
    out = []
    for i, _, h in pages:
        body = (h or "").encode()
        most = max((x for x in groups.get(body, []) if x is not None), default=None) if len(groups.get(body, [])) > 1 else None
        back = most if most is not None and most != i else None
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if back is not None else "response", back))
    return sorted(out, key=repr)


def test_round_trip(spark):
    big, long_ = "<p>ü</p>" * 200, "x\r\n\r\nWARC/1.1\r\n" * 40_000
    pages = [(1, "http://a/", big), (2, "http://b/", big), (5, None, big), (3, "http://c/\r\nX: y", "short"), (4, "u", "short"),
             (6, "http://d/ü", None), (7, "http://e/", ""), (8, "http://f/", long_), (9, "http://f/", "y" * 999),
             (10, "http://f/", "y" * 999), (None, "http://g/", big), (5, None, big)]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, digest string").repartition(3)
    got = sorted((tuple(r) for r in warc.archive_pages(df).collect()), key=repr)
    assert got == brute(pages)


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_index_leads_to_members(tmp_path):
    records = [warc.record(k, f"http://x/{k}", b"body %d" % k * k * 5000, hashlib.sha1(b"").hexdigest(), None) for k in range(6)]
    whole = tmp_path / "whole.warc.gz"
    whole.write_bytes(gzip.compress(b"".join(records[:3])) + gzip.compress(b"".join(records[3:])))
    assert warc.normalise_file(str(whole), str(tmp_path / "n.warc.gz")) == 6
    data = (tmp_path / "n.warc.gz").read_bytes()
    rows = [json.loads(x) for x in (tmp_path / "n.warc.gz.idx").read_text().splitlines()]
    assert [gzip.decompress(data[r["offset"]:r["offset"] + r["length"]]) for r in rows] == records
    assert gzip.decompress(data) == b"".join(records)


def test_cut_archive_is_an_error(tmp_path):
    data = gzip.compress(warc.record(1, "http://x/", b"z" * 10_000, hashlib.sha1(b"").hexdigest(), None))
    (tmp_path / "cut.warc.gz").write_bytes(data[:len(data) // 2])
    with pytest.raises(ValueError, match="ends early"):
        warc.normalise_file(str(tmp_path / "cut.warc.gz"), str(tmp_path / "out.warc.gz"))
