import hashlib

import pytest
import zstandard

from ledgerloom.llm import warc_bundles as W
from ledgerloom.session import scratch_path

LONG, OTHER = "<p>é</p>" * 200, "<p>x</p>" * 500
ROWS = [(1, "http://a/ b\r\nx", LONG), (2, None, LONG), (7, "u", LONG), (3, "v", OTHER), (4, "w", "short"),
        (5, "w", "short"), (6, "y", None), (None, "z", LONG), (9, "q", OTHER), (9, "q", OTHER)]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*r, "x") for r in ROWS], "page_id bigint, url string, html string, payload string")


def test_round_trip(spark, pages):
    folder = scratch_path(spark, "warc")
    index = W.write_bundles(pages.coalesce(1), folder, frame_bytes=1500, bundle_bytes=300)
    got = W.read_bundles(spark, index, folder).collect()
    assert len(got) == len(ROWS) == index.count()
    refers = {1: 7, 2: 7, 3: 9}
    for row in got:
        html = next((h for p, _, h in ROWS if p == row.page_id), None) or ""
        assert row.refers_to == refers.get(row.page_id)
        assert row.record_type == ("revisit" if row.refers_to else "response")
        assert row.payload_bytes == len(html.encode())
        assert row.payload_digest == hashlib.sha1(html.encode()).hexdigest()
        assert (None if row.payload is None else bytes(row.payload)) == (None if row.refers_to else html.encode())
    one = W.read_records(index.where("page_id = 7"), folder).collect()
    assert [(r.page_id, bytes(r.payload).decode()) for r in one] == [(7, LONG)]
    assert index.select("bundle").distinct().count() > 1 and index.agg({"frame": "max"}).first()[0] > 0


def test_bundles_are_plain_zstandard(spark, pages):
    folder = scratch_path(spark, "warc")
    index = W.write_bundles(pages, folder)
    for row in index.select("bundle").distinct().collect():
        path = f"{folder.removeprefix('file://')}/bundles/{row.bundle}"
        with open(path, "rb") as file, zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True) as plain:
            assert plain.read().startswith(b"WARC/1.1\r\n")


def test_damage_is_found(spark, pages):
    fields, block, _ = W.parse_record(memoryview(W.record_bytes(1, "u", b"abc", "0" * 40, None, False, "d")), 0)
    with pytest.raises(ValueError):
        W._row(fields, block)


def test_empty(spark, pages):
    folder = scratch_path(spark, "warc")
    index = W.write_bundles(pages.limit(0), folder)
    assert index.count() == 0 and W.read_bundles(spark, index, folder).count() == 0
