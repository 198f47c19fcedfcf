"""Archives: round trip against hashes of the pages, the index, coalesced reads."""

import gzip
import hashlib

from pyspark.sql import types as T

from reportlens.llm import warc
from reportlens.llm.common import shared_path

SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("digest", T.StringType()),
        T.StructField("offset", T.StringType()),
    ]
)


def pages():
    out = [(k, f"http://h.example/{k}", f"<p>{k % 40}</p>" * 20, "d", "o") for k in range(300)]
    out += [(1000, None, None, None, None), (1001, "http://ü.example/a b\r\nX: y", "", "", ""), (1002, "u", "short", "", "")]
    out += [(1003, "u", "short", "", ""), (None, "u", "<p>3</p>" * 20, "", ""), (None, "u", "lonely " * 30, "", "")]
    out += [(1004, "u", "é\r\n\r\n😀" * 50_000, "", ""), out[5], (999, "u", "twice " * 40, "", ""), (999, "u", "twice " * 40, "", "")]
    return out


def expected(rows):
    first = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, page_id), page_id)
    out = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        original = first.get(html)
        again = original is not None and original != page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", original if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows = pages()
    got = warc.round_trip(spark, spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
    assert warc.round_trip(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_selected_records_by_index(spark):
    rows = pages()
    folder = shared_path(spark, "warc-test")
    index = warc.write(spark.createDataFrame(rows, SCHEMA), folder)
    some = index.where("page_id % 7 = 0")
    got = {r["page_id"]: r for r in warc.read(some, folder).collect()}
    assert set(got) == {r[0] for r in rows if r[0] is not None and r[0] % 7 == 0}
    for page_id, url, html, *_ in rows:
        if page_id in got and got[page_id]["record_type"] == "response":
            assert bytes(got[page_id]["payload"]) == (html or "").encode()
    one = index.first()
    store, root = warc.filesystem(folder)
    with store.open_input_file(f"{root}/{one['file']}") as source:
        data = source.read_at(one["length"], one["offset"])
    assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_ranges_join_neighbours():
    near = [(0, 10), (10, 5), (20, 5)]
    assert list(warc.ranges(near)) == [(0, 25, near)]
    far = [(0, 10), (10 + warc.GAP_BYTES + 1, 5)]
    assert [r[:2] for r in warc.ranges(far)] == [(0, 10), (far[1][0], far[1][0] + 5)]
    large = [(0, warc.READ_BYTES), (warc.READ_BYTES, 1)]
    assert len(list(warc.ranges(large))) == 2 and list(warc.ranges([])) == []
