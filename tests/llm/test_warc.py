"""WARC archives: round trips, normalised members, index, revisits."""

import base64
import gzip
import hashlib
import io
import os
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadenza.llm import warc
from cadenza.llm.base import prepare

PAGES = "page_id long, url string, html string"


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def plain(rows, least=0):
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = Counter()
    for i, _, t in rows:
        t = t or ""
        n, f = len(t.encode()), first.get(t)
        revisit = n >= least and f is not None and i != f
        out[i, n, digest(t), "revisit" if revisit else "response", f if revisit else None] += 1
    return out


ROWS = [(1, "http://a/ü?x=1&y=%41", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u\r\nX: y", None), (4, "u", ""), (None, None, None),
        (None, "u", "<p>é</p>"), (7, "u", "WARC/1.1\r\nContent-Length: 9\r\n\r\nx\r\n\r\n"), (7, "u", "again"), (7, "u", "again"),
        (9, "u", "long " * 200000), (8, "u", "long " * 200000), (10, "u", "\r\n\r\n")]


@pytest.mark.parametrize("least", [0, 5])
def test_roundtrip_equals_the_plain_version(spark, least):
    prepare(spark)
    pages = spark.createDataFrame(ROWS, PAGES).withColumn("payload", F.lit("x")).withColumn("refers_to", F.lit("x")).withColumn("_sha", F.lit("x"))
    got = warc.roundtrip(spark, pages, least).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == plain(ROWS, least)
    urls = Counter((r.page_id, r.url) for r in got)
    assert urls == Counter((i, u) for i, u, _ in ROWS)
    bodies = {t or "" for _, _, t in ROWS}
    assert all(bytes(r.payload).decode() in bodies for r in got if r.record_type == "response")


def test_empty_table(spark):
    prepare(spark)
    assert warc.roundtrip(spark, spark.createDataFrame([], PAGES)).count() == 0


def test_each_record_is_a_member_at_its_offset(spark, tmp_dir):
    prepare(spark)
    rows = spark.createDataFrame([(str(k), f"u{k}", bytearray(os.urandom(50 * k)), None) for k in range(40)],
                                 "page_id string, url string, payload binary, refers_to string").repartition(3)
    raw = warc.write_archives(rows, tmp_dir + "/raw", roll=8000)
    one = warc.normalise(raw, tmp_dir + "/members").collect()
    raw = raw.collect()
    assert len(raw) > 3 and sum(r.n_records for r in raw) == sum(r.n_records for r in one) == 40
    for r in raw:
        z = zlib.decompressobj(31)                 # the whole file is one stream
        z.decompress(open(r.path, "rb").read())
        assert z.eof and not z.unused_data
    for r in one:
        data = open(r.path, "rb").read()
        index = [tuple(map(int, x.split())) for x in open(r.index_path)]
        assert len(index) == r.n_records and sum(n for _, n in index) == len(data)
        for at, n in index:
            z = zlib.decompressobj(31)
            fields, payload = warc.parse(z.decompress(data[at:at + n]))
            assert z.eof and not z.unused_data
            assert fields["warc-payload-digest"] == "sha1:" + warc.payload_digest(payload)


@pytest.mark.parametrize("members", [1, 3])
def test_inflater_takes_any_members_and_reads(members, monkeypatch):
    monkeypatch.setattr(warc, "READ", 7)
    records = [warc.record(k, "u", b"x\r\n\r\n" * k) for k in range(9)]
    step = -(-len(records) // members)
    data = b"".join(gzip.compress(b"".join(records[k:k + step])) for k in range(0, 9, step))
    assert list(warc.Inflater(io.BytesIO(data)).records()) == records


def test_cut_file_is_an_error():
    data = gzip.compress(warc.record(1, "u", b"x" * 100)[:-20])
    with pytest.raises(ValueError):
        list(warc.Inflater(io.BytesIO(data)).records())
