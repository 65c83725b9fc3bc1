import hashlib

import pytest
from helpers import oracle_rows, result_rows

from conftest import SF_SMALL
from dimstar.llm import queries as Q
from dimstar.llm import warc as W
from dimstar.llm.files import Reader, opened

PAGES = "page_id bigint, url string, html string, id string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], PAGES)


def test_query_matches_oracle(spark):
    name = "op10_warc"
    assert result_rows(Q.queries()[name](spark, SF_SMALL)) == oracle_rows(SF_SMALL, Q.oracle_sql()[name])


@pytest.mark.parametrize("range_size", [64, 1000, 1 << 20])
def test_records_inside_payloads_are_rejected(spark, range_size):
    fake = W.record(99, "http://fake", b"inner payload", "0" * 64, False, None).decode()
    rows = [(1, "http://a/1", "x" * 700), (2, "http://a/2", f"before {fake} after {fake}"), (3, "http://a/3", fake[:40]),
            (4, "http://a/4", "WARC/1.1\r\nContent-Length: 5\r\n\r\n"), (5, "http://a/5", "x" * 700), (6, None, None),
            (7, "http://a\r\nContent-Length: 1", ""), (8, "http://a/8", "WARC/1." * 50)]
    archives = W.write(pages(spark, rows).coalesce(1))
    got = {r.page_id: r for r in W.read(archives, range_size).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7, 8]
    for i, _, html in rows:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
    assert {i: (r.record_type, r.refers_to) for i, r in got.items() if r.record_type == "revisit"} == {5: ("revisit", 1)}
    row = archives.first()
    file = Reader(row.folder, row.file)
    assert len(W.candidates(file, 0, row.size)) > len(rows)
    file.close()


@pytest.mark.parametrize("size", ["9" * 20, "9" * 5000, "1" + "0" * 12])
def test_lengths_beyond_the_file_are_rejected(spark, size):
    fake = f"WARC/1.1\r\nContent-Length: {size}\r\n\r\n"
    rows = [(1, "http://a/1", f"before {fake} after"), (2, "http://a/2", "plain")]
    got = {r.page_id: r.payload_bytes for r in W.read(W.write(pages(spark, rows).coalesce(1)), 64).collect()}
    assert got == {i: len(html) for i, _, html in rows}


@pytest.mark.parametrize("range_size", [1000, 1 << 20])
def test_headers_of_any_length(spark, range_size):
    fake = "WARC/1.1\r\nName: " + "v" * 200_000
    rows = [(1, "http://a/1", "x"), (2, "http://a/" + "u" * 300_000, "y"), (3, "http://a/3", fake)]
    got = {r.page_id: (r.url, r.payload_bytes) for r in W.read(W.write(pages(spark, rows).coalesce(1)), range_size).collect()}
    assert got == {i: (url, len(html)) for i, url, html in rows}


def test_broken_archive_fails(spark):
    archives = W.write(pages(spark, [(i, "http://a", "y" * 500 + str(i)) for i in range(5)]).coalesce(1))
    row = archives.first()
    system, path = opened(row.folder)
    with system.open_input_file(f"{path}/{row.file}") as f:
        data = f.read()
    with system.open_output_stream(f"{path}/{row.file}") as f:
        f.write(data[:-20])
    with pytest.raises(ValueError, match=row.file):
        W.read(W.archive_list(spark, row.folder).filter(f"file = '{row.file}'"))


def test_defined_cases(spark):
    long = "z" * 3_000_000
    rows = [(3, "u", long), (2, "u", long), (2, "u", long), (None, "u", long), (None, "u", "w" * 200), (9, "u", "short"),
            (8, "u", "short"), (7, None, None)]
    archives = W.write(pages(spark, rows).repartition(3))
    got = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in W.read(archives).collect())
    assert got == sorted([("3", "revisit", 2, 3_000_000), ("2", "response", None, 3_000_000),
                          ("2", "response", None, 3_000_000), ("None", "revisit", 2, 3_000_000),
                          ("None", "response", None, 200), ("9", "response", None, 5), ("8", "response", None, 5),
                          ("7", "response", None, 0)])
    listed = W.archive_list(spark, archives.first().folder)
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, archives.collect()))
    assert W.read(W.write(pages(spark, []))).count() == 0
