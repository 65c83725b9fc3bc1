"""Records with quoted line ends, against Python's csv module, with blocks of any size."""

import csv as plain
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from dimstar.sources import csv as CSV
from dimstar.sources.csv_records import records

HEADER = "id,customer_id,supplier_id,operator_id,request_datetime,completed_datetime,status,price,service_duration_minutes,notes\n"
START = "1,1,1,2025-02-01 10:00:00,,booked,40,,"


@pytest.fixture
def split_bytes(spark):
    """Input splits of a given size, so that a small file has many blocks."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}
    def use(n):
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "1")
        spark.conf.set(keys[2], "1")
    yield use
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def read(spark, path):
    return CSV.read_entity(spark, str(path), "requests", keep_corrupt=True)


@pytest.mark.parametrize("size", [40, 70, 1000, 1 << 20])
def test_record_over_three_lines_is_read_whole(spark, split_bytes, tmp_path, size):
    split_bytes(size)
    path = tmp_path / "r.csv"
    path.write_text(HEADER + f'1,{START}"first\n77,1,1,1,2025-02-01 10:00:00,,booked,999.0,,x\nlast"\n2,{START}plain\n'
                    + f'3,{START}"he said ""x""\n\nand, so"\n4,{START}\n')
    df = read(spark, path)
    rows = {r.id: r for r in df.collect()}
    assert set(rows) == {1, 2, 3, 4} and all(r[CSV.CORRUPT] is None for r in rows.values())
    assert rows[1].notes == "first\n77,1,1,1,2025-02-01 10:00:00,,booked,999.0,,x\nlast"
    assert rows[2].notes == "plain" and rows[3].notes == 'he said "x"\n\nand, so' and rows[4].notes is None
    if size < 100:  # several tasks per file
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 3


def random_file(rng, n, line_end):
    """Text of the file, and its rows by Python's csv module."""
    alphabet = ["a", '"', '""', ",", "\n", "\r\n", " ", "è", "x,y", '",', ',"']
    out = io.StringIO(newline="")
    writer = plain.writer(out, lineterminator=line_end)
    writer.writerow(HEADER.strip().split(","))
    for i in range(n):
        notes = "".join(rng.choice(alphabet) for _ in range(rng.randrange(12)))
        writer.writerow([i, *START.split(",")[:-1], notes])
    text = out.getvalue()
    return text, {int(r["id"]): r["notes"] or None for r in plain.DictReader(io.StringIO(text, newline=""))}


@pytest.mark.parametrize("seed, size, line_end", [(1, 64, "\n"), (2, 100, "\r\n"), (3, 300, "\n"), (4, 1 << 20, "\r\n"), (5, 33, "\n")])
def test_random_records(spark, split_bytes, tmp_path, seed, size, line_end):
    split_bytes(size)
    text, want = random_file(random.Random(seed), 60, line_end)
    path = tmp_path / "r.csv"
    path.write_bytes(text.encode())
    got = read(spark, path).collect()
    assert {r.id: r.notes for r in got} == want and len(got) == 60
    assert all(r[CSV.CORRUPT] is None for r in got)


def test_a_record_over_many_blocks_and_files(spark, split_bytes, tmp_path):
    split_bytes(50)
    for f in range(3):
        notes = "\n".join(f'line {k} of ""{f}""' for k in range(40))
        (tmp_path / f"{f}.csv").write_text(HEADER + f'{f},{START}"{notes}"\n{f + 10},{START}"b\n"\n')
    rows = {r.id: r.notes for r in read(spark, tmp_path).collect()}
    assert set(rows) == {0, 1, 2, 10, 11, 12} and rows[11] == "b\n"
    assert rows[2] == "\n".join(f'line {k} of "2"' for k in range(40))


@pytest.mark.parametrize("size", [45, 1 << 20])
def test_a_quote_that_nothing_closes_tears_its_line_only(spark, split_bytes, tmp_path, size):
    split_bytes(size)
    path = tmp_path / "r.csv"
    path.write_text(HEADER + f'1,{START}"a\nb"\n2,{START}"never closed\n3,{START}fine\n4,{START}\n')
    rows = {r.id: (r.notes, r[CSV.CORRUPT]) for r in read(spark, path).collect()}
    assert rows[1] == ("a\nb", None) and rows[3] == ("fine", None) and rows[4] == (None, None)
    assert CSV.TORN in rows[2][1]
    with pytest.raises(Exception, match="malformed record in requests: id 2, quotes"):
        CSV.read_entity(spark, str(path), "requests").collect()


def test_quotes_inside_plain_fields_are_characters(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(HEADER + f'1,{START}5" pipe\n2,{START}a"b"\n3,{START}x\n')
    rows = {r.id: (r.notes, r[CSV.CORRUPT]) for r in read(spark, path).collect()}
    assert rows == {1: ('5" pipe', None), 2: ('a"b"', None), 3: ("x", None)}


def test_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + f'1,{START}"a\nb"\n')
    (tmp_path / "b.csv").write_text(HEADER.replace("price", "cost") + f"2,{START}\n")
    with pytest.raises(Exception, match="another header|price|cost"):
        read(spark, tmp_path).collect()


def test_written_text_comes_back(spark, split_bytes, tmp_path):
    split_bytes(200)
    rng = random.Random(8)
    rows = [(i, 1, 1, 1, dt.datetime(2025, 1, 1, 8, 30, 5), None, "booked", 1.5, None,
             "".join(rng.choice('ab ,"\n\r\t') for _ in range(rng.randrange(1, 25))) + "z") for i in range(80)]
    df = spark.createDataFrame(rows, CSV.REQUESTS_SCHEMA)
    CSV.write_entity(df.coalesce(1), str(tmp_path / "out"))
    assert {r.id: r.notes for r in CSV.read_entity(spark, str(tmp_path / "out"), "requests").collect()} == {r[0]: r[9] for r in rows}


def test_only_border_pieces_are_moved(spark, split_bytes, tmp_path):
    """The scan keeps its records: the one exchange of texts carries pieces."""
    split_bytes(60)
    path = tmp_path / "r.csv"
    path.write_text(HEADER + f'1,{START}"a\nb"\n' * 20)
    plan = records(spark, str(path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("Union")[1].split("Exchange")[0]
    assert records(spark, str(path)).where(~F.col("header")).count() == 20


def test_a_record_is_made_once_and_only_border_pieces_a_second_time():
    """A block that starts inside a record begun in block 0 and ends inside
    another, in batches of two lines: the scan for the pieces yields just these."""
    import pyarrow as pa

    from dimstar.sources.csv_records import _assembled
    lines = ['end of "', 'x,"a', 'b ""q""', 'c"', 'y,z', 'w,"open', 'still']
    names = ["line", "file", "block", "start", "began", "torn_block", "torn_line"]
    rows = [(text, 7, 100, 1, 0, None, None) for text in lines]
    kinds = [pa.string(), *[pa.int64()] * 6]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i:i + 2], strict=True), kinds, strict=True)], names)
               for i in range(0, len(rows), 2)]
    whole = [r["line"] for b in _assembled(pieces=False)(iter(batches)) for r in b.to_pylist()]
    pieces = [(r["line"], r["began"], r["block"]) for b in _assembled(pieces=True)(iter(batches)) for r in b.to_pylist()]
    assert whole == ['x,"a\nb ""q""\nc"', "y,z"]
    assert pieces == [('end of "', 0, 100), ('w,"open\nstill', 100, 100)]


def test_line_ends_of_whole_arrays_agree_with_the_pattern():
    import re

    import pyarrow as pa

    from dimstar.sources.csv_records import OPEN, _line_reader
    as_bytes, ends, states, _ = _line_reader()
    rng, is_open = random.Random(4), re.compile(OPEN, re.DOTALL).fullmatch
    texts = ["".join(rng.choice(['"', '""', ",", "a", "è", "\r"]) for _ in range(rng.randrange(12))) for _ in range(3000)]
    end0, end1 = ends(as_bytes(pa.array(texts)))
    assert [bool(is_open(t)) for t in texts] == end0.astype(bool).tolist()
    assert [bool(is_open('"' + t)) for t in texts] == end1.astype(bool).tolist()
    for start in (0, 1):
        now = start
        for before, after, *by_start in zip(*states(end0, end1, start), end0, end1, strict=True):
            assert before == now
            now = by_start[now]
            assert after == now
