import csv
import gzip
import io
import random
import re

import pytest

from loomwright.sources import csv as source
from loomwright.sources import source_reader
from loomwright.sources.csv import read_csv, source_path


def write(tmp_path, content, name="t.csv"):
    data = content if isinstance(content, bytes) else content.encode()
    (tmp_path / name).write_bytes(data)
    return {"bucket": "b", "key": name}


def rows(spark, tmp_path, conf, **kw):
    raw = read_csv(spark, conf, base_path=str(tmp_path), **kw)
    ordered = raw.rows.orderBy(*raw.order)
    return list(raw.columns), [tuple(r) for r in ordered.select(*[f"`{c}`" for c in raw.columns]).collect()]


@pytest.mark.parametrize("multi_line", [None, False, True])
def test_empty_null_quotes_backslash_bom(spark, tmp_path, multi_line):
    conf = write(tmp_path, b'\xef\xbb\xbfId,A b,1x\r\n1,,""\r\n2,"p ""q"" ",\\\r\n3, x ,a\\"\r\n'.replace(b'a\\"', b"z"))
    columns, got = rows(spark, tmp_path, conf, multi_line=multi_line)
    assert columns == ["id", "a_b", "c_1x"]
    assert got == [("1", None, ""), ("2", 'p "q" ', "\\"), ("3", " x ", "z")]


def test_line_breaks_in_fields_are_kept_as_they_are(spark, tmp_path):
    conf = write(tmp_path, b'a,b\r\n1,"x\r\ny"\r\n2,"u\nv\n\nw"\r\n3,"\r\n"\r\n')
    assert rows(spark, tmp_path, conf)[1] == [("1", "x\r\ny"), ("2", "u\nv\n\nw"), ("3", "\r\n")]


def test_no_final_line_break(spark, tmp_path):
    assert rows(spark, tmp_path, write(tmp_path, 'a,b\n1,"x\ny"'))[1] == [("1", "x\ny")]
    assert rows(spark, tmp_path, write(tmp_path, "a,b\n1,x", "u.csv"))[1] == [("1", "x")]


def test_header_only(spark, tmp_path):
    assert rows(spark, tmp_path, write(tmp_path, "a,b\n")) == (["a", "b"], [])
    assert rows(spark, tmp_path, write(tmp_path, "a,b\n"), multi_line=True) == (["a", "b"], [])


def test_line_break_in_the_header(spark, tmp_path):
    assert rows(spark, tmp_path, write(tmp_path, '"a\nb",c\n1,2\n')) == (["a_b", "c"], [("1", "2")])


@pytest.mark.parametrize("multi_line", [False, True])
@pytest.mark.parametrize("record", ["1,2", "1,2,3,4"])
def test_ragged_rows_fail(spark, tmp_path, record, multi_line):
    conf = write(tmp_path, f"a,b,c\n{record}\n")
    with pytest.raises(Exception, match="Malformed"):
        rows(spark, tmp_path, conf, multi_line=multi_line)


def test_blank_line_fails_but_is_a_null_in_a_single_column(spark, tmp_path):
    with pytest.raises(Exception, match="Malformed"):
        rows(spark, tmp_path, write(tmp_path, "a,b\n1,2\n\n3,4\n"))
    got = rows(spark, tmp_path, write(tmp_path, 'a\n1\n\n""\n4\n', "one.csv"))
    assert got[1] == [("1",), (None,), ("",), ("4",)]


def test_clashing_and_empty_headers(spark, tmp_path):
    with pytest.raises(ValueError, match="same name"):
        rows(spark, tmp_path, write(tmp_path, "A b,a_b\n1,2\n"))
    with pytest.raises(ValueError, match="same name"):
        rows(spark, tmp_path, write(tmp_path, "a,a\n1,2\n"))
    assert rows(spark, tmp_path, write(tmp_path, "a,\n1,2\n")) == (["a", "col"], [("1", "2")])
    with pytest.raises(ValueError, match="no header"):
        rows(spark, tmp_path, write(tmp_path, ""))


def test_unicode_header(spark, tmp_path):
    for multi_line in (False, True):
        got = rows(spark, tmp_path, write(tmp_path, "São Paulo,x y\n1,2\n"), multi_line=multi_line)
        assert got == (["são_paulo", "x_y"], [("1", "2")])


def test_unterminated_quote(spark, tmp_path):
    with pytest.raises(ValueError, match="unterminated"):
        rows(spark, tmp_path, write(tmp_path, 'a,b\n1,"x\n2,y\n'))


def random_table(seed, n=800):
    rng = random.Random(seed)
    pieces = ["a", "é", '"', "\n", "\n\n", ",", " ", "\\", "xyz", '""', "\r\n"]
    return [(str(i), "".join(rng.choices(pieces, k=rng.randint(0, 12))), "z") for i in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_records_across_many_splits(spark, tmp_path, seed):
    """Split into pieces smaller than a record, every record still comes out once, in order."""
    table = random_table(seed)
    buf = io.StringIO()
    writer = csv.writer(buf, lineterminator="\n", quoting=csv.QUOTE_ALL)
    writer.writerow(["id", "text", "z"])
    writer.writerows(table)
    conf = write(tmp_path, buf.getvalue())
    small = {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "0"}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        raw = read_csv(spark, conf, base_path=str(tmp_path))
        assert raw.staged
        assert spark.read.parquet(raw.staged[0]).select("__block").distinct().count() > 20
        got = [tuple(r) for r in raw.rows.orderBy(*raw.order).select("id", "text", "z").collect()]
    finally:
        for k in small:
            spark.conf.unset(k)
    assert got == table


@pytest.mark.parametrize("multi_line", [False, True])
def test_several_files_have_one_header_each(spark, tmp_path, multi_line):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,x\n")
    (folder / "2.csv").write_text("a,b\n2,y\n3,z\n")
    conf = {"bucket": "b", "key": "parts"}
    assert rows(spark, tmp_path, conf, multi_line=multi_line)[1] == [("1", "x"), ("2", "y"), ("3", "z")]
    (folder / "3.csv").write_text("b,a\n4,w\n")
    with pytest.raises(Exception, match="header"):
        rows(spark, tmp_path, conf, multi_line=multi_line)


def test_paths():
    assert source_path({"bucket": "b", "key": "d/t.csv"}) == "s3a://b/d/t.csv"
    assert source_path({"key": "t.csv"}, "/data/") == "/data/t.csv"
    for conf in ({"key": "t.csv"}, {"bucket": "b"}):
        with pytest.raises(ValueError, match="needs a key"):
            source_path(conf)


def test_unknown_source_type():
    with pytest.raises(ValueError, match="unsupported source type"):
        source_reader("ftp")


def test_several_files_with_an_unnamed_column(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "1.csv").write_text("a,\n1,x\n")
    (folder / "2.csv").write_text("a,\n2,y\n")
    assert rows(spark, tmp_path, {"key": "parts"}) == (["a", "col"], [("1", "x"), ("2", "y")])


@pytest.mark.parametrize("multi_line", [None, False, True])
@pytest.mark.parametrize(
    ("content", "expected"),
    [
        ("a\n1\n\n2\n", [("1",), (None,), ("2",)]),
        ('a\n"x\ny"\nz\n', [("x\ny",), ("z",)]),
        ("a,b\n1,x\n\n2,y\n", None),
        ('a,b\n1,"x\ny",\n', None),
    ],
)
def test_rows_do_not_depend_on_what_is_said_of_the_lines(spark, tmp_path, content, expected, multi_line):
    conf = write(tmp_path, content)
    if expected is None:
        with pytest.raises(Exception):
            rows(spark, tmp_path, conf, multi_line=multi_line)
    else:
        assert rows(spark, tmp_path, conf, multi_line=multi_line)[1] == expected


@pytest.mark.parametrize("multi_line", [None, False, True])
@pytest.mark.parametrize("content", [b"a,b\nS\xe3o,1\n", b"a,b\nx,1\nS\xe3o,2\n", b'a,b\n"x\ny",1\nS\xe3o,2\n'])
def test_bytes_that_are_no_utf8_fail(spark, tmp_path, content, multi_line):
    (tmp_path / "latin.csv").write_bytes(content)
    with pytest.raises(Exception, match="UTF-8"):
        rows(spark, tmp_path, {"key": "latin.csv"}, multi_line=multi_line)


def test_open_quote_in_the_header_fails(spark, tmp_path):
    conf = write(tmp_path, 'a,"b\n' + "1,x\n" * 50_000)
    with pytest.raises(Exception):
        rows(spark, tmp_path, conf)


def test_stray_quotes_far_apart_fail(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source, "MOST_RECORD_BYTES", 1000)
    conf = write(tmp_path, 'a,b\n1,"x\n' + "1,x\n" * 500 + '1,x"\n2,y\n')
    with pytest.raises(ValueError, match="stray"):
        rows(spark, tmp_path, conf)
    # A source may say that its records are that large.
    assert len(rows(spark, tmp_path, {**conf, "max_record_bytes": 5000})[1]) == 2


def test_a_compressed_file_has_many_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source, "GROUP_LINES", 100)
    expected = [(str(i), f"x\ny{i}" if i % 3 else f"z{i}") for i in range(1000)]
    content = "a,b\n" + "".join(f'{a},"{b}"\n' for a, b in expected)
    (tmp_path / "part.csv.gz").write_bytes(gzip.compress(content.encode()))
    raw = read_csv(spark, {"key": "part.csv.gz"}, base_path=str(tmp_path))
    assert sorted(map(tuple, raw.rows.select("a", "b").collect())) == sorted(expected)
    assert spark.read.parquet(raw.staged[1]).count() == 17


def test_only_lines_of_long_records_are_shuffled(spark, tmp_path):
    conf = write(tmp_path, 'a,b\n1,"x\ny"\n' + "2,z\n" * 100)
    raw = read_csv(spark, conf, base_path=str(tmp_path))
    raw.rows.write.format("noop").mode("overwrite").save()
    lines = spark.read.parquet(raw.staged[0])
    splits = spark.read.parquet(raw.staged[1])
    plan = source._parts(lines, splits)._jdf.queryExecution().optimizedPlan().toString()
    # What goes into the window has been filtered or joined on whether a line is whole.
    assert plan.count("Window") == 1 and re.search(r"(Filter|Join)[^\n]*odd", plan.partition("Window")[2])
    assert "Window" not in source._placed(lines, splits)._jdf.queryExecution().optimizedPlan().toString()
