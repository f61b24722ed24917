"""Delimited records cut from splits of any size, against a reader of whole files."""

import csv
import io
import random
import warnings

import pandas as pd
import pytest

from omoplate.sources import delimited as dl
from omoplate.sources import records as rc


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "40b", "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def extract(rng, rows):
    """Text of a file, with quotes wherever a reader has to think about them."""
    cell = lambda: rng.choice(["a", "", "x y", '5" pipe', '"q"', '"two\nlines"', '"a;b"', '"say ""hi"""', '"three\n\nlong; ""lines"""',
                               '""', 'é€', '"tail"more', '"""', "word " * 6, '"' + "wide\n" * 12 + '"', "'"])
    out = ["c1;c2;c3"]
    for _ in range(rows):
        cells = [cell() for _ in range(3)]
        out.append("" if rng.random() < 0.05 else ";".join('"odd"' if c == '"""' else c for c in cells))
    return "\n".join(out) + rng.choice(["", "\n"])


def by_hand(text):
    rows = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=";") if r]
    return rows[1:]


def test_transitions_compose():
    rng, dialect = random.Random(4), rc.Dialect(";")
    for _ in range(300):
        lines = io.StringIO(extract(rng, rng.randint(0, 12)), newline="\n").readlines()
        cuts = sorted(rng.randint(0, len(lines)) for _ in range(rng.randint(0, 5)))
        inside = False
        for a, b in zip([0, *cuts], [*cuts, len(lines)]):
            n, outside_end, inside_end, _ = rc.transition(iter(lines[a:b]), dialect)
            assert n == b - a
            inside = inside_end if inside else outside_end
            last = None
            for last in rc.records(iter(lines[:b]), dialect):
                pass
            assert inside == (last is not None and not last[2])


@pytest.mark.parametrize("seed", range(2))
def test_any_splits_give_the_records_of_whole_files(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    want = []
    for name in "ab":
        text = extract(rng, 40)
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8", newline="")
        want += by_hand(text)
    found = rc.read_records(spark, str(tmp_path), rc.Dialect(";"))
    got = found.collect()
    assert found.select("file").distinct().count() == 2 and rc._text(spark, str(tmp_path)).rdd.getNumPartitions() > 8
    assert sorted(r["fields"] for r in got if r["kind"] == "record") == sorted(want)
    assert [r["fields"] for r in got if r["kind"] == "header"] == [["c1", "c2", "c3"]] * 2


def _write(tmp_path, text, name="x.csv"):
    (tmp_path / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(tmp_path / name)


def _read(spark, path, **options):
    return [tuple(r) for r in dl.read_delimited(spark, path, {"sep": ";", **options}).collect()]


def test_line_breaks_in_quotes_need_no_option(spark, tmp_path):
    path = _write(tmp_path, 'id;text;n\r\nAN1;"line1\nline2";9\r\nAN2;"a\r\nb";8\r\n')
    assert _read(spark, path) == [("AN1", "line1\nline2", "9"), ("AN2", "a\r\nb", "8")]
    assert _read(spark, path) == _read(spark, path, multiline=True)


def test_every_surplus_field_is_counted(spark, tmp_path, small_splits):
    path = _write(tmp_path, 'a;b\n1;2\nAN1;a;;X\n3;4;\n"5\n5";6\n7\n8;9;EXTRA\n')
    for bad in ("skip", "warn"):
        assert sorted(_read(spark, path, on_bad_lines=bad)) == [("1", "2"), ("5\n5", "6"), ("7", None)]
    got = dl.rejected_records(spark, path, {"sep": ";"}).collect()
    assert sorted(map(tuple, got)) == [("x.csv", 3, "4 fields instead of 2", ["AN1", "a", "", "X"]),
                                       ("x.csv", 4, "3 fields instead of 2", ["3", "4", ""]),
                                       ("x.csv", 8, "3 fields instead of 2", ["8", "9", "EXTRA"])]
    with pytest.raises(Exception, match="line [348]: . fields instead of 2"):
        _read(spark, path)


def test_an_unclosed_quote_is_a_fault_of_its_record_alone(spark, tmp_path, small_splits):
    path = _write(tmp_path, 'a;b\n1;"x\ny"\n2;"open\n' + "3;4\n" * 60)
    assert _read(spark, path, on_bad_lines="skip") == [("1", "x\ny")]
    assert [tuple(r) for r in dl.rejected_records(spark, path, {"sep": ";"}).collect()] == [("x.csv", 4, "no closing quote", None)]
    with pytest.raises(Exception, match="line 4: no closing quote"):
        _read(spark, path)


def test_skipped_rows_names_marks_and_encodings(spark, tmp_path):
    path = _write(tmp_path, "made by hand\n;\nid;id;;x\n1;2;3;4\n")
    rows = dl.read_delimited(spark, path, {"sep": ";", "skiprows": 2})
    assert rows.columns == ["id", "id.1", "Unnamed: 2", "x"] == list(pd.read_csv(path, sep=";", skiprows=2).columns)
    assert [tuple(r) for r in rows.collect()] == [("1", "2", "3", "4")]
    assert _read(spark, _write(tmp_path, b"\xef\xbb\xbfa;b\n1;2\n")) == [("1", "2")]
    assert dl.read_delimited(spark, str(tmp_path / "x.csv"), {"sep": ";"}).columns == ["a", "b"]
    path = _write(tmp_path, "€;b\n'1;1';\\'2\n".encode("cp1252"))
    rows = dl.read_delimited(spark, path, {"sep": ";", "encoding": "cp1252", "quotechar": "'", "escapechar": "\\"})
    assert rows.columns == ["€", "b"] and [tuple(r) for r in rows.collect()] == [("1;1", "'2")]
    assert dl.read_delimited(spark, _write(tmp_path, "1\t2\n3\t4\n"), {"sep": "\t", "header": None}).count() == 2
    with pytest.raises(ValueError, match="skiprows"):
        dl.read_delimited(spark, path, {"skiprows": [1]})


def test_empty_files(spark, tmp_path):
    assert dl.read_delimited(spark, _write(tmp_path, "a;b\n"), {"sep": ";"}).count() == 0
    assert dl.rejected_records(spark, str(tmp_path / "x.csv"), {"sep": ";"}).count() == 0


def test_warned_ingest_writes_what_it_left_out(spark, tmp_path):
    path = _write(tmp_path, "a;d\n1;01/02/2020\n2;03/04/2020;5\n")
    cfg = {"f": {"read": {"sep": ";", "on_bad_lines": "warn"}, "dates": {"d": "%d/%m/%Y"}}}
    with pytest.warns(UserWarning, match="1 records"):
        got = dl.ingest_files(spark, {"f": path}, cfg, str(tmp_path / "out"))["f"]
    assert got.count() == 1 and spark.read.parquet(str(tmp_path / "out/f_rejected")).collect()[0]["line"] == 3
    with warnings.catch_warnings(record=True) as said:
        dl.ingest_files(spark, {"f": _write(tmp_path, "a;d\n1;01/02/2020\n", "y.csv")}, cfg, str(tmp_path / "out2"))
    assert not any("left out" in str(w.message) for w in said)
