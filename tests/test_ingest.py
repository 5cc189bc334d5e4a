import pytest

from cabmill.schemas import RAW_COLUMNS, RAW_TRIP
from cabmill.sources import csv_ingest, tables

LINE = (
    "1,2015-01-05 08:00:00,2015-01-05 08:30:00,2,5.0,-74.0,40.75,1,N,-73.9,40.7,1,"
    "10.0,0.5,0.5,2.0,0.0,{surcharge},13.3"
)
HEADER = ",".join(c.upper() for c in RAW_COLUMNS)


def put(folder, name, *lines, header=HEADER):
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def test_ingest(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    good, empty_field = LINE.format(surcharge="0.3"), LINE.format(surcharge="")
    put(source, "b 1.csv", good, empty_field)
    put(source, "a.csv", good, good.replace("2015-01-05 08:30:00", "soon"), "1,2")
    put(source, "none.csv")
    (source / "notes.txt").write_text("not a csv")
    report = csv_ingest.ingest_csv(spark, str(source), target)
    got = [(r.source_file, r.row_count, r.corrupt_rows, r.status) for r in report.collect()]
    assert got == [
        ("a.csv", 3, 2, "bad lines"),
        ("b 1.csv", 2, 0, "success"),
        ("none.csv", 0, 0, "success"),
    ]
    assert tuple(csv_ingest.load_totals(report).first()) == (3, 2, 1)
    rows = csv_ingest.accepted_rows(spark, target)
    assert rows.schema == RAW_TRIP and rows.count() == 3
    assert rows.where("improvement_surcharge IS NULL").count() == 1
    lines = {r.line for r in csv_ingest.rejected_lines(spark, target).collect()}
    assert "1,2" in lines and len(lines) == 2

    # Another load adds its files; a file that comes again replaces its rows.
    later = tmp_path / "later"
    later.mkdir()
    put(later, "a.csv", good, good)
    put(later, "c.csv", good)
    csv_ingest.ingest_csv(spark, str(later), target)
    assert csv_ingest.accepted_rows(spark, target).count() == 2 + 2 + 1
    assert csv_ingest.rejected_lines(spark, target).count() == 0


def test_prefix_and_empty_directory(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    report = csv_ingest.ingest_csv(spark, str(source), str(tmp_path / "none"))
    assert tuple(csv_ingest.load_totals(report).first()) == (0, 0, 0)
    put(source, "yellow_1.csv", LINE.format(surcharge="0.3"))
    put(source, "green_1.csv", LINE.format(surcharge="0.3"))
    report = csv_ingest.ingest_csv(spark, str(source), str(tmp_path / "out"), prefix="yellow")
    assert [r.source_file for r in report.collect()] == ["yellow_1.csv"]


def test_a_wrong_header_fails_its_file_only(spark, tmp_path, capsys):
    source = tmp_path / "in"
    source.mkdir()
    swapped = HEADER.replace("EXTRA,MTA_TAX", "MTA_TAX,EXTRA")
    put(source, "a.csv", LINE.format(surcharge="0.3"), header=swapped)
    put(source, "b.csv", LINE.format(surcharge="0.3"))
    target = str(tmp_path / "out")
    assert csv_ingest.main(["--source", str(source), "--target", target]) == 1
    told = capsys.readouterr().out
    assert "a.csv: 0 rows, 0 unreadable, wrong header" in told and "total 2, success 1, failed 1" in told
    assert csv_ingest.accepted_rows(spark, target).count() == 1
    args = ["--source", str(source), "--target", target, "--prefix", "b"]
    assert csv_ingest.main(args) == 0


def test_a_header_in_the_middle_is_a_bad_line(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    good = LINE.format(surcharge="0.3")
    put(source, "late.csv", HEADER, good, header=good)  # the header is its second line
    put(source, "twice.csv", good, HEADER, good)
    put(source, "quoted.csv", good, header=",".join(f'" {c} "' for c in HEADER.split(",")))
    report = csv_ingest.ingest_csv(spark, str(source), target)
    got = {r.source_file: (r.row_count, r.corrupt_rows, r.status) for r in report.collect()}
    assert got == {
        "late.csv": (0, 0, "wrong header"), "twice.csv": (3, 1, "bad lines"),
        "quoted.csv": (1, 0, "success"),
    }
    assert [(r.source_file, r.line) for r in csv_ingest.rejected_lines(spark, target).collect()] == [("twice.csv", HEADER)]
    # A file that comes again without its header leaves the rows of the load before.
    put(source, "quoted.csv", good, good, header=good)
    csv_ingest.ingest_csv(spark, str(source), target)
    assert csv_ingest.accepted_rows(spark, target).count() == 2 + 1


def test_the_files_are_read_once(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n in range(3):
        put(source, f"{n}.csv", *[LINE.format(surcharge="0.3")] * 50)
    reads, read = [], csv_ingest.read_lines
    monkeypatch.setattr(csv_ingest, "read_lines", lambda *args: reads.append(args) or read(*args))
    report = csv_ingest.ingest_csv(spark, str(source), target)
    for n in range(3):  # the report needs their names and sizes alone
        (source / f"{n}.csv").write_text("x" * 10)
    assert {(r.row_count, r.corrupt_rows, r.status) for r in report.collect()} == {(50, 0, "success")}
    assert len(reads) == 1 and not [f for f in (tmp_path / "out").iterdir() if f.name.startswith("_loading")]


def test_scan_table_checks_the_contract(spark, tmp_path):
    from tests.test_expressions import trip_rows

    path = str(tmp_path / "t")
    trip_rows(spark, {}).write.parquet(path)
    spark.sql(f"CREATE OR REPLACE TEMP VIEW good_trips AS SELECT * FROM parquet.`{path}`")
    spark.sql("CREATE OR REPLACE TEMP VIEW bad_trips AS SELECT vendorid FROM good_trips")
    assert tables.scan_table(spark, "good_trips").schema == RAW_TRIP
    with pytest.raises(ValueError, match="contract"):
        tables.scan_table(spark, "bad_trips")
    assert "default" in {r.namespace for r in tables.namespaces(spark).collect()}
