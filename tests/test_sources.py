from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import types as T

from silverlode.schemas import TABLES, TRIP_COLUMNS
from silverlode.sources import csv, files, rates

ITEMS = (
    T.StructType()
    .add("id", T.IntegerType())
    .add("price", T.DecimalType(12, 2))
    .add("note", T.StringType())
    .add("absent", T.DateType())
)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_named_scan_reorders_drops_fills_and_nulls_bad_cells(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'note,extra,id,price\n"a, b",z,1,2.50\n padded ,z,oops,x\n,z,3,\n')
    got = csv.read_named(spark, path, ITEMS)
    assert rows(got) == [
        (1, Decimal("2.50"), "a, b", None, "a.csv"),
        (3, None, None, None, "a.csv"),
        (None, None, " padded ", None, "a.csv"),
    ]


def test_named_scan_of_a_header_only_file_is_empty(spark, tmp_path):
    assert csv.read_named(spark, write(tmp_path / "e.csv", "id,price,note\n"), ITEMS).isEmpty()


def test_missing_columns_are_listed(spark, tmp_path):
    header = csv.header_of(spark, [write(tmp_path / "m.csv", "id,note\n1,x\n")])
    assert csv.missing_columns(header, ITEMS) == ["price", "absent"]


def test_different_headers_raise_instead_of_shifting(spark, tmp_path):
    paths = [write(tmp_path / "a.csv", "id,price\n1,2\n"), write(tmp_path / "b.csv", "price,id\n4,3\n")]
    with pytest.raises(Exception, match="CSV header"):
        csv.read_named(spark, paths, ITEMS).collect()


def test_mixed_headers_are_resolved_per_file(spark, tmp_path):
    paths = [
        write(tmp_path / "a.csv", "id,price\n1,2\n5,6\n"),
        write(tmp_path / "b.csv", "price,note,id\n4,n,3\n"),
        write(tmp_path / "c.csv", "no known column\nrow\n"),
        write(tmp_path / "d e.csv", ",".join([*(f"x{i}" for i in range(130)), "id"]) + "\n" + "," * 130 + "7\n"),
    ]
    groups = csv.paths_by_header(spark, paths)
    assert len(groups) == 4
    got = csv.read_mixed(spark, groups, ITEMS)
    assert rows(got, "id", "price", "note", "_file_name") == [
        (1, Decimal("2.00"), None, "a.csv"),
        (3, Decimal("4.00"), "n", "b.csv"),
        (5, Decimal("6.00"), None, "a.csv"),
        (7, None, None, "d e.csv"),
        (None, None, None, "c.csv"),
    ]


def test_quoted_line_breaks_stay_in_their_record(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,price,note\n1,2.50,"line one\nline ""two"", end"\n2,3,x\n')
    got = csv.read_named(spark, path, ITEMS)
    assert rows(got, "id", "note") == [(1, 'line one\nline "two", end'), (2, "x")]
    schema = T.StructType.fromDDL("id INT, price DECIMAL(12,2), note STRING")
    assert rows(csv.read_positional(spark, path, schema), "id", "note") == rows(got, "id", "note")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        csv.read_named(spark, path, ITEMS, line_breaks=False).collect()


def test_csv_round_trip_keeps_blanks_quotes_and_microseconds(spark, tmp_path):
    df = spark.sql(
        "SELECT ' a ' AS s, 'q\"x,y' AS q, TIMESTAMP_NTZ'2024-01-01 00:00:00.123456' AS t, CAST(NULL AS INT) AS n"
    )
    path = str(tmp_path / "rt")
    csv.write_csv(df, path)
    assert rows(csv.read_named(spark, path, df.schema).drop("_file_name")) == rows(df)


def trip_line(*values):
    return ",".join([*values, *[""] * (19 - len(values))])


def test_positional_scan_ignores_header_names(spark, tmp_path):
    header = ",".join(f"x{i}" for i in range(19))
    line = trip_line("2", "2015-01-01 00:00:00", "2015-01-01 00:10:00", "1", "3.5")
    path = write(tmp_path / "yellow_tripdata_1.csv", f"{header}\n{line}\n{trip_line('bad')}\n")
    got = csv.read_positional(spark, path, T.StructType.fromDDL(TRIP_COLUMNS)).collect()
    assert (got[0].vendorid, got[0].trip_distance, got[0].source_file) == (2, 3.5, "yellow_tripdata_1.csv")
    assert got[1].vendorid is None


def test_strict_positional_scan_aborts_on_a_bad_row(spark, tmp_path):
    path = write(tmp_path / "t.csv", ",".join("abc") + "\n1,x,3\n")
    schema = T.StructType.fromDDL("a INT, b INT, c INT")
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        csv.read_positional(spark, path, schema, strict=True).collect()


def test_discovery_is_recursive_and_filters_names(spark, tmp_path):
    write(tmp_path / "x" / "y" / "a.csv", "h\n")
    write(tmp_path / "b.csv", "h\n")
    write(tmp_path / "c.txt", "h\n")
    assert rows(files.discover(spark, str(tmp_path)), "file_name") == [("a.csv",), ("b.csv",)]


def test_fingerprints_see_every_byte_and_the_order(spark, tmp_path):
    contents = [
        b"\n", b"h\n1\n2\n", b"h\n2\n1\n", b"h\n1\n2", b"h\r\n1\r\n2\r\n", b"h\n1\n2\n\n", b"h\n1 \n2\n", b"h\n12\n\n",
        b"h\n" + b"a\nb\n" * 20, b"h\n" + b"a\nb\n" * 19 + b"b\na\n",
    ]
    for i, content in enumerate(contents):
        (tmp_path / f"my file {i}.csv").write_bytes(content)
    got = {r.file_name: r for r in files.fingerprints(spark, str(tmp_path)).collect()}
    assert {n: r.file_size_bytes for n, r in got.items()} == {f"my file {i}.csv": len(c) for i, c in enumerate(contents)}
    assert len({r.file_checksum for r in got.values()}) == len(contents)


def test_fingerprints_do_not_depend_on_names_or_splits(spark, tmp_path):
    lines = "h\n" + "".join(f"row {i}\n" for i in range(5000))
    write(tmp_path / "x" / "a.csv", lines)
    write(tmp_path / "y" / "b.csv", lines)

    def digests():
        return {r.file_checksum for r in files.fingerprints(spark, str(tmp_path)).collect()}

    whole = digests()
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        assert digests() == whole and len(whole) == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_changed_files_needs_a_processed_entry_with_the_same_checksum(spark):
    schema = "source_system STRING, file_name STRING, file_checksum STRING"
    candidates = spark.createDataFrame([("p", "a", "1"), ("p", "b", "2"), ("p", "c", "3")], schema)
    manifest = spark.createDataFrame(
        [("p", "a", "1", "processed"), ("p", "b", "9", "processed"), ("p", "c", "3", "failed")],
        schema + ", status STRING",
    )
    assert rows(files.changed_files(candidates, manifest), "file_name") == [("b",), ("c",)]


def test_payloads_fall_back_to_the_requested_date(spark):
    df = spark.createDataFrame(
        [
            (date(2024, 1, 6), '{"date": "2024-01-05", "rates": {"EUR": 0.92, "JPY": 144.5}}'),
            (date(2024, 1, 7), '{"rates": {"EUR": 0.93}}'),
            (date(2024, 1, 8), '{"date": "2024-01-08"}'),
        ],
        "requested_date DATE, payload STRING",
    )
    assert rows(rates.flatten_payloads(df)) == [
        (date(2024, 1, 5), "USD", "EUR", Decimal("0.92000000")),
        (date(2024, 1, 5), "USD", "JPY", Decimal("144.50000000")),
        (date(2024, 1, 7), "USD", "EUR", Decimal("0.93000000")),
    ]


def test_landed_payload_files_and_missing_dates(spark, tmp_path):
    write(tmp_path / "2024-01-01.json", '{"date": "2024-01-01", "rates": {"EUR": 1}}')
    write(tmp_path / "2024-01-03.json", '{"date": "2024-01-03", "rates": {"EUR": 2}}')
    payloads = rates.read_payloads(spark, str(tmp_path))
    assert rates.flatten_payloads(payloads).count() == 2
    spine = rates.date_spine(rates.default_bounds(spark, date(2024, 1, 3), lookback=2))
    landed = payloads.selectExpr("requested_date AS date")
    assert rows(rates.missing_dates(spine, landed)) == [(date(2024, 1, 2),)]


def test_every_table_has_a_parsable_schema_and_its_keys(spark):
    for spec in TABLES.values():
        assert set(spec.keys) <= set(spec.schema.names), spec.name
        assert set(spec.defaults) <= set(spec.schema.names), spec.name


# --- parallel CSV scans -------------------------------------------------------------
@pytest.fixture(params=[64, 100_000])
def small_blocks(spark, request):
    """Scans cut into blocks of a few bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


CELLS = ["a", "", '"x"', '"line\nbreak"', '"q""uo""te"', '"""\n\n"""', '"a,b"', "é", '"' + "long\n" * 30 + '"', '""', " sp ", '"\r\n,"']
THREE = T.StructType().add("id", T.IntegerType()).add("one", T.StringType()).add("two", T.StringType())


def csv_text(seed, count, eol="\n", last=True):
    import random

    rng = random.Random(seed)
    lines = ["id,one,two", *(f"{i},{rng.choice(CELLS)},{rng.choice(CELLS)}" for i in range(count))]
    return eol.join(lines) + (eol if last else "")


def raw(path, text):
    path.write_bytes(text.encode())
    return str(path)


@pytest.mark.parametrize("seed, eol, last", [(1, "\n", True), (2, "\n", False), (3, "\r\n", True)])
def test_parallel_scan_equals_the_multi_line_reader(spark, tmp_path, small_blocks, seed, eol, last):
    from silverlode.sources import csv_blocks

    text = csv_text(seed, 24, eol, last).replace('"\r\n,"', '"\n,"' if eol == "\r\n" else '"\r\n,"')
    path = raw(tmp_path / "a b+c.csv", text)
    lines = csv_blocks._lines(spark, [path])
    assert (lines.rdd.getNumPartitions() > 8) == (small_blocks < 1000)
    schema = T.StructType.fromDDL("two STRING, id INT, gone DATE, one STRING")
    assert rows(csv_blocks.read_named(spark, path, schema, uri=True)) == rows(csv.read_named(spark, path, schema, uri=True))
    assert rows(csv_blocks.read_positional(spark, path, THREE)) == rows(csv.read_positional(spark, path, THREE))
    assert rows(csv_blocks.read_positional(spark, path, THREE, strict=True)) == rows(
        csv.read_positional(spark, path, THREE, strict=True)
    )


def test_parallel_scan_of_several_files_short_rows_and_empty_lines(spark, tmp_path, small_blocks):
    from silverlode.sources import csv_blocks

    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(3):
        raw(folder / f"{k}.csv", csv_text(10 + k, 12) + '\n\n77,short\n78,a,b,extra\n79,"in\nside",z')
    raw(folder / "header.csv", "id,one,two\n")
    assert rows(csv_blocks.read_named(spark, str(folder), THREE)) == rows(csv.read_named(spark, str(folder), THREE))
    assert csv_blocks.read_named(spark, str(folder / "header.csv"), THREE).isEmpty()


@pytest.mark.parametrize("text", ['id,one,two\n1,5" pipe,x\n2,6" rod,y\n', 'id,one,two\n1,"open,x\n2,b,y\n', 'id,one,two\n1,"a" ,x\n'])
def test_stray_quotes_raise_instead_of_joining_records(spark, tmp_path, text):
    from silverlode.sources import csv_blocks

    with pytest.raises(Exception, match="a quote outside of a quoted cell"):
        csv_blocks.read_named(spark, raw(tmp_path / "stray.csv", text), THREE).collect()


def test_parallel_scan_refuses_other_headers_and_bad_strict_cells(spark, tmp_path):
    from silverlode.sources import csv_blocks

    paths = [raw(tmp_path / "a.csv", "id,one,two\n1,2,3\n"), raw(tmp_path / "b.csv", "id,two,one\n1,2,3\n")]
    with pytest.raises(Exception, match="a header differs"):
        csv_blocks.read_named(spark, paths, THREE).collect()
    bad = raw(tmp_path / "c.csv", "id,one,two\nx,2,3\n")
    assert rows(csv_blocks.read_positional(spark, bad, THREE), "id", "one") == [(None, "2")]
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        csv_blocks.read_positional(spark, bad, THREE, strict=True).collect()


# --- inferred types ------------------------------------------------------------------
INFERRED = {
    "int": ["1", "-20", "+3", None, "0"],
    "bigint": ["1", "9999999999", None, "0", "5"],
    "decimal(20,0)": ["12345678901234567890", "1", "2", "3", None],
    "decimal(7,3)": ["1", "-1234.5", "0.125", None, "2.50"],
    "double": ["1", "2.5", "3e10", "-4E-5", None],
    "date": ["2024-02-29", None, "1999-12-31", "0001-01-01", None],
    "timestamp_ntz": ["2024-02-29", "2024-02-29 10:00:00", "2024-02-29T10:00:00.123456", None, None],
    "string": ["1", "2024-01-01", None, "x", ""],
    "void": [None] * 5,
}
ODD = {"leading zeros": ["007", "12"], "no such day": ["2023-02-30", "2023-02-28"], "too long": ["1" * 39, "2"], "number and date": ["5", "2024-01-01"], "a.dot 'n quote": ["Infinity", "1.5"], "space": [" 1", "2"], "bare dot": ["1.", "2"]}


def test_types_are_the_narrowest_that_hold_every_value(spark):
    from silverlode.sources import inference

    wide = list(zip(*INFERRED.values()))
    texts = spark.createDataFrame(wide, csv.text_schema([f"c {n}" for n in INFERRED]))
    assert dict(rows(inference.profile_types(texts), "column_name", "data_type")) == {f"c {n}": n for n in INFERRED}
    odd = spark.createDataFrame(list(zip(*ODD.values())), csv.text_schema(list(ODD)))
    assert {r.data_type for r in inference.profile_types(odd).collect()} == {"string"}
    assert [f.dataType for f in inference.infer_schema(texts.select("c void", "c date"))] == [T.StringType(), T.DateType()]
    nothing = inference.profile_types(texts.limit(0))
    assert {(r.data_type, r.n_rows) for r in nothing.collect()} == {("void", 0)} and nothing.count() == len(INFERRED)


def test_one_odd_cell_behind_many_rows_decides(spark, tmp_path):
    from silverlode.sources import inference

    path = write(tmp_path / "late.csv", "id,amount,note\n" + "".join(f"{i},{i}.5,\n" for i in range(20_000)) + "20000,n/a,\"x\ny\"\n")
    for parallel in (False, True):
        got = inference.read_inferred(spark, path, parallel)
        assert [f.dataType.simpleString() for f in got.schema] == ["int", "string", "string", "string"]
        assert got.where("amount = 'n/a' AND note = 'x\ny'").count() == 1 and got.where("id IS NULL").isEmpty()
