"""Links, profiles, files and row-wise operators on a stream."""

import pytest

from freightlake.functions import half_even, highest, lowest, sum_or_null
from freightlake.operators import daily, flows, links, profile
from freightlake.operators.checks import ModelInputError
from freightlake.sources import read_table, shared_folder, stored_once, write_table
from freightlake.sources.tables import table_format

LINKS = (
    "A int, B int, AT int, MILES double, PCT_TRUCK double, FINALCOUNT double, TYP string,"
    " SRC string, SUTAM double, MUTAM double, CTIMEAM double"
)


def link(a, b, at=1, pct=0.5, count=5.0, kind="Arterial"):
    return (a, b, at, 1.0, pct, count, kind, "s", 2.0, 3.0, 4.0)


def test_links_kept_and_named(make):
    table = make(
        [
            link(9, 2, at=4),
            link(2, 9, kind=None),
            link(1, 2, kind="Ramp"),
            link(3, 4, pct=0.0),
            link(5, None, count=7.0),
        ],
        LINKS,
    )
    got = links.link_summary(table, "AM").collect()
    assert [(r.linkID, r.area_type, r.daily_count) for r in got] == [
        ("2-9", None, 2.0),
        ("2-9", "CBD", 2.0),
        (None, "CBD", 4.0),
    ]
    one_way = links.link_summary(table, "AM", combine_directions=False, count_direction="one-way")
    assert [(r.linkID, r.daily_count) for r in one_way.collect()][:2] == [("9-2", 1.0), ("2-9", 1.0)]


def test_link_columns_of_another_period(make):
    table = make([link(1, 2)], LINKS)
    assert links.missing_link_columns(table, "PM") == ["SUTPM", "MUTPM", "CTIMEPM"]
    with pytest.raises(ModelInputError, match="SUTPM"):
        links.link_summary(table, "PM")


def test_first_definition_counts(make):
    summary = links.link_summary(make([link(1, 2), link(2, 1), link(7, 8)], LINKS), "AM")
    definitions = make([(3, 1, 2, 4), (2, 2, 1, None), (5, 1, 2, 6)],
                       "seq int, A int, B int, DistrictID int")
    got = links.link_districts(summary, definitions, "seq")
    assert sorted((r.linkID, r.DistrictID) for r in got.filter("DistrictID IS NOT NULL").collect()) == [
        ("1-2", 0),
        ("1-2", 0),
    ]
    assert [r.linkID for r in links.undefined_links(got).collect()] == ["7-8"]
    with pytest.raises(ModelInputError, match="7-8"):
        links.link_districts(summary, definitions, "seq", strict=True)


def test_profile(make):
    table = make(
        [(1, "b", 0.5, None), (10, "a", 2.0, None), (9, "a", None, None)],
        "n int, s string, x double, e string",
    )
    got = {r.Variable: r for r in profile.profile_columns(table, 3, zeros=True).collect()}
    assert got["n"]["Values"] == "1 -- 10" and got["n"].Unique == 3
    assert got["s"]["Values"] == "a, b" and got["s"].Class == "string"
    assert got["x"]["Values"] == "0.5, 2" and got["x"].Missing == 1
    assert (got["e"]["Values"], got["e"].Unique, got["e"].Missing) == ("", 0, 3)


def test_profile_of_no_rows(make):
    (row,) = profile.profile_columns(make([], "n int")).collect()
    assert (row.Unique, row.Missing, row["Values"]) == (0, 0, "")


def test_percent(make):
    table = make([("a", 1.0), ("a", 2.0), ("b", 5.0), (None, 0.0)], "g string, x double")
    overall = profile.with_percent_of_total(table, "x", "p").collect()
    assert [r.p for r in overall] == [12.5, 25.0, 62.5, 0.0]
    grouped = profile.with_percent_of_total(table, "x", "p", by=["g"]).collect()
    assert sorted((r.x, r.p) for r in grouped if r.x) == [(1.0, 33.3), (2.0, 66.7), (5.0, 100.0)]
    assert [r.p for r in grouped if r.g is None] == [None]  # nothing out of nothing


def test_rounding_and_nulls(make):
    values = make([(0.5,), (1.5,), (2.5,), (-0.5,), (0.25,), (None,)], "x double")
    got = values.select(half_even("x").alias("w"), half_even("x", 1).alias("t")).collect()
    assert [r.w for r in got] == [0.0, 2.0, 2.0, 0.0, 0.0, None]
    assert [r.t for r in got] == [0.5, 1.5, 2.5, -0.5, 0.2, None]
    pairs = make([(1, 2), (None, 2)], "a int, b int")
    assert [tuple(r) for r in pairs.select(lowest("a", "b"), highest("a", "b")).collect()] == [
        (1, 2),
        (None, None),
    ]
    assert pairs.select(sum_or_null("a"), sum_or_null("b")).first() == (None, 4)


@pytest.mark.parametrize(
    "path, expected",
    [
        ("/x/trips.csv", ("csv", None)),
        ("/x/Trips.CSV.gz", ("csv", "gzip")),
        ("/x/trips.parquet/", ("parquet", None)),
    ],
)
def test_format_from_extension(path, expected):
    assert table_format(path) == expected


def test_unknown_format(spark):
    with pytest.raises(ModelInputError):
        read_table(spark, "/x/trips.xyz")
    assert table_format("/x/trips.xyz", "CSV") == ("csv", None)


def test_round_trips_and_refusal_to_overwrite(spark, tmp_path, make):
    rows = [(1, 'say "hi", twice', 1.5), (2, None, None), (3, "line\nbreak", 0.1)]
    table = make(rows, "id int, text string, x double")
    for name in ("t.csv", "t.csv.gz", "t.parquet"):
        path = str(tmp_path / name)
        write_table(table, path)
        got = read_table(spark, path, schema=table.schema, multi_line=True)
        assert sorted(map(tuple, got.collect())) == sorted(rows)
        write_table(table, path)
        with pytest.raises(Exception, match="(?i)already exists"):
            write_table(table, path, overwrite=False)
    guessed = read_table(spark, str(tmp_path / "t.csv"), multi_line=True)
    assert guessed.schema["id"].dataType.simpleString() == "int"


def test_stored_once_reads_back_from_the_shared_folder(spark, make):
    table = make([(1, "a"), (2, None)], "id int, t string")
    stored = stored_once(table, "x")
    assert sorted(map(tuple, stored.collect())) == [(1, "a"), (2, None)]
    assert shared_folder(spark) in stored.inputFiles()[0]


def test_row_wise_operators_take_a_stream(spark, tmp_path, make):
    source = str(tmp_path / "in")
    table = make([(1, 2, "1", 8, "SU"), (2, 9, "1", 17, "CS")],
                 "dms_orig int, dms_dest int, dms_mode string, start_hour int, vehicle_type string")
    table.write.parquet(source)
    stream = spark.readStream.schema(table.schema).parquet(source)
    tagged = flows.classify_direction(flows.recast_codes(stream, ["dms_mode"]), [1])
    query = (
        daily.period_matrix_labels(flows.retain_study_flows(tagged))
        .writeStream.format("memory")
        .queryName("tagged")
        .option("checkpointLocation", str(tmp_path / "check"))
        .start()
    )
    query.processAllAvailable()
    query.stop()
    got = spark.table("tagged").select("direction", "matrix").collect()
    assert [tuple(r) for r in got] == [("outbound", "am_sut")]
