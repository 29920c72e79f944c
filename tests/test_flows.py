import pytest

from freightlake.operators import flows
from freightlake.operators.checks import ModelInputError
from freightlake.operators.flows import TagRule

MEASURES = (
    "id int, tons_2012 double, value_2012 double, tmiles_2012 double,"
    " tons_2016 double, value_2016 double, tmiles_2016 double"
)


def years(make):
    return make([(1, 1.0, 2.0, 3.0, 5.0, 6.0, 7.0)], MEASURES)


def test_first_column_wins_a_tie_and_target_year_is_kept(make):
    row = flows.year_measures(years(make), 2014).first()
    assert (row.year, row.exp_tons, row.exp_value, row.exp_tmiles) == (
        2014,
        1000.0,
        2e6,
        3e6,
    )
    assert "tons_2016" not in row.asDict()


@pytest.mark.parametrize("target, tons", [(2013, 2000.0), (2012, 1000.0), (2030, 5000.0)])
def test_interpolation_between_years_only(make, target, tons):
    row = flows.year_measures(years(make), target, interpolate=True).first()
    assert row.exp_tons == tons


def test_no_year_columns(make):
    with pytest.raises(ModelInputError):
        flows.year_measures(make([(1,)], "id int"), 2014)


def test_codes_as_text(make):
    got = flows.recast_codes(
        make([("1.5",), ("7",), ("x",), (None,), (" 3 ",)], "sctg2 string"), ["sctg2"]
    )
    assert [r.sctg2 for r in got.collect()] == [1, 7, None, None, 3]


PAIRS = "dms_orig int, dms_dest int"


def directions(make, rows, **options):
    return flows.classify_direction(make(rows, PAIRS), **options).collect()


def test_direction_with_missing_regions(make):
    got = directions(
        make, [(1, 1), (1, 9), (9, 1), (9, 9), (None, 1), (None, 9)], internal_regions=[1]
    )
    assert [r.direction for r in got] == [
        "internal",
        "outbound",
        "inbound",
        "drop",
        "inbound",
        "drop",
    ]


def test_everything_is_internal_without_regions(make):
    assert [r.direction for r in directions(make, [(1, 2)], internal_regions=None)] == [
        "internal"
    ]


def test_pairs_listed_both_ways_or_onto_themselves_do_not_fan_out(make):
    pairs = make(
        [(1, 2, 11, 12), (2, 1, 12, 11), (3, 3, 5, 6)],
        "dms_orig int, dms_dest int, entry int, exit int",
    )
    base = make([(1, 2, "drop"), (2, 1, "internal"), (3, 3, "drop"), (1, 3, "drop")],
                "dms_orig int, dms_dest int, direction string")
    got = flows.tag_through_pairs(base, pairs).collect()
    assert sorted((r.dms_orig, r.dms_dest, r.direction, r.entry, r.exit) for r in got
                  if r.entry) == [
        (1, 2, "through", 11, 12),
        (2, 1, "through", 12, 11),
        (3, 3, "through", 5, 6),
    ]
    assert len(got) == 4


@pytest.mark.parametrize("rows", [200_000, 0])
def test_pairs_need_no_entry_and_exit(make, rows):
    pairs = make([(1, 2)], PAIRS)
    base = make([(2, 1, "drop")], PAIRS + ", direction string")
    (row,) = flows.tag_through_pairs(base, pairs, max_broadcast_rows=rows).collect()
    assert row.direction == "through"


def test_outer_regions_need_internal_ones(make):
    with pytest.raises(ModelInputError):
        flows.prepare_flows(years(make), 2014, outer_regions=make([(1, 2)], PAIRS))


def test_last_matching_rule_decides(make):
    rules = [TagRule("a", from_regions=[1]), TagRule("b", from_regions=[1], not_to=[5])]
    got = flows.study_area_tag_rules(make([(1, 5), (1, 6), (2, 5)], PAIRS), rules)
    assert [r.tag for r in got.collect()] == ["a", "b", "drop"]


def test_trade_and_mode_names(make):
    got = flows.recode_trade_mode(
        make([(1, 1), (3, 8), (4, 9), (None, None)], "trade_type int, dms_mode int")
    ).collect()
    assert [(r.trade_type, r.domestic_mode) for r in got] == [
        ("domestic", "Truck"),
        ("x-border", "None"),
        (None, None),
        (None, None),
    ]


def test_crosstab_leaves_out_missing_keys(make):
    base = make(
        [("Truck", "internal", 2.0), ("Truck", None, 4.0), (None, "internal", 8.0)],
        "domestic_mode string, direction string, exp_tons double",
    )
    got = {tuple(r) for r in flows.crosstab_tons_margins(base).collect()}
    assert got == {
        (mode, direction, 2.0)
        for mode in ("Truck", "Sum")
        for direction in ("internal", "Sum")
    }
