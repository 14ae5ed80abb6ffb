import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from colwarden.operators import compare, report, slim, verify
from colwarden.plans.contract import CONTRACT_FIELDS, ETL_FIELDS, PROBED_FIELD, contract, raw_schema, relation


def fields(df):
    return [r["field"] for r in df.collect()]


def test_golden_sizes():
    assert len(CONTRACT_FIELDS) == len(set(CONTRACT_FIELDS)) == 54 and len(ETL_FIELDS) == len(set(ETL_FIELDS)) == 53
    assert set(CONTRACT_FIELDS) - set(ETL_FIELDS) == {PROBED_FIELD} and not set(ETL_FIELDS) - set(CONTRACT_FIELDS)
    assert sum("solicitation" in f for f in CONTRACT_FIELDS) == 3 and CONTRACT_FIELDS[53] == PROBED_FIELD
    assert min(map(len, CONTRACT_FIELDS)) == 8 and max(map(len, CONTRACT_FIELDS)) == 40


def test_summary(spark):
    header = [*reversed(ETL_FIELDS), *CONTRACT_FIELDS, "solicitation_procedures_code", "zz"]
    r = verify.summary(contract(spark), relation(spark, header)).first()
    assert (r["total_required"], r["available"], r["missing"], r["probe_available"], r["all_available"]) == (54, 54, [], True, True)
    assert r["related"] == sorted(f for f in set(header) if "solicitation" in f) and len(r["related"]) == 4


@pytest.mark.parametrize("gone", [CONTRACT_FIELDS[0], PROBED_FIELD])
def test_one_field_less(spark, gone):
    header = [f.upper() if f == gone else f for f in CONTRACT_FIELDS]  # another case is another name
    r = verify.summary(contract(spark), relation(spark, header)).first()
    assert r["missing"] == [gone] and not r["all_available"] and r["probe_available"] == (gone != PROBED_FIELD)
    assert fields(verify.missing(contract(spark), relation(spark, header))) == [gone]


def test_empty_and_null(spark):
    none = relation(spark, [])
    r = verify.summary(none, contract(spark)).first()
    assert r["all_available"] and r["total_required"] == 0 and r["missing"] == []
    r = verify.summary(contract(spark), none).first()
    assert not r["all_available"] and len(r["missing"]) == 54 and r["related"] == [] and not r["probe_available"]
    assert not verify.has_field(none, "x").first()["present"]
    nulls = relation(spark, ["a", None])
    assert fields(verify.missing(nulls, nulls)) == [] and verify.summary(nulls, nulls).first()["all_available"]


names = st.lists(st.sampled_from(["a", "A", "b", "solicitation_x", PROBED_FIELD, ""]), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(names, names)
def test_against_python_sets(spark, want, have):
    a, b = relation(spark, want), relation(spark, have)
    assert set(fields(verify.missing(a, b))) == set(want) - set(have) and set(fields(verify.available(a, b))) == set(want) & set(have)
    r = verify.summary(a, b).first()
    assert r["missing"] == sorted(set(want) - set(have)) and r["all_available"] == (set(want) <= set(have))
    d = compare.difference(a, b).first()
    lacking = set(have) - set(want) - {PROBED_FIELD}
    assert (d["etl_fields"], d["contract_fields"], d["common_fields"]) == (len(want), len(have), len(set(want) & set(have)))
    assert d["etl_only"] == sorted(set(want) - set(have)) and d["contract_only"] == sorted(lacking) and d["compatible"] == (not lacking)


def test_compare(spark):
    etl, full = relation(spark, ETL_FIELDS), contract(spark)
    assert fields(compare.only_in(full, etl)) == [PROBED_FIELD] and fields(compare.only_in(full, etl, PROBED_FIELD)) == []
    assert len(fields(compare.common(full, etl))) == 53
    r = compare.final_list(etl).first()
    assert r["n_fields"] == 53 and r["fields"] == ", ".join(ETL_FIELDS)
    assert fields(compare.ordered(etl.orderBy("field"))) == list(ETL_FIELDS)


def test_slim(spark, tmp_path):
    header = ["extra", *reversed(CONTRACT_FIELDS), "Award_Type"]
    row = {f: f"v{i}" for i, f in enumerate(header)} | {"action_date": "2025-09-24", "federal_action_obligation": "12.5", "number_of_offers_received": "x"}
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        spark.createDataFrame([tuple(row[f] for f in header)], raw_schema(header)).write.parquet(str(tmp_path / "wide"))
        wide = spark.read.parquet(str(tmp_path / "wide"))
        cut = slim.slim(wide)
        assert cut.columns == list(CONTRACT_FIELDS)
        plan = cut._jdf.queryExecution().executedPlan().toString()
        assert "extra" not in plan.split("ReadSchema")[-1]
        typed = slim.typed(cut).first()
        assert str(typed["action_date"]) == "2025-09-24" and str(typed["federal_action_obligation"]) == "12.50" and typed["number_of_offers_received"] is None
        slim.write_slim(wide, str(tmp_path / "slim"), partition_by=["action_date_fiscal_year"])
        assert spark.read.parquet(str(tmp_path / "slim")).count() == 1
        with pytest.raises(slim.MissingFields) as e:
            slim.slim(wide.drop("naics_code", "award_type"))
        assert e.value.fields == ["naics_code", "award_type"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_report(spark):
    summary = verify.summary(contract(spark), relation(spark, ETL_FIELDS))
    lines = [r["line"] for r in report.lines(summary).collect()]
    assert lines[:2] == ["=" * 70, "available: 53 of 54"] and f"  - {PROBED_FIELD}" in lines and lines[-1] == "required fields are missing"
    text = report.markdown(summary)
    assert f"- `{PROBED_FIELD}`" in text and "incomplete" in text
