"""The table-level API on the golden fixture: same answers as FIXTURES.md."""

import datetime as dt

from fixtures import END_DATE, RUN_TS
from cadence import api, schemas
from cadence.params import Params

P = Params.of(END_DATE, run_ts=RUN_TS)


def test_api_tables(golden):
    g = golden
    sess = api.sessions_aggregated(g["product_events"], g["sessions"], g["users"], g["app_events"],
                                   g["excluded"], P)
    assert sess.columns == schemas.SESSIONS_AGGREGATED.fieldNames()
    assert sorted(r.session_id for r in sess.collect()) == ["s1", "s10", "s4", "s5", "s6"]
    people = api.people_aggregated(sess, P)
    assert people.columns == schemas.PEOPLE_AGGREGATED.fieldNames() and people.count() == 4
    daily = api.user_daily_activity(g["product_events"], g["app_events"], g["invites"], g["users"],
                                    g["excluded"], "2024-02-10", P)
    assert daily.columns == schemas.USER_DAILY_ACTIVITY.fieldNames() and daily.count() == 102
    churn = {r.user_id: r for r in api.user_churn_state(daily, 14, "2024-02-10", P).collect()}
    assert (churn["u1"].app_churn_state, churn["u1"].app_churn_date) == ("churned", dt.date(2024, 2, 8))
    churn8 = {r.user_id: r for r in api.user_churn_state(daily.where("date <= '2024-02-08'"), 14,
                                                          "2024-02-08", P).collect()}
    assert churn8["u1"].app_churn_state == "reactivated"
    assert {r.etl_loaded_at for r in daily.select("etl_loaded_at").distinct().collect()} == {RUN_TS}


def test_churn_threshold_comes_from_params(spark):
    from cadence import api
    from cadence.params import Params
    from cadence.plans.catalog import QUERIES
    daily = QUERIES["user_daily_activity"](spark, "/root/testdata/sf0.001")
    p = Params.of(end_date="2024-01-31", threshold_days=2)
    by_params = sorted(map(str, api.user_churn_state(daily, params=p).drop("etl_loaded_at").collect()))
    by_argument = sorted(map(str, api.user_churn_state(daily, 2, "2024-01-31").drop("etl_loaded_at").collect()))
    assert by_params == by_argument


def test_row_cap_spares_the_exclusion_list(spark, tmp_path):
    from cadence import schemas
    from cadence.sources.readers import read_inputs
    schema = schemas.INPUTS["excluded"]
    row = tuple("x" if f.dataType.simpleString() == "string" else None for f in schema.fields)
    spark.createDataFrame([row] * 5, schema).write.parquet(str(tmp_path / "excluded"))
    assert read_inputs(spark, {"excluded": str(tmp_path / "excluded")}, limit=2)["excluded"].count() == 5
