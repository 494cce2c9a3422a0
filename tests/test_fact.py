import datetime as dt

from arrivals_mart.contracts import ARRIVALS_INPUT, IMMIG_FACT
from arrivals_mart.plans.tables import build_fact
from fixtures import ARRIVALS
from plan_util import plan_text


def test_fact_columns_and_values(spark):
    fact = build_fact(spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT))
    assert fact.columns == IMMIG_FACT.columns + ["i94_month"]
    assert [f.dataType for f in fact.schema.fields[:24]] == [f.dataType for f in IMMIG_FACT.schema.fields]
    rows = {r.cicid: r for r in fact.collect()}
    assert rows[2].i94_port == "NYC"
    assert rows[2].travel_mode_id == 0 and rows[3].travel_mode_id == 0
    assert rows[1].i94_arrival_date == 20574
    assert rows[4].i94_arrival_date is None and rows[5].i94_arrival_date is None
    assert rows[6].i94_arrival_date is None  # above INT range
    assert rows[1].i94_date_added == dt.date(2016, 4, 30)
    assert rows[3].i94_date_added is None and rows[4].i94_date_added is None
    assert rows[1].i94_admission_number == 92736214533.0
    assert rows[6].i94_month == 5


def test_fact_is_a_pure_projection(spark, tmp_dir):
    spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT).write.parquet(f"{tmp_dir}/a")
    fact = build_fact(spark.read.schema(ARRIVALS_INPUT).parquet(f"{tmp_dir}/a")).select("cicid", "i94_port")
    text = plan_text(fact)
    assert "Exchange" not in text
    assert "ReadSchema: struct<cicid:double,i94port:string>" in text


def test_conversion_losses_count_values_that_became_null(spark):
    from arrivals_mart.plans.tables import conversion_losses

    lost = {r.column_name: (r.source_column, r.lost_values)
            for r in conversion_losses(spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT)).collect()}
    assert len(lost) == 25
    assert lost["i94_arrival_date"] == ("arrdate", 2)  # NaN and 3e12; the null is not a loss
    assert lost["i94_date_added"] == ("dtadfile", 1)  # 'D/S'
    assert lost["travel_mode_id"] == ("i94mode", 0)
    assert lost["i94_port"] == ("i94port", 0)
