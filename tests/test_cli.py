import os

import pytest

from arrivals_mart.cli import main
from arrivals_mart.contracts import BY_NAME
from arrivals_mart.operators import QualityError
from arrivals_mart.sinks import read_loads, read_table
from fixtures import arrival, write_inputs


def test_run_table_and_ask(spark, tmp_dir, capsys):
    root = write_inputs(spark, f"{tmp_dir}/2016-04")
    out = main(["run", "--input", f"{tmp_dir}/{{ds}}", "--output", f"{tmp_dir}/mart", "--param", "ds=2016-04",
                "--no-publish"], spark=spark)
    paths = out["paths"]
    assert set(paths) == set(BY_NAME)
    assert {r["table_name"]: r["row_count"] for r in out["report"]}["immig_fact"] == 6

    one = main(["table", "visa_type_dim", "--input", root, "--output", f"{tmp_dir}/visa"], spark=spark)
    assert read_table(spark, one["paths"]["visa_type_dim"], BY_NAME["visa_type_dim"]).count() == 4
    assert one["report"][0]["row_count"] == 4

    answer = f"{tmp_dir}/answer"
    main(["ask", "airport-month", "--fact", paths["immig_fact"], "--time-dim", paths["time_dim"],
          "--airport-dim", paths["airport_dim"], "--airport", "NYC", "--write", answer], spark=spark)
    assert [tuple(r) for r in spark.read.parquet(answer).collect()] == [("NYC", "Pier Nine Heliport", 2016, 4, 2)]

    main(["ask", "state-population", "--fact", paths["immig_fact"], "--demographics-dim",
          paths["demographics_dim"]], spark=spark)
    shown = capsys.readouterr().out
    assert "NY" in shown and "2 of 2 rows shown" in shown


def test_table_reads_only_its_own_inputs(spark, tmp_dir):
    root = write_inputs(spark, f"{tmp_dir}/in")
    os.rename(f"{root}/airport-codes_csv.csv", f"{root}/codes_less.csv")
    out = main(["table", "airport_dim", "--input", root, "--airports", "codes_less.csv",
                "--output", f"{tmp_dir}/mart"], spark=spark)
    assert read_table(spark, out["paths"]["airport_dim"], BY_NAME["airport_dim"]).count() == 2
    # the airports are no longer where the default looks, and other tables do not care
    main(["table", "time_dim", "--input", root, "--output", f"{tmp_dir}/mart"], spark=spark)


def test_failed_table_raises(spark, tmp_dir):
    root = write_inputs(spark, f"{tmp_dir}/in", arrivals=[arrival(None)])
    with pytest.raises(QualityError):
        main(["table", "immig_fact", "--input", root, "--output", f"{tmp_dir}/mart"], spark=spark)


def test_second_load_of_the_same_keys_fails(spark, tmp_dir):
    root = write_inputs(spark, f"{tmp_dir}/in")
    args = ["table", "visa_type_dim", "--input", root, "--output", f"{tmp_dir}/mart", "--mode", "load"]
    assert main(args, spark=spark)["rows"] == 4
    with pytest.raises(QualityError, match="4 repeated values"):
        main(args, spark=spark)
    assert read_loads(spark, f"{tmp_dir}/mart", BY_NAME["visa_type_dim"]).count() == 4
