from chronoframe.operators.boosting import Booster
from chronoframe.operators.model import sample_params, score
from chronoframe.plans.runner import run_all


def test_stage_counts_match_fixture_table(spark, tmp_out):
    """Stage row counts at sf0.001 equal FIXTURES.md §3 (computed independently)."""
    c = run_all(spark, "/root/testdata/sf0.001", tmp_out + "/run", sample_params(1, iterations=(2, 4)))
    assert c["cohort"] == 14
    assert c["LABEVENTS_base"] == 7785
    assert c["OUTPUTEVENTS_base"] == 5910
    assert c["matrix"] == 499
    assert c["label_1"] == 8
    assert (c["train"], c["val"], c["test"]) == (8, 1, 3)
    trials = spark.read.option("header", True).csv(tmp_out + "/run/modeling/trials.csv")
    assert trials.count() == 16
    model = Booster.load(spark, tmp_out + "/run/modeling/best_model")
    test = spark.read.parquet(tmp_out + "/run/modeling/test_df")
    written = spark.read.option("header", True).csv(tmp_out + "/run/modeling/predictions.csv")
    assert score(model, test).count() == written.count() == c["predictions"]
