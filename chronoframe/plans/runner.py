"""Run every stage and write its outputs (the stage scripts, in order, then training and scoring).

Each output goes to ``out_dir`` (a shared path on a cluster). Sink order:
the cohort is clustered and sorted by stay (O1) and the model matrix and its
splits by (ID, t) within partitions (O2); nothing is globally sorted into one
partition.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from chronoframe.operators.labels import add_lookahead_label
from chronoframe.operators.model import sample_params, score, search_models
from chronoframe.operators.split import split_entities, split_rows
from chronoframe.operators.windows import forward_fill, window_features
from chronoframe.plans import stages
from chronoframe.sources import write_csv_table, write_domains, write_features, write_split_ids


#: Rows of a wide table that one task sorts.
SORTED_ROWS = 200_000


def sorted_by(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """Rows of one first key together, in order within partitions (O1, O2).
    ``rows``, where known, sets their number."""
    if rows is None:
        return df.repartition(keys[0]).sortWithinPartitions(*keys)
    few = min(df.sparkSession.sparkContext.defaultParallelism, rows // 5_000)
    return df.repartition(max(1, -(-rows // SORTED_ROWS), few), keys[0]).sortWithinPartitions(*keys)


def run_all(spark: SparkSession, sf_dir: str, out_dir: str, trials: list[dict] | None = None) -> dict[str, int]:
    """Write every stage's tables under ``out_dir``; return row counts. ``trials``
    are the parameter sets to choose from; without them one is drawn for each
    grid point, of the reference's space."""
    out = out_dir.rstrip("/")
    counts: dict[str, int] = {}

    # 1. cohort / death time
    cohort = stages.cohort(spark, sf_dir)
    write_csv_table(sorted_by(cohort, "ICUSTAY_ID"), f"{out}/labels/deathtime.csv")
    counts["cohort"] = spark.read.option("header", True).csv(f"{out}/labels/deathtime.csv").count()

    # 2. prevalence + time filter
    write_domains(stages.filtered_domains(spark, sf_dir), f"{out}/formatted/filtered_data")

    # 3. static, base and forward-filled features; 4. window features
    write_features(stages.static_table(spark, sf_dir), f"{out}/features/static_features")
    plan = stages.hourly_with_stats(spark, sf_dir, stages.dynamic_domains())
    for name, (hourly, st) in plan.items():
        base = stages.base_from(hourly, st)
        write_features(base, f"{out}/features/{name}_base")
        base = spark.read.parquet(f"{out}/features/{name}_base")
        write_features(forward_fill(base), f"{out}/features/{name}_ffill")
        write_features(window_features(base, st.binary, st.other), f"{out}/features/{name}_window")
        counts[f"{name}_base"] = base.count()

    # 5. outcome + model matrix
    outcome = stages.outcome(spark, sf_dir)
    write_csv_table(outcome, f"{out}/modeling/outcome.csv")
    matrix = stages.matrix(spark, sf_dir)
    write_features(sorted_by(matrix, "ID", "t", rows=stages.skeleton(spark, sf_dir).count()), f"{out}/modeling/model_matrix")
    matrix = spark.read.parquet(f"{out}/modeling/model_matrix")
    counts["matrix"] = matrix.count()

    # 6. label + split
    labelled = add_lookahead_label(matrix, outcome)
    splits = split_entities(labelled)
    write_split_ids(splits, f"{out}/modeling/ids")
    for which in ("train", "val", "test"):
        part = split_rows(labelled, splits, which)
        write_features(sorted_by(part, "ID", "t", rows=counts["matrix"]), f"{out}/modeling/{which}_df")
        counts[which] = spark.read.parquet(f"{out}/modeling/{which}_df").select("ID").distinct().count()

    # 7. train, choose, score: the best trial's model is saved with its features
    train, val, test = (spark.read.parquet(f"{out}/modeling/{w}_df") for w in ("train", "val", "test"))
    trials, model = search_models(train, val, test, trials or sample_params(1))
    write_csv_table(trials, f"{out}/modeling/trials.csv")
    model.save(spark, f"{out}/modeling/best_model")
    write_csv_table(score(model, test), f"{out}/modeling/predictions.csv")
    counts["predictions"] = test.count()
    counts["label_1"] = labelled.where("`24hour_mortality` = 1").count()
    return counts


def main() -> None:
    ap = argparse.ArgumentParser(description="write every stage output")
    ap.add_argument("sf_dir")
    ap.add_argument("out_dir")
    args = ap.parse_args()
    from chronoframe.session import drop_scratch, get_spark

    spark = get_spark()
    print(run_all(spark, args.sf_dir, args.out_dir))
    drop_scratch(spark)


if __name__ == "__main__":
    main()
