"""The whole workflow in one call, every result written as a Parquet table.

    python -m hourglass.plans.study --input interactions.csv --out /shared/study [--no-grid]

Tables written under ``out``: behavior_counts, top_items, top_users,
cardinalities, profile, item_index, user_index, split_counts, score_report
and certificate (first model), user_recs / item_recs (named, k=5), baseline_run,
ranking_metrics (k=5,10), runs (grid, appended as each run finishes),
leaderboard, rank_marginals, tradeoff_points. Each is computed by Spark and
written by Spark; the driver only sequences the steps.
"""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, explore, model, tuning
from ..operators.certificate import certificate
from ..operators.metrics import score_report
from ..operators.ratings import split_counts
from ..session import get_session
from ..sources import append_runs, read_interactions, read_runs, runs_frame
from .workflow import name_recommendations, prepare, train_evaluate


def _save(df: DataFrame, out: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")


def run_study(
    spark: SparkSession,
    interactions: DataFrame,
    out: str,
    behavior: str | None = "play",
    seed: int = 42,
    k: int = 5,
    grid: bool = True,
    blocks: int | None = None,
    configs: DataFrame | None = None,
) -> dict[str, str]:
    """``blocks`` sets the ALS blocks of every fit (``model.suggest_blocks``
    advises a count for large data); ``configs`` replaces the grid of 27."""
    tables = {}
    fixed = {} if blocks is None else {"num_blocks": blocks}
    first_model, baseline = (dataclasses.replace(c, **fixed) for c in (model.FIRST_MODEL, model.BASELINE))

    def save(name, df):
        _save(df, out, name)
        tables[name] = f"{out.rstrip('/')}/{name}"

    save("behavior_counts", explore.behavior_counts(interactions))
    save("top_items", explore.top_items(interactions, 10, behavior, labels=True))
    save("top_users", explore.top_users(interactions, 10, behavior))
    save("cardinalities", explore.cardinalities(interactions))
    save("profile", clean.profile(explore.plays(interactions, behavior)))

    prep = prepare(interactions, behavior=behavior, seed=seed)
    save("item_index", prep.items.table)
    save("user_index", prep.users.table)
    save("split_counts", split_counts(prep.ratings))
    train, test = prep.train.persist(), prep.test.persist()

    first = model.fit_als(train, first_model)
    save("certificate", certificate(first, train, first_model))
    save("score_report", score_report(model.predict(first, test, keep_cold=True)))
    user_named, item_named = name_recommendations(prep, first, k)
    save("user_recs", user_named)
    save("item_recs", item_named)

    # the tracked baseline: one fit gives the metrics table and the run record
    ev = train_evaluate(prep, baseline, (5, 10))
    save("ranking_metrics", ev.metrics)
    at10 = spark.read.parquet(tables["ranking_metrics"]).where("k = 10").first()
    runs_path = f"{out.rstrip('/')}/runs"
    # the baseline is a run of its own beside the grid's 27, under its own
    # split name; a rerun on the same data logs neither again
    split, data = f"md5-{seed}-0.2", tuning.data_id(train, test)
    record = tuning.run_record(baseline, ev.report.first(), at10, ev.extra["fit_seconds"], f"{split}-baseline", data)
    if not tuning._logged(spark, runs_path, f"{split}-baseline", data):
        append_runs(runs_frame(spark, [record]), runs_path)
    if grid:
        tuning.grid_search(train, test, configs, base=dataclasses.replace(model.ALSConfig(), **fixed), log_path=runs_path, split_id=split)
    # the views show the grid's runs of this data: the baseline is one of its
    # configurations and would count twice. Without a grid it is all there is
    shown = split if grid else f"{split}-baseline"
    runs = read_runs(spark, runs_path).where((F.col("data_id") == data) & (F.col("split") == shown))
    tables["runs"] = runs_path
    save("leaderboard", tuning.leaderboard(runs, 5))
    save("rank_marginals", tuning.rank_marginals(runs))
    save("tradeoff_points", tuning.tradeoff_points(runs))
    train.unpersist()
    test.unpersist()
    return tables


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="hourglass", description="implicit-feedback study: explore, train, recommend, evaluate, tune")
    ap.add_argument("--input", required=True, help="interaction table (headerless CSV or Parquet)")
    ap.add_argument("--format", default="csv", choices=("csv", "parquet"))
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--behavior", default="play")
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--no-grid", action="store_true")
    ap.add_argument("--blocks", type=int, default=None, help="ALS blocks per side of every fit")
    args = ap.parse_args(argv)
    spark = get_session()
    df = read_interactions(spark, args.input, fmt=args.format)
    for name, path in run_study(spark, df, args.out, args.behavior, args.seed, grid=not args.no_grid, blocks=args.blocks).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
