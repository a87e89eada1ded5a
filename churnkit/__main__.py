"""``spark-submit`` entry: analyse, benchmark or train on one customer table."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from churnkit import TELCO, SplitSpec, sources
from churnkit.plans import jobs
from churnkit.spec import CHOSEN, MIN_RECALL


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="churnkit")
    parser.add_argument("job", choices=("analyse", "benchmark", "train"))
    parser.add_argument("input", help="CSV with a header row, or a Parquet folder")
    parser.add_argument("output", help="folder for the results")
    parser.add_argument("--schema", help="column types of the CSV as DDL; inferred if left out")
    parser.add_argument("--positive", default=TELCO.positive_value, help="label value that counts as churn")
    parser.add_argument("--seed", type=int, default=SplitSpec().seed)
    parser.add_argument("--parallelism", type=int, default=2, help="models fitted at the same time")
    parser.add_argument("--max-categories", type=int, help="refuse category columns with more values; no limit if left out")
    parser.add_argument("--leaderboard", help="train what this written leaderboard's best model names")
    parser.add_argument("--min-recall", type=float, default=MIN_RECALL, help="recall that the best model must reach")
    parser.add_argument("--line-breaks", action="store_true", help="cells of the input may hold line breaks")
    parser.add_argument("--score-on", choices=("holdout", "all"), default="holdout")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("churnkit").getOrCreate()
    if args.input.rstrip("/").endswith(".parquet"):
        raw = spark.read.parquet(args.input)
    else:
        raw = sources.read_csv(spark, args.input, args.schema, args.line_breaks)
    spec = replace(TELCO, positive_value=args.positive)
    options = {
        "split": SplitSpec(seed=args.seed), "parallelism": args.parallelism, "max_categories": args.max_categories
    }
    if args.job == "analyse":
        with jobs.analyse(raw, spec) as reports:
            jobs.write_analysis(reports, args.output)
    elif args.job == "benchmark":
        jobs.write_leaderboard(jobs.benchmark(raw, spec, **options), args.output)
    else:
        chosen = CHOSEN
        if args.leaderboard:
            chosen = jobs.choose(jobs.read_leaderboard(spark, args.leaderboard, spec.label), min_recall=args.min_recall)
            if chosen is None:
                parser.error(f"no model of {args.leaderboard} reaches a recall of {args.min_recall}")
        with jobs.train_and_score(raw, spec, chosen, score_on=args.score_on, **options) as scored:
            jobs.write_scored(scored, args.output, args.line_breaks)


if __name__ == "__main__":
    main()
