"""Command line: python -m tabwright {clean,train,tune,daily} ..."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tabwright.fixed import MEDIAN_ERROR, MODELS, SEED, TRIALS
from tabwright.operators.search import best_model, compare_models
from tabwright.operators.stats import preview, profile
from tabwright.plans.clean import run_clean
from tabwright.plans.train import run_train
from tabwright.plans.tune import run_tune
from tabwright.sources.tables import read_csv


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tabwright")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in {
        "profile": "show columns, types, non-null counts and the first rows of a raw table",
        "clean": "raw CSV to train and test tables",
        "train": "fit and evaluate the two default models",
        "tune": "search, refit and choose",
        "daily": "clean, then train",
    }.items():
        command = commands.add_parser(name, help=text)
        if name in ("profile", "clean", "daily"):
            command.add_argument("--raw", required=True, nargs="+", help="raw CSV paths, with wildcards or without")
        if name != "profile":
            command.add_argument("--train", required=True, help="train table path")
            command.add_argument("--test", required=True, help="test table path")
        if name in ("train", "tune", "daily"):
            command.add_argument("--output", required=True, help="folder for models, trials and run log")
        if name in ("clean", "daily"):
            command.add_argument("--medians-from", choices=["train", "all"], default="train")
            command.add_argument("--median-error", type=float, default=MEDIAN_ERROR, help="0 for exact medians")
            command.add_argument("--blank-as-null", action="store_true", help="fill blank categories too")
            command.add_argument("--keep-key", action="store_true", help="keep the key column in both tables")
            command.add_argument("--seed", type=int, default=SEED, help="seed of the split")
            command.add_argument("--versioned", action="store_true", help="write both tables as one new version")
        if name in ("train", "tune", "daily"):
            command.add_argument("--fit-pieces", type=int, help="pieces that fits deal the training rows into")
            command.add_argument("--max-categories", type=int, help="refuse columns with more categories")
        if name == "tune":
            command.add_argument("--trials", type=int, default=TRIALS, help="settings to try per model")
            command.add_argument("--seed", type=int, default=SEED, help="seed of the settings")
            command.add_argument("--parallelism", type=int, default=2, help="fits that overlap")
    return parser


def _show_models(metrics: DataFrame) -> None:
    compare_models(metrics, MODELS).show(truncate=False)
    best_model(metrics, MODELS).show(truncate=False)


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"tabwright-{args.command}").getOrCreate()
    if args.command == "profile":
        raw = read_csv(spark, args.raw, infer=True)
        profile(raw).show(len(raw.columns), truncate=False)
        preview(raw).show(truncate=False)
    if args.command in ("clean", "daily"):
        run_clean(
            spark,
            args.raw,
            args.train,
            args.test,
            medians_from=args.medians_from,
            median_error=args.median_error,
            seed=args.seed,
            blank_as_null=args.blank_as_null,
            keep_key=args.keep_key,
            refuse_blanks=args.command == "daily",
            versioned=args.versioned,
        ).orderBy("part", "label").show()
    fits = {}
    if args.command in ("train", "tune", "daily"):
        fits = {"max_categories": args.max_categories, "fit_pieces": args.fit_pieces}
    if args.command in ("train", "daily"):
        _show_models(run_train(spark, args.train, args.test, args.output, **fits))
    if args.command == "tune":
        options = {"trials": args.trials, "seed": args.seed, "parallelism": args.parallelism, **fits}
        _show_models(run_tune(spark, args.train, args.test, args.output, **options))


if __name__ == "__main__":
    main()
