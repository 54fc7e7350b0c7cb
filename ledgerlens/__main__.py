"""Run a job: ``spark-submit ledgerlens/__main__.py <job> --raw DIR --out DIR``.

jobs: eda, features, train, unsupervised, export
"""

from __future__ import annotations

import argparse
import json

from ledgerlens.operators import metrics
from ledgerlens.operators.split import TRAIN_FRACTION, VALID_FRACTION
from ledgerlens.plans import jobs
from ledgerlens.session import build_session
from ledgerlens.sources.readers import RawPaths

# File names of the raw data set.
FILES = {
    "transactions": "transactions_data.csv",
    "users": "users_data.csv",
    "cards": "cards_data.csv",
    "mcc": "mcc_codes.json",
    "labels": "train_fraud_labels.json",
}


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgerlens", description=__doc__)
    parser.add_argument("job", choices=["eda", "features", "train", "unsupervised", "export"])
    parser.add_argument("--raw", required=True, help="folder with the raw files")
    parser.add_argument("--out", required=True, help="shared folder for tables and reports")
    parser.add_argument("--sample", type=int, help="use the first N transactions only")
    parser.add_argument("--force", action="store_true", help="build again what is already there")
    parser.add_argument("--false-negative", type=float, default=metrics.Costs.false_negative, help="cost of a missed fraud")
    parser.add_argument("--false-positive", type=float, default=metrics.Costs.false_positive, help="cost of a false alarm")
    parser.add_argument("--train-share", type=float, default=TRAIN_FRACTION, help="share of the timeline that is trained on")
    parser.add_argument("--valid-share", type=float, default=VALID_FRACTION, help="share that the trees are stopped by")
    parser.add_argument("--categories", nargs="*", default=[], metavar="COLUMN", help="category columns the trees get besides the numbers")
    parser.add_argument("--legit-only", action="store_true", help="fit the detectors without frauds")
    parser.add_argument("--trees", type=json.loads, default={}, help='JSON object of settings of the trees, such as {"rounds": 300}')
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    args = parse(arguments)
    spark = build_session(f"ledgerlens-{args.job}")
    out = jobs.Outputs(args.out)
    folder = args.raw.rstrip("/")
    paths = RawPaths(
        **{name: f"{folder}/{file}" for name, file in FILES.items()}, labels_cache=out.path("labels")
    )
    settings = metrics.Evaluation(metrics.Costs(args.false_negative, args.false_positive))
    shares = (args.train_share, args.valid_share)
    if args.job == "eda":
        for name, table in jobs.eda(spark, paths, out, args.force).items():
            print(name)
            table.show(200, truncate=False)
    elif args.job == "features":
        print("rows:", jobs.build_features(spark, paths, out, args.sample, args.force).count())
    elif args.job == "train":
        jobs.train(spark, out, args.sample, settings, shares, tuple(args.categories), **args.trees).metrics.show(truncate=False)
    elif args.job == "unsupervised":
        jobs.unsupervised(spark, out, args.sample, settings, args.legit_only, shares).show(truncate=False)
    else:
        print(jobs.export_reports(spark, paths, out, args.sample, args.force, settings, shares))


if __name__ == "__main__":
    main()
