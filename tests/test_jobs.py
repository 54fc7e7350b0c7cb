import json

import pytest

from ledgerlens.plans import jobs
from ledgerlens.registry import adapters, files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def setting(spark, tmp_path_factory):
    paths = files.write_raw(spark, adapters.raw_tables(spark, SF, dense=True))
    return paths, jobs.Outputs(str(tmp_path_factory.mktemp("out")))


def test_training_needs_features(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        jobs.train(spark, jobs.Outputs(str(tmp_path)))


def test_jobs_end_to_end(spark, setting, tmp_path):
    paths, out = setting
    tables = jobs.eda(spark, paths, out)
    assert set(tables) == {"summary", "by_hour", "by_dow", "amounts", "by_category", "by_month"}
    assert tables["summary"].first()["transactions"] == 1000

    table = jobs.build_features(spark, paths, out)
    assert table.count() == 1000 and len(table.columns) == 38
    small = jobs.build_features(spark, paths, out, sample_rows=50)
    assert small.count() == 50
    assert jobs.build_features(spark, paths, out).count() == 1000

    result = jobs.train(spark, out, rounds=4, min_rows_per_leaf=20, max_depth=3, categories=("use_chip", "mcc"))
    rows = {(r["model"], r["part"]): r for r in result.metrics.collect()}
    assert set(rows) == {("baseline", "test"), ("boosted", "valid"), ("boosted", "test")}
    assert rows["boosted", "test"]["n"] == result.predictions.count() == result.split.part("test").count()
    assert rows["boosted", "test"]["n_features"] == 27

    metrics = jobs.unsupervised(spark, out)
    counts = {r["model"]: r["n"] for r in metrics.collect()}
    assert counts == {"isolation_forest": rows["boosted", "test"]["n"], "lof": rows["boosted", "test"]["n"]}

    held = jobs.read_manifest(spark, out, "train", None)
    assert json.loads(held["categories"]) == ["use_chip", "mcc"] and json.loads(held["trees"])["rounds"] == 4
    dearer = jobs.metrics.Evaluation(jobs.metrics.Costs(false_negative=300.0))
    with pytest.raises(ValueError, match="false_negative"):
        jobs.export_reports(spark, paths, out, settings=dearer)
    with pytest.raises(ValueError, match="train_share"):
        jobs.export_reports(spark, paths, out, shares=(0.6, 0.2))
    with pytest.raises(FileNotFoundError):
        jobs.export_reports(spark, paths, out, sample_rows=50)
    target = jobs.export_reports(spark, paths, out)

    def records(name):
        return [json.loads(r[0]) for r in spark.read.text(f"{target}/{name}").collect()]

    summary = records("summary")[0]
    assert summary["transactions"] == 1000 == summary["labeled"] + summary["unlabeled"]
    parts = records("split")[0]
    assert parts["train"] + parts["valid"] + parts["test"] == summary["labeled"]
    assert sum(r["n"] for r in records("eda_by_hour")) == summary["labeled"]
    assert [r["hour"] for r in records("eda_by_hour")] == sorted(r["hour"] for r in records("eda_by_hour"))
    assert sum(r["n"] for r in records("deciles")) == parts["test"]
    assert len(records("feature_importance")) == 20
    compared = {r["model"]: r for r in records("model_comparison")}
    assert set(compared) == {"baseline", "boosted"}
    assert compared["baseline"]["savings"] == 0.0
    assert compared["boosted"]["savings"] == pytest.approx(
        rows["baseline", "test"]["total_cost"] - rows["boosted", "test"]["total_cost"]
    )
    assert len(records("unsupervised_comparison")) == 6
    assert sum(r["n"] for r in records("anomaly_histogram")) == parts["test"]
    assert 0 < sum(r["n"] for r in records("eda_amount_histogram")) <= summary["labeled"]
    assert {r["day"] for r in records("eda_by_dow")} <= {"Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"}
    assert spark.read.parquet(f"{target}/top_risk").count() == min(500, parts["test"])


def test_command_line(spark, tmp_path, capsys):
    from ledgerlens import __main__ as command
    from tests import test_sources as raw

    files_of = {
        "transactions": raw.TRANSACTIONS, "users": raw.USERS, "cards": raw.CARDS,
        "mcc": json.dumps({"5499": "Food"}), "labels": json.dumps({"target": {"1": "No", "2": "Yes"}}),
    }
    for name, text in files_of.items():
        (tmp_path / command.FILES[name]).write_text(text, encoding="utf-8")
    folders = ["--raw", str(tmp_path), "--out", str(tmp_path / "out")]
    command.main(["features", *folders])
    assert "rows: 3" in capsys.readouterr().out
    command.main(["features", *folders, "--sample", "2"])
    assert "rows: 2" in capsys.readouterr().out
    args = command.parse(["train", *folders, "--false-negative", "7", "--train-share", "0.5", "--categories", "mcc", "--trees", '{"rounds": 3}'])
    assert (args.false_negative, args.false_positive, args.train_share, args.categories, args.trees) == (7.0, 5.0, 0.5, ["mcc"], {"rounds": 3})
    command.main(["eda", *folders])
    assert "by_month" in capsys.readouterr().out
