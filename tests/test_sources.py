import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import columns as C
from ledgerlens.operators.enrich import FACT_COLUMNS, enrich, join_dimension, prepare
from ledgerlens.operators.features import build_features
from ledgerlens.sources import readers, schemas, sinks

TRANSACTIONS = """id,date,client_id,card_id,amount,use_chip,merchant_id,merchant_city,merchant_state,zip,mcc,errors
1,2019-01-01 00:01:00,7,70,$-77.00,Swipe Transaction,500,Beulah,ND,58523.0,5499,
2,2019-01-01 00:02:00,8,80,"$1,234.50",Online Transaction,501,Rome,Italy,,5411,"Bad PIN,Bad CVV"
3,2019-01-01 00:03:00,9,90,$5.25,Chip Transaction,502,ONLINE,,,9999,""
"""
USERS = """id,current_age,retirement_age,birth_year,birth_month,gender,address,latitude,longitude,per_capita_income,yearly_income,total_debt,credit_score,num_credit_cards
7,53,66,1966,11,Female,462 Rose Lane,34.15,-117.76,$29278,$59696,"$127,613",787,5
8,40,65,1979,1,Male,1 Main St,1.0,2.0,$10,$20,$0,540,1
"""
CARDS = """id,client_id,card_brand,card_type,card_number,expires,cvv,has_chip,num_cards_issued,credit_limit,acct_open_date,year_pin_last_changed,card_on_dark_web
70,7,Visa,Debit,4344676511950444,12/2022,623,YES,2,$24295,2002-09-01,2008,No
80,8,Mastercard,Credit,1,12/2022,1,NO,1,$0,09/2002,2010,No
"""


@pytest.fixture()
def paths(tmp_path):
    files = {"transactions.csv": TRANSACTIONS, "users.csv": USERS, "cards.csv": CARDS}
    files["mcc.json"] = json.dumps({"5499": "Miscellaneous Food Stores", "5411": "Grocery, Food"})
    files["labels.json"] = json.dumps({"target": {"1": "No", "2": "Yes", "99": "Yes"}}, indent=1)
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    at = lambda name: str(tmp_path / name)
    return readers.RawPaths(
        at("transactions.csv"), at("users.csv"), at("cards.csv"), at("mcc.json"), at("labels.json"),
        at("labels.parquet"),
    )


def pairs(df):
    return sorted((r["id"], r["is_fraud"]) for r in df.collect())


SECTIONS = {
    "about": {"77": "Yes", "target": {"78": "Yes"}},
    "target": {"501": "Yes", "502": "No", "-503": "Yes"},
    "later": {"79": "Yes"},
}


@pytest.mark.parametrize("indent", [None, 1, 4])
def test_only_the_target_section_holds_labels(spark, tmp_path, indent):
    path = tmp_path / "labels.json"
    path.write_text(json.dumps(SECTIONS, indent=indent))
    assert pairs(readers.read_labels(spark, str(path))) == [(-503, 1), (501, 1), (502, 0)]


@pytest.mark.parametrize("text", ['{"about": {"target": {"1": "Yes"}}}', '{"1": "Yes"}', "{}"])
def test_a_file_without_the_section_fails(spark, tmp_path, text):
    path = tmp_path / "labels.json"
    path.write_text(text)
    with pytest.raises(ValueError):
        readers.read_labels(spark, str(path))


def test_any_answer_but_yes_is_no(spark, tmp_path):
    path = tmp_path / "labels.json"
    path.write_text('{ "target" : { "8" : "YES", "9":"No, sorry", "9": "Yes" , "10": true, "11": null}, "x": {}}')
    assert pairs(readers.read_labels(spark, str(path))) == [(8, 0), (9, 0), (9, 1), (10, 0), (11, 0)]
    path.write_text('{"target": {}}')
    assert pairs(readers.read_labels(spark, str(path))) == []


def test_label_file_is_read_in_several_tasks(spark, tmp_path):
    path = tmp_path / "labels.json"
    path.write_text(json.dumps({"target": {str(i): "Yes" if i % 3 == 0 else "No" for i in range(200_000)}}))
    small = {"spark.sql.files.maxPartitionBytes": "400000", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        labels = readers.read_labels(spark, str(path))
        assert labels.rdd.getNumPartitions() > 1
        assert labels.agg(F.count("*"), F.sum("is_fraud"), F.countDistinct("id")).first()[:] == (200000, 66667, 200000)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_labels_are_cached_until_forced(spark, tmp_path):
    """Ids may be negative or repeated; the file is read again only by force."""
    source, stored = tmp_path / "marks.json", str(tmp_path / "kept.parquet")
    source.write_text('{"target": {"70": "Yes", "-4": "No", "70": "no", "812": "Yes"}}')
    kept = [(-4, 0), (70, 0), (70, 1), (812, 1)]
    assert sorted(pairs(readers.load_labels(spark, str(source), stored))) == kept
    source.write_text('{"target": {"-9": "Yes", "-9": "Yes"}}')
    assert sorted(pairs(readers.load_labels(spark, str(source), stored))) == kept
    assert pairs(readers.load_labels(spark, str(source), stored, force=True)) == [(-9, 1), (-9, 1)]


def test_empty_csv_fields_are_null_and_junk_fails(spark, paths, tmp_path):
    rows = readers.read_csv_table(spark, paths.transactions, schemas.TRANSACTIONS).orderBy("id").collect()
    assert [r["errors"] for r in rows] == [None, "Bad PIN,Bad CVV", None]
    assert rows[2]["merchant_state"] is None and rows[1]["zip"] is None
    bad = tmp_path / "bad.csv"
    bad.write_text(TRANSACTIONS.replace("58523.0", "somewhere"))
    with pytest.raises(Exception):
        readers.read_csv_table(spark, str(bad), schemas.TRANSACTIONS).collect()


def test_money(spark):
    texts = spark.createDataFrame([("$-77.00",), ("$59,696",), ("$1,234.50",), (None,)], "t string")
    assert [r[0] for r in texts.select(C.money(F.col("t"))).collect()] == [-77.0, 59696.0, 1234.5, None]
    with pytest.raises(Exception):
        spark.createDataFrame([("",)], "t string").select(C.money(F.col("t"))).collect()


def test_lenient_date_takes_whole_dates_only(spark):
    texts = ["2002-09-01", "2002/09/01", "2002-9-1", "2002-09", "2002", "09/2002", "2002-13-01", "2002-09/01", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r[1] for r in df.select("i", C.lenient_date(F.col("t")).cast("string")).orderBy("i").collect()]
    assert found == ["2002-09-01"] * 3 + [None] * 6


def test_prepare_keeps_every_transaction_and_null_labels(spark, paths):
    facts = prepare(spark, paths)
    assert facts.columns == FACT_COLUMNS
    rows = {r["transaction_id"]: r for r in facts.collect()}
    assert {k: r["is_fraud"] for k, r in rows.items()} == {1: 0, 2: 1, 3: None}
    assert rows[1]["amount"] == -77.0 and rows[2]["amount"] == 1234.5
    assert rows[1]["mcc_desc"] == "Miscellaneous Food Stores" and rows[3]["mcc_desc"] is None
    assert str(rows[1]["acct_open_date"]) == "2002-09-01" and rows[2]["acct_open_date"] is None
    assert rows[3]["card_brand"] is None and rows[3]["credit_score"] is None
    assert not {"card_number", "cvv", "expires", "address"} & set(facts.columns)
    assert {t.name for t in spark.catalog.listTables()} >= {"transactions", "users", "cards", "mcc", "labels", "tx_enriched"}


def test_ratio_to_a_zero_or_missing_limit_is_null(spark, paths):
    table = {r["transaction_id"]: r for r in build_features(readers.read_raw(spark, paths)).collect()}
    assert table[1]["amount_to_limit"] == -77.0 / 24295.0
    assert table[2]["amount_to_limit"] is None and table[3]["amount_to_limit"] is None
    assert (table[1]["card_age_years"], table[2]["card_age_years"]) == (17, None)


def test_repeated_dimension_keys_and_labels_do_not_fan_out(spark, paths):
    raw = readers.read_raw(spark, paths)
    doubled = readers.RawTables(
        raw.transactions, raw.users.union(raw.users), raw.cards.union(raw.cards),
        raw.mcc.union(raw.mcc), raw.labels.union(raw.labels),
    )
    assert enrich(doubled).count() == 3


def test_unused_dimensions_are_not_joined(spark, paths):
    facts = enrich(readers.read_raw(spark, paths))
    plan = facts.groupBy("use_chip").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_salted_join_equals_plain_join(spark):
    fact = spark.range(1000).select(
        F.col("id").alias("transaction_id"),
        # A third of the rows share key 1, a third have none.
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 50).alias("k"),
    )
    dimension = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    salted = join_dimension(fact, dimension, "k", "transaction_id", broadcast_rows=0, hot_rows=100)
    plain = fact.join(dimension, "k", "left")
    assert sorted(map(str, salted.select("transaction_id", "k", "v").collect())) == sorted(
        map(str, plain.select("transaction_id", "k", "v").collect())
    )


def test_json_report_rounds_and_formats(spark, tmp_path):
    df = spark.sql("SELECT 1/3D AS rate, TIMESTAMP_NTZ'2019-10-01 00:00:00' AS month, 'x' AS name")
    path = str(tmp_path / "report")
    sinks.write_report(df, path)
    text = spark.read.text(path).first()[0]
    assert json.loads(text) == {"rate": 0.3333333333, "month": "2019-10-01T00:00:00.000", "name": "x"}
