import pytest

from zonepipe.contract import Contract
from zonepipe.operators import quality
from zonepipe.operators.transform import transform

RAW = (
    "advertising_id string, location_source string, timestamp bigint, user_id string, "
    "user_latitude double, user_longitude double, month string, date string"
)
GOOD = ("A", "s", 1, "u", 1.0, 2.0, "01", "2024-01-02")
BAD = (None, "s", 2**40, "u", 1234.5, None, "01", "2020-13-01")


@pytest.fixture
def contract(tmp_path):
    return Contract.known("actives", str(tmp_path))


def verdicts(df):
    assert df.columns == list(quality.VERDICT)
    return {(r["check"], r["subject"]): (r["expected"], r["actual"], r["passed"]) for r in df.collect()}


def test_counts(spark):
    df = spark.createDataFrame([GOOD, BAD], RAW)
    assert tuple(quality.validate_counts(df).first()) == (2, 1)


def test_availability(spark):
    df = spark.createDataFrame([GOOD], RAW)
    assert verdicts(quality.validate_availability(df, "a")) == {("availability", "a"): ("> 0", "1", True)}
    for empty in (df.filter("false"), spark.createDataFrame([BAD], RAW)):
        failed = quality.validate_availability(empty, "a")
        assert verdicts(failed) == {("availability", "a"): ("> 0", "0", False)}
        with pytest.raises(quality.QualityError, match="availability"):
            quality.raise_on_failure(failed)


def test_reconcile(spark):
    two = spark.createDataFrame([GOOD, GOOD], RAW)
    one = two.limit(1)
    assert verdicts(quality.validate_reconcile(two, two, "a")) == {("reconcile", "a"): ("2", "2", True)}
    assert verdicts(quality.validate_reconcile(two, one, "a")) == {("reconcile", "a"): ("2", "1", False)}
    assert verdicts(quality.validate_reconcile(two, one.filter("false"), "a")) == {
        ("reconcile", "a"): ("2", "0", False)
    }


def test_types(spark, contract):
    raw = spark.createDataFrame([GOOD], RAW)
    done = verdicts(quality.validate_types(transform(raw, contract), contract))
    assert all(passed for _, _, passed in done.values())
    assert done["type", "user_latitude"] == ("decimal(10,7)", "decimal(10,7)", True)
    wrong = verdicts(quality.validate_types(raw, contract))
    assert wrong["type", "timestamp"] == ("int", "bigint", False)
    assert wrong["type", "location_source"] == ("string", "string", True)
    missing = verdicts(quality.validate_types(raw.drop("date"), contract))
    assert missing["type", "date"] == ("date", None, False)


def test_cast_loss_counts_nulled_values(spark, contract):
    raw = spark.createDataFrame([GOOD, BAD], RAW)
    lost = verdicts(quality.validate_cast_loss(raw, contract))
    assert lost == {
        ("cast_loss", "timestamp"): ("0", "1", False),
        ("cast_loss", "user_latitude"): ("0", "1", False),
        ("cast_loss", "user_longitude"): ("0", "0", True),
        ("cast_loss", "date"): ("0", "1", False),
    }


def test_raw_gate_reports_without_failing(spark, contract):
    raw = spark.createDataFrame([GOOD, BAD], RAW)
    rows = quality.raise_on_failure(quality.validate_raw(raw, contract), ("cast_loss", "null_key"))
    found = {(r["check"], r["subject"]): r["actual"] for r in rows}
    assert found["null_key", "advertising_id"] == "1"
    assert found["availability", "actives"] == "1"
    with pytest.raises(quality.QualityError, match="cast_loss"):
        quality.raise_on_failure(quality.validate_raw(raw, contract))


def test_staging_gate(spark, contract):
    staged = transform(spark.createDataFrame([GOOD], RAW), contract)
    assert quality.raise_on_failure(quality.validate_staging(staged, contract, "advertising_id", 1))
    with pytest.raises(quality.QualityError, match="reconcile"):
        quality.raise_on_failure(quality.validate_staging(staged, contract, "advertising_id", 2))


def test_missing_columns(spark, contract):
    raw = spark.createDataFrame([GOOD], RAW).withColumnRenamed("user_latitude", "user_lattitude")
    assert quality.validate_columns(raw, contract) == ["user_latitude"]
    renamed = Contract.known("actives", "/z", rename={"user_lattitude": "user_latitude"})
    assert quality.validate_columns(raw, renamed) == []


def test_no_casts_no_verdicts(spark):
    contract = Contract.known("actives", "/z", casts={})
    df = spark.createDataFrame([GOOD], RAW)
    assert quality.validate_types(df, contract).columns == list(quality.VERDICT)
    assert quality.validate_cast_loss(df, contract).count() == 0
