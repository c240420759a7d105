import datetime as dt
import hashlib
from decimal import Decimal

import pytest

from zonepipe.contract import Contract
from zonepipe.operators.pii import audit_columns, pii_pairs, swap_masked
from zonepipe.operators.transform import cast_columns, mask_columns, staged_schema, transform


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def one(df):
    return tuple(df.first())


def test_decimal_overflow_is_null_or_fails(spark):
    df = spark.createDataFrame([(1234.5,), (89.99,)], "lat double")
    casts = {"lat": "DecimalType()"}
    assert [r.lat for r in cast_columns(df, casts).collect()] == [None, Decimal("89.9900000")]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        cast_columns(df, casts, strict=True).collect()


def test_int_and_date(spark):
    df = spark.createDataFrame(
        [(7, "2020-01-31"), (2**40, "2020-13-01"), (None, None)], "n bigint, day string"
    )
    casts = {"n": "IntegerType()", "day": "DateType()"}
    done = cast_columns(df, casts)
    assert done.dtypes == [("n", "int"), ("day", "date")]
    assert [tuple(r) for r in done.collect()] == [(7, dt.date(2020, 1, 31)), (None, None), (None, None)]
    with pytest.raises(Exception, match="CAST"):
        cast_columns(df, casts, strict=True).collect()


def test_flatten(spark):
    casts = {"s": "ArrayType-StringType"}
    arrays = spark.createDataFrame([(["a", None, "b"],), ([],), (None,)], "s array<string>")
    assert [r.s for r in cast_columns(arrays, casts).collect()] == ["a,b", "", ""]
    text = spark.createDataFrame([("x",)], "s string")
    assert one(cast_columns(text, casts)) == ("x",)
    numbers = spark.createDataFrame([([1, 2],)], "s array<int>")
    assert one(cast_columns(numbers, casts)) == ("1,2",)


def test_mask(spark):
    df = spark.createDataFrame([("a", 5), ("", None), (None, 0)], "id string, n bigint")
    masked = mask_columns(df, ["id", "n"])
    assert [tuple(r) for r in masked.collect()] == [
        (sha("a"), sha("5")),
        (sha(""), None),
        (None, sha("0")),
    ]
    assert one(mask_columns(df, ["id"], pepper="p")) == (sha("pa"), 5)


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([("a",)], "id string")
    with pytest.raises(ValueError, match="user_id"):
        mask_columns(df, ["id", "user_id"])
    with pytest.raises(ValueError, match="duration"):
        cast_columns(df, {"duration": "IntegerType()"})


ACTIVE = (
    "advertising_id string, location_source array<string>, timestamp bigint, user_id string, "
    "lat double, user_longitude double, month string, date string"
)


def test_transform_renames_casts_then_masks(spark):
    contract = Contract.known("actives", "/z", rename={"lat": "user_latitude"})
    df = spark.createDataFrame([("A", ["s"], 10, "u", 1.5, 2.5, "01", "2020-01-02")], ACTIVE)
    out = transform(df, contract)
    assert out.first().asDict() == {
        "advertising_id": sha("A"),
        "location_source": "s",
        "timestamp": 10,
        "user_id": sha("u"),
        "user_latitude": Decimal("1.5000000"),
        "user_longitude": Decimal("2.5000000"),
        "month": "01",
        "date": dt.date(2020, 1, 2),
    }
    declared = {f.name: f.dataType for f in staged_schema(df.schema, contract)}
    assert declared == {f.name: f.dataType for f in out.schema}
    assert staged_schema(df.schema, contract).names[-2:] == ["month", "date"]


def test_pairs_audit_and_swap(spark):
    df = spark.createDataFrame([("A", "u", "x")], "advertising_id string, user_id string, city string")
    pairs = pii_pairs(df, ["advertising_id", "absent", "user_id"], ["city"])
    assert pairs.columns == ["advertising_id", "Masked_advertising_id", "user_id", "Masked_user_id", "city"]
    assert one(pairs) == ("A", sha("A"), "u", sha("u"), "x")
    audited = audit_columns(pairs, "2020-02-03")
    assert audited.dtypes[-2:] == [("begin_date", "date"), ("update_date", "date")]
    assert one(audited)[-2:] == (dt.date(2020, 2, 3), None)
    swapped = swap_masked(pairs, ["advertising_id", "user_id"])
    assert swapped.first().asDict() == {"advertising_id": sha("A"), "user_id": sha("u"), "city": "x"}
