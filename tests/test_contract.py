import json

import pytest
from pyspark.sql import types as T

from zonepipe.contract import KNOWN_DATASETS, Contract
from zonepipe.functions import parse_type


def contract_file(root: str) -> dict:
    """A contract file in its documented layout."""
    config = {"lookup-dataset": {"data-location": f"{root}/lookup", "file-format": "parquet"}}
    for name, rules in KNOWN_DATASETS.items():
        zone = {
            z: {"data-location": f"{root}/{z}/{name}", "file-format": "parquet"}
            for z in ("landing", "raw", "staging")
        }
        config[f"ingest-{name}"] = {
            "source": zone["landing"],
            "destination": zone["raw"],
            "masking-cols": [],
            "transformation-cols": [],
            "partition-cols": [],
        }
        config[f"transformed-{name}"] = {
            "source": zone["raw"],
            "destination": zone["staging"],
            "masking-cols": list(rules["masks"]),
            "transformation-cols": rules["casts"],
            "partition-cols": list(rules["partitions"]),
        }
        config[f"pii-cols-{name}"] = list(rules["pii"])
        config["lookup-dataset"][f"{name}_pii-cols"] = list(rules["pii"])
    return config


@pytest.mark.parametrize("name", ["actives", "viewership"])
def test_file_equals_known_contract(spark, tmp_path, name):
    path = tmp_path / "contracts.json"
    path.write_text(json.dumps(contract_file("/zones"), indent=2))
    assert Contract.load(spark, str(path), name) == Contract.known(name, "/zones")


def test_list_of_casts_means_none():
    contract = Contract.from_json(json.dumps(contract_file("/zones")), "actives")
    assert contract.ingest.casts == {}
    assert contract.ingest.destination == "/zones/raw/actives"
    assert contract.lookup == "/zones/lookup/actives"


def test_optional_entries():
    config = contract_file("/zones")
    config["transformed-viewership"]["rename"] = {"channel": "channel_name"}
    config["lookup-dataset"]["viewership_tracked-cols"] = ["channel_name"]
    config["lookup-dataset"]["viewership_recency-cols"] = ["record_timestamp", "grid_id"]
    contract = Contract.from_json(json.dumps(config), "Viewership")
    assert contract.transform.rename == {"channel": "channel_name"}
    assert contract.tracked == ("channel_name",)
    assert contract.recency == ("record_timestamp", "grid_id")


def test_new_dataset_needs_keys():
    config = contract_file("/zones")
    for part in ("ingest-", "transformed-", "pii-cols-"):
        config[f"{part}visits"] = config[f"{part}actives"]
    with pytest.raises(ValueError, match="no lookup key"):
        Contract.from_json(json.dumps(config), "visits")
    config["lookup-dataset"]["visits_key-cols"] = ["advertising_id"]
    contract = Contract.from_json(json.dumps(config), "visits")
    assert contract.keys == ("advertising_id",)
    assert contract.pii == ("advertising_id", "user_id")


@pytest.mark.parametrize("name", ["other", ""])
def test_unknown_dataset(name):
    with pytest.raises(ValueError):
        Contract.from_json(json.dumps(contract_file("/zones")), name)
    with pytest.raises(ValueError):
        Contract.known(name, "/zones")


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("IntegerType()", T.IntegerType()),
        ("IntegerType", T.IntegerType()),
        ("DateType()", T.DateType()),
        ("ArrayType-StringType", T.StringType()),
        ("DecimalType", T.DecimalType(10, 7)),
        ("DecimalType()", T.DecimalType(10, 7)),
        ("DecimalType,3", T.DecimalType(10, 3)),
        ("DecimalType(12, 4)", T.DecimalType(12, 4)),
    ],
)
def test_type_strings(text, kind):
    assert parse_type(text) == kind


@pytest.mark.parametrize("text", ["Integer", "DecimalType(10)", "DecimalType,x", "date", ""])
def test_bad_type_strings(text):
    with pytest.raises(ValueError):
        parse_type(text)
