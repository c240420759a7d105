"""The byte copy from landing to raw."""

import hashlib
import os

import pytest

from zonepipe.contract import Contract
from zonepipe.operators.quality import QualityError
from zonepipe.operators.synth import synth_actives
from zonepipe.plans.dataset import run_dataset
from zonepipe.sources import verbatim
from zonepipe.sources.verbatim import ingest_bytes, validate_bytes
from zonepipe.sources.zones import land, scan_zone


def digests(folder):
    return {str(p.relative_to(folder)): hashlib.sha256(p.read_bytes()).hexdigest() for p in folder.rglob("*.parquet")}


def test_files_stay_as_they_are_and_stale_ones_go(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path / "a b+c%25"))
    rows = synth_actives(spark.range(40, numPartitions=3), "id")
    arrival = land(rows, contract, "1")
    landing, raw = (tmp_path / "a b+c%25" / z / "actives" for z in ("landing", "raw"))
    # Rows below further folders, and a file that is no data.
    os.makedirs(landing / arrival / "more")
    one = next((landing / arrival).glob("*.parquet"))
    (landing / arrival / "more" / "x.parquet").write_bytes(one.read_bytes())
    (landing / arrival / "notes.txt").write_text("no data")
    assert ingest_bytes(spark, contract, arrival) == [arrival]
    assert digests(raw) == digests(landing) and len(digests(raw)) == 4
    land(rows.limit(5), contract, "1")
    assert ingest_bytes(spark, contract) == [arrival]
    assert digests(raw) == digests(landing)
    assert scan_zone(spark, contract.ingest.destination).count() == 5
    assert not [p for p in raw.rglob("._*") if not p.name.endswith(".crc")]


def test_a_copy_that_differs_fails_the_gate(spark, tmp_path, monkeypatch):
    contract = Contract.known("actives", str(tmp_path))
    arrival = land(synth_actives(spark.range(10, numPartitions=2), "id"), contract, "1")
    ingest_bytes(spark, contract, arrival)
    paths = [f"{z}/{arrival}" for z in (contract.ingest.source, contract.ingest.destination)]
    assert validate_bytes(spark, arrival, *paths).first()["passed"]
    file = next((tmp_path / "raw" / "actives" / arrival).glob("*.parquet"))
    content = bytearray(file.read_bytes())
    content[len(content) // 2] ^= 1
    file.write_bytes(content)
    assert not validate_bytes(spark, arrival, *paths).first()["passed"]
    monkeypatch.setattr(verbatim, "copy_files", lambda *_: 0)
    with pytest.raises(QualityError, match=f"bytes.{arrival}"):
        run_dataset(spark, contract, "2024-01-01", 1, arrival, verbatim=True)
    monkeypatch.undo()
    assert run_dataset(spark, contract, "2024-01-01", 1, arrival, verbatim=True).lookup.new == 10


def test_an_arrival_that_is_one_file(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    land(synth_actives(spark.range(4, numPartitions=1), "id"), contract, "1")
    landing = tmp_path / "landing" / "actives"
    (one,) = (landing / "actives_1").glob("*.parquet")
    other = landing / "actives_2.parquet"
    other.write_bytes(one.read_bytes())
    assert ingest_bytes(spark, contract, "actives_2.parquet") == ["actives_2"]
    assert digests(tmp_path / "raw" / "actives") == {"actives_2/actives_2.parquet": hashlib.sha256(other.read_bytes()).hexdigest()}


def test_another_format_cannot_keep_its_bytes(spark, tmp_path):
    from dataclasses import replace

    contract = Contract.known("actives", str(tmp_path))
    with pytest.raises(ValueError, match="format"):
        ingest_bytes(spark, replace(contract, ingest=replace(contract.ingest, source_format="csv")))
