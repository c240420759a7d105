"""Corrected arrivals, and what the manifest of a staging zone knows."""

import pytest
from pyspark.sql import functions as F

from zonepipe.contract import Contract
from zonepipe.operators.quality import QualityError
from zonepipe.operators.synth import synth_actives
from zonepipe.plans import dataset
from zonepipe.plans.dataset import manifest_of, read_back, run_dataset, scan_arrivals
from zonepipe.sources import manifest
from zonepipe.sources.files import remove
from zonepipe.sources.lookup import LookupStore
from zonepipe.sources.zones import ingest_raw, land


def rows_on(spark, n, days):
    """Synthetic rows dealt to days of January."""
    day = F.format_string("2024-01-%02d", F.element_at(F.array(*map(F.lit, days)), (F.col("timestamp") % len(days) + 1).cast("int")))
    return synth_actives(spark.range(n), "id").withColumns({"date": day, "month": F.lit("01")})


def folders(entries):
    return [e.folder for e in entries]


def staged_ids(spark, contract, names=None):
    return sorted(r[0] for r in scan_arrivals(spark, contract, names).select("advertising_id").collect())


def masked(rows):
    return sorted(r[0] for r in rows.select(F.sha2("advertising_id", 256)).collect())


def test_a_corrected_arrival_replaces_its_own_partitions(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    other = land(rows_on(spark, 30, [1, 2, 3]), contract, "0")
    run_dataset(spark, contract, "2024-01-01", 1, other)
    arrival = land(rows_on(spark, 60, [2, 3, 4, 5]), contract, "1")
    run_dataset(spark, contract, "2024-01-02", 2, arrival)
    corrected = rows_on(spark, 20, [3, 9])
    land(corrected, contract, "1")
    report = run_dataset(spark, contract, "2024-01-02", 2, arrival)
    assert all(c["passed"] for c in report.checks)
    assert staged_ids(spark, contract, [arrival]) == masked(corrected)
    assert staged_ids(spark, contract) == sorted(masked(corrected) + masked(rows_on(spark, 30, [1, 2, 3])))
    entries = manifest_of(spark, contract).entries(arrival)
    assert folders(entries) == [f"month=01/date=2024-01-{d}/arrival={arrival}" for d in ("03", "09")]
    assert sum(e.n_rows for e in entries) == 20
    # The lookup holds the corrected rows' keys beside the first arrival's.
    assert LookupStore.of(spark, contract).read().count() == 30


@pytest.mark.parametrize("step", ["announce", "write", "check"])
def test_a_run_that_died_anywhere_is_repeated_with_other_rows(spark, tmp_path, monkeypatch, step):
    contract = Contract.known("actives", str(tmp_path))
    arrival = land(rows_on(spark, 40, [1, 2, 3, 4]), contract, "1")
    run_dataset(spark, contract, "2024-01-01", 1, arrival)

    class Died(Exception):
        pass

    def die(*_, **__):
        raise Died

    with monkeypatch.context() as m:
        if step == "announce":
            m.setattr(manifest, "remove", die)
        elif step == "write":
            m.setattr(dataset, "stage", die)
        else:
            m.setattr(dataset, "check_staging", die)
        land(rows_on(spark, 40, [3, 7, 8]), contract, "1")
        with pytest.raises(Died):
            run_dataset(spark, contract, "2024-01-01", 1, arrival)
    last = rows_on(spark, 10, [8, 9])
    land(last, contract, "1")
    run_dataset(spark, contract, "2024-01-01", 1, arrival)
    assert staged_ids(spark, contract) == masked(last)
    assert [f.split("/")[1] for f in folders(manifest_of(spark, contract).entries(arrival))] == ["date=2024-01-08", "date=2024-01-09"]


def test_the_read_back_opens_the_files_of_its_arrival_only(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    arrivals = [land(rows_on(spark, 30, [1, 2]), contract, str(i)) for i in range(3)]
    for version, arrival in enumerate(arrivals, start=1):
        run_dataset(spark, contract, "2024-01-01", version, arrival)
    # Files of another arrival are no parquet any more: nobody looks at them.
    broken = list((tmp_path / "staging").glob(f"*/*/*/arrival={arrivals[0]}/part-*"))
    assert broken
    for file in broken:
        file.write_text("broken")
        (file.parent / f".{file.name}.crc").unlink()
    assert scan_arrivals(spark, contract, [arrivals[1]]).count() == 30
    run_dataset(spark, contract, "2024-01-01", 3, arrivals[2])
    files = scan_arrivals(spark, contract, [arrivals[2]]).inputFiles()
    assert files and all(f"arrival={arrivals[2]}/" in f for f in files)
    # The zone's columns come from the manifest too, without a footer.
    assert {"advertising_id", "month", "date"} <= set(scan_arrivals(spark, contract).columns)


def test_a_zone_from_before_the_manifest(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    arrival = land(rows_on(spark, 30, [1, 2, 3]), contract, "1")
    run_dataset(spark, contract, "2024-01-01", 1, arrival)
    remove(spark, f"{contract.transform.destination}/_manifest")
    assert scan_arrivals(spark, contract).count() == 30
    land(rows_on(spark, 9, [2]), contract, "1")
    run_dataset(spark, contract, "2024-01-01", 1, arrival)
    assert scan_arrivals(spark, contract).count() == 9


def test_a_whole_run_records_every_arrival(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    arrivals = [land(rows_on(spark, 10 + i, [1 + i, 2 + i]), contract, f"a b+c%{i}") for i in range(2)]
    run_dataset(spark, contract, "2024-01-01", 1)
    for i, arrival in enumerate(arrivals):
        entries = manifest_of(spark, contract).entries(arrival)
        assert sum(e.n_rows for e in entries) == sum(e.n_values for e in entries) == 10 + i
        assert len(entries) == 2 and staged_ids(spark, contract, [arrival]) == masked(rows_on(spark, 10 + i, [1 + i, 2 + i]))
    land(rows_on(spark, 4, [2]), contract, "a b+c%0")
    run_dataset(spark, contract, "2024-01-02", 2, arrivals[0])
    assert scan_arrivals(spark, contract).count() == 4 + 11


def test_partition_values_with_odd_characters_and_none(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path), partitions=("city",))
    city = F.element_at(F.array(*map(F.lit, ["a/b:c", "ü %+", None])), (F.col("timestamp") % 3 + 1).cast("int"))
    arrival = land(synth_actives(spark.range(30), "id").withColumn("city", city), contract, "1")
    run_dataset(spark, contract, "2024-01-01", 1, arrival)
    found = manifest_of(spark, contract).entries(arrival)
    assert len(found) == 3 and sum(e.n_rows for e in found) == 30
    assert scan_arrivals(spark, contract, [arrival]).count() == 30
    land(synth_actives(spark.range(5), "id").withColumn("city", F.lit("x")), contract, "1")
    run_dataset(spark, contract, "2024-01-01", 1, arrival)
    assert scan_arrivals(spark, contract).count() == 5


def test_arrivals_that_stage_a_column_in_two_types_stop_the_run(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    rows = rows_on(spark, 10, [1]).withColumn("more", F.lit(1))
    run_dataset(spark, contract, "2024-01-01", 1, land(rows, contract, "1"))
    second = land(rows.withColumn("more", F.lit("text")), contract, "2")
    with pytest.raises(QualityError, match="more was staged as int and as string"):
        run_dataset(spark, contract, "2024-01-01", 2, second)
    assert LookupStore.of(spark, contract).versions() == [1]


def test_an_arrival_without_partition_columns(spark, tmp_path):
    contract = Contract.known("viewership", str(tmp_path), partitions=())
    rows = rows_on(spark, 5, [1]).select("advertising_id", F.col("timestamp").alias("record_timestamp"))
    contract = Contract.known("viewership", str(tmp_path), partitions=(), casts={"record_timestamp": "IntegerType()"})
    arrival = land(rows, contract, "1")
    ingest_raw(spark, contract, arrival)
    run_dataset(spark, contract, "2024-01-01", 1, arrival)
    assert folders(manifest_of(spark, contract).entries(arrival)) == [f"arrival={arrival}"]


def test_staging_is_read_back_once(spark, tmp_path, monkeypatch):
    contract = Contract.known("actives", str(tmp_path))
    arrival = land(rows_on(spark, 20, [1, 2, 3]), contract, "1")
    reader, loaded = type(spark.read), []
    load = reader.load

    def noted(self, path=None, *args, **kwargs):
        loaded.append(path)
        return load(self, path, *args, **kwargs)

    monkeypatch.setattr(reader, "load", noted)
    run_dataset(spark, contract, "2024-01-01", 1, arrival)
    # One listing and one pass over the files, where there were four listings and two passes.
    assert len([paths for paths in loaded if "/staging/" in str(paths)]) == 1
    assert sum(e.n_rows for e in manifest_of(spark, contract).entries(arrival)) == 20


def test_a_first_column_that_is_a_partition_column(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path), partitions=("city",))
    rows = rows_on(spark, 9, [1]).withColumn("city", F.when(F.col("timestamp") % 3 > 0, F.lit("a%b")))
    rows = rows.select("city", *[c for c in rows.columns if c != "city"])
    n = rows.filter("city is not null").count()
    report = run_dataset(spark, contract, "2024-01-01", 1, land(rows, contract, "1"))
    assert [c["actual"] for c in report.checks if c["check"] == "reconcile"] == [str(n)] and 0 < n < 9
    found = manifest_of(spark, contract).entries("actives_1")
    assert sorted((e.n_rows, e.n_values) for e in found) == sorted([(n, n), (9 - n, 0)])


def test_a_partition_value_is_escaped_once(spark, monkeypatch):
    asked = []
    escaped = manifest.escaped
    monkeypatch.setattr(manifest, "escaped", lambda spark, value: asked.append(value) or escaped(spark, value))
    found = manifest.folders_of(spark, rows_on(spark, 30, [1, 2, 3]), ["month", "date"], "actives_1")
    assert len(found) == 3 and asked.count("01") == 1


def test_what_new_folders_lie_in_is_there_before_the_write(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    entries = manifest_of(spark, contract)
    for arrival, days in (("a", [1, 2]), ("b", [2, 3])):
        assert entries.make_way(arrival, rows_on(spark, 9, days)) == []
        for day in days:
            assert (tmp_path / f"staging/actives/month=01/date=2024-01-0{day}").is_dir()
        assert folders(entries.entries(arrival)) == [f"month=01/date=2024-01-0{d}/arrival={arrival}" for d in days]
    assert not list(tmp_path.glob("staging/actives/month=01/*/*"))


def test_an_announcement_waits_for_no_python_worker(spark, tmp_path, monkeypatch):
    entries = manifest_of(spark, Contract.known("actives", str(tmp_path)))
    plans, add = [], manifest.Manifest._add
    monkeypatch.setattr(
        manifest.Manifest, "_add", lambda self, part, rows: plans.append(rows._jdf.queryExecution().toString()) or add(self, part, rows)
    )
    odd = ["arrival=a%25b", "arrival=\u00e4 '\u20ac", "arrival=x"]
    entries._announce("a", odd)
    assert folders(entries.entries("a")) == sorted(odd) and entries.entries("a")[0].n_rows is None
    assert len(plans) == 1 and "ExistingRDD" not in plans[0] and "LogicalRDD" not in plans[0]


def test_counts_of_folders_are_kept_in_few_partitions(spark, tmp_path):
    contract = Contract.known("actives", str(tmp_path))
    arrival = land(rows_on(spark, 20, [1, 2]), contract, "1")
    run_dataset(spark, contract, "2024-01-01", 1, arrival)
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        with read_back(spark, "advertising_id", contract, [arrival]) as staged:
            assert staged.counted.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
            assert sum(r["n_rows"] for r in staged.counted.collect()) == 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
