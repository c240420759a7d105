"""Dataset contracts: where a dataset lives and what has to be done to it.

A contract file is one JSON object for all datasets:

* ``ingest-<dataset>`` and ``transformed-<dataset>``: ``source`` and
  ``destination`` (``data-location``, ``file-format``), ``masking-cols``,
  ``transformation-cols`` (a map column → type string, or an empty list) and
  ``partition-cols``;
* ``pii-cols-<dataset>``: identifier columns;
* ``lookup-dataset``: ``data-location`` and ``<dataset>_pii-cols``.

Optional additions: ``rename`` under ``transformed-<dataset>`` (old → new column
name), and ``<dataset>_key-cols``, ``<dataset>_tracked-cols``,
``<dataset>_recency-cols`` under ``lookup-dataset``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Entry names of the contract file.
INGEST, TRANSFORM, PII, LOOKUP = "ingest-", "transformed-", "pii-cols-", "lookup-dataset"
SOURCE, DESTINATION, LOCATION, FORMAT = "source", "destination", "data-location", "file-format"
CASTS, MASKS, PARTITIONS = "transformation-cols", "masking-cols", "partition-cols"
LOOKUP_PII = "_pii-cols"

# Entry names of the optional additions.
RENAME = "rename"
LOOKUP_KEYS, LOOKUP_TRACKED, LOOKUP_RECENCY = "_key-cols", "_tracked-cols", "_recency-cols"

# The two datasets' declared types, masks, partitions and lookup rules.
KNOWN_DATASETS = {
    "actives": {
        "casts": {
            "location_source": "ArrayType-StringType",
            "timestamp": "IntegerType()",
            "user_latitude": "DecimalType()",
            "user_longitude": "DecimalType()",
            "date": "DateType()",
        },
        "masks": ("advertising_id", "user_id"),
        "partitions": ("month", "date"),
        "pii": ("advertising_id", "user_id"),
        "keys": ("advertising_id",),
        "tracked": ("user_id",),
        "recency": ("timestamp",),
    },
    "viewership": {
        "casts": {
            "duration": "IntegerType()",
            "location_source": "ArrayType-StringType",
            "record_timestamp": "IntegerType()",
            "user_lat": "DecimalType()",
            "user_long": "DecimalType()",
        },
        "masks": ("advertising_id",),
        "partitions": ("month", "date"),
        "pii": ("advertising_id",),
        "keys": ("advertising_id",),
        "tracked": (),
        "recency": ("record_timestamp",),
    },
}


@dataclass(frozen=True)
class ZoneStep:
    """One hop between two zones."""

    source: str
    destination: str
    source_format: str = "parquet"
    destination_format: str = "parquet"
    casts: Mapping[str, str] = field(default_factory=dict)
    masks: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ()
    rename: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Contract:
    """Everything the operators need to know about one dataset."""

    dataset: str
    ingest: ZoneStep
    transform: ZoneStep
    lookup: str
    pii: tuple[str, ...]
    keys: tuple[str, ...]
    tracked: tuple[str, ...] = ()
    recency: tuple[str, ...] = ()

    @staticmethod
    def load(spark: SparkSession, path: str, dataset: str) -> Contract:
        """Read the contract file (one small text file) and pick ``dataset``."""
        text = spark.read.text(path, wholetext=True).first()[0]
        return Contract.from_json(text, dataset)

    @staticmethod
    def from_json(text: str, dataset: str) -> Contract:
        config = json.loads(text)
        name = dataset.lower()
        if name not in datasets_in(config):
            raise ValueError(f"no contract for dataset {dataset!r}; known: {datasets_in(config)}")
        lookup = config[LOOKUP]
        rules = KNOWN_DATASETS.get(name, {})

        def lookup_rule(suffix: str, known: str) -> tuple[str, ...]:
            return tuple(lookup.get(name + suffix, rules.get(known, ())))

        keys = lookup_rule(LOOKUP_KEYS, "keys")
        if not keys:
            raise ValueError(f"contract of {dataset!r} names no lookup key")
        return Contract(
            dataset=name,
            ingest=_step(config[INGEST + name]),
            transform=_step(config[TRANSFORM + name]),
            lookup=f"{lookup[LOCATION].rstrip('/')}/{name}",
            pii=tuple(lookup.get(name + LOOKUP_PII) or config[PII + name]),
            keys=keys,
            tracked=lookup_rule(LOOKUP_TRACKED, "tracked"),
            recency=lookup_rule(LOOKUP_RECENCY, "recency"),
        )

    @staticmethod
    def known(dataset: str, root: str, **changes) -> Contract:
        """Contract of one of the two known datasets with all zones under ``root``.

        ``changes`` replaces entries of the fixed values, e.g. ``tracked=("channel_name",)``.
        """
        if dataset not in KNOWN_DATASETS:
            raise ValueError(f"unknown dataset {dataset!r}; known: {sorted(KNOWN_DATASETS)}")
        rules = {**KNOWN_DATASETS[dataset], **changes}
        base = root.rstrip("/")
        landing, raw = f"{base}/landing/{dataset}", f"{base}/raw/{dataset}"
        return Contract(
            dataset=dataset,
            ingest=ZoneStep(landing, raw),
            transform=ZoneStep(
                raw,
                f"{base}/staging/{dataset}",
                casts=rules["casts"],
                masks=rules["masks"],
                partitions=rules["partitions"],
                rename=rules.get("rename", {}),
            ),
            lookup=f"{base}/lookup/{dataset}",
            pii=rules["pii"],
            keys=rules["keys"],
            tracked=rules["tracked"],
            recency=rules["recency"],
        )


def datasets_in(config: Mapping) -> list[str]:
    """Dataset names a parsed contract file describes."""
    return sorted(key[len(TRANSFORM):] for key in config if key.startswith(TRANSFORM))


def _step(part: Mapping) -> ZoneStep:
    # The casts are a map when there is something to cast and may be an empty list.
    return ZoneStep(
        source=part[SOURCE][LOCATION],
        destination=part[DESTINATION][LOCATION],
        source_format=part[SOURCE].get(FORMAT, "parquet"),
        destination_format=part[DESTINATION].get(FORMAT, "parquet"),
        casts=dict(part.get(CASTS) or {}),
        masks=tuple(part.get(MASKS) or ()),
        partitions=tuple(part.get(PARTITIONS) or ()),
        rename=dict(part.get(RENAME) or {}),
    )
