"""Audience definitions: defaults merged under per-audience overrides."""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.schemas import TABLES

FIELDS = ("audience_id", "name", "brand_keywords", "date_start", "date_end")


def merge_defaults(entries: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """``entries`` with NULL or absent fields taken from ``defaults``; the config table's columns."""
    schema = TABLES["audience_config"]
    out = []
    for f in schema.fields:
        own = F.col(f.name) if f.name in entries.columns else F.lit(None)
        out.append(F.coalesce(own.cast(f.dataType), F.lit(defaults.get(f.name)).cast(f.dataType))
                   .alias(f.name))
    return entries.select(*out)


def audience_config(spark: SparkSession, defaults: Mapping, entries: list[Mapping]) -> DataFrame:
    """Config table from plain mappings.  No audience, or one without id or keywords, is an error."""
    if not entries:
        raise ValueError("no audiences defined")
    rows = []
    for entry in entries:
        merged = {**defaults, **entry}
        missing = [k for k in FIELDS if not merged.get(k)]
        if missing:
            raise ValueError(f"audience {merged.get('name', '?')!r} lacks {', '.join(missing)}")
        rows.append((str(merged["audience_id"]), str(merged["name"]),
                     [str(k) for k in merged["brand_keywords"]],
                     str(merged["date_start"]), str(merged["date_end"])))
    schema = "audience_id string, name string, brand_keywords array<string>, " \
             "date_start string, date_end string"
    return merge_defaults(spark.createDataFrame(rows, schema), {})


def load_audiences(spark: SparkSession, path: str) -> DataFrame:
    """Config table from a YAML or JSON file with ``defaults`` and ``audiences``."""
    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(f"config file not found: {file.resolve()}")
    if file.suffix == ".json":
        raw = json.loads(file.read_text())
    else:
        try:
            import yaml
        except ImportError as exc:
            raise RuntimeError("reading YAML needs the yaml package; use JSON instead") from exc
        raw = yaml.safe_load(file.read_text())
    raw = raw or {}
    return audience_config(spark, raw.get("defaults") or {}, raw.get("audiences") or [])
