"""Dataset configurations as a table (S-09)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "name string, prefix string, title string, summary string, description string, url string, tags array<string>, "
    "publisher struct<name:string,description:string,url:string,country:string,country_label:string,official:boolean>, "
    "coverage struct<countries:array<string>,frequency:string>, licence struct<name:string,url:string>"
)


def parse_config(text: str) -> dict | None:
    """One row of a YAML document, or None without a name."""
    import yaml

    try:
        top = yaml.safe_load(text)
    except yaml.YAMLError:
        return None
    if not isinstance(top, dict):
        return None
    inner = top.get("dataset") if isinstance(top.get("dataset"), dict) else top
    if not inner.get("name"):
        return None
    block = lambda d, k: d.get(k) if isinstance(d.get(k), dict) else {}
    text_or = lambda v: None if v is None else str(v)
    words = lambda v: [str(x) for x in v] if isinstance(v, list) else []
    publisher, coverage, licence = block(top, "publisher"), block(top, "coverage"), block(inner, "licence")
    return {
        "name": str(inner["name"]), "prefix": text_or(inner.get("prefix")), "title": str(inner.get("title") or inner["name"]), "summary": text_or(inner.get("summary")), "description": text_or(inner.get("description")),
        "url": text_or(inner.get("url") or inner.get("index_url")), "tags": words(inner.get("tags")),
        "publisher": {k: text_or(publisher.get(k)) for k in ("name", "description", "url", "country", "country_label")} | {"official": publisher.get("official")},
        "coverage": {"countries": words(coverage.get("countries")), "frequency": text_or(coverage.get("frequency"))}, "licence": {k: text_or(licence.get(k)) for k in ("name", "url")},
    }


def dataset_dim(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row for each configuration file with a name."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [r for t in frame["value"] if (r := parse_config(t))]
            yield pd.DataFrame(rows, columns=["name", "prefix", "title", "summary", "description", "url", "tags", "publisher", "coverage", "licence"], dtype=object)

    return spark.read.text(paths, wholetext=True).mapInPandas(run, SCHEMA)
