"""Small tables and readers shared by the tests of the corpus operators."""

from __future__ import annotations

import duckdb

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, schema: str = SCHEMA):
    """A documents table of ``texts`` (ids from 0), or of ``{id: text}``."""
    pairs = texts.items() if isinstance(texts, dict) else enumerate(texts)
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs]
    return spark.createDataFrame(rows, schema)


def table(sf: str, name: str) -> list[dict]:
    frame = duckdb.sql(f"SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return [dict(zip(frame.columns, r, strict=True)) for r in frame.fetchall()]


def by_id(df, key: str = "doc_id") -> dict:
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}
