"""Runs a registered query and its SQL twin and compares rows as multisets."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _kind(type_name: str) -> str:
    name = str(type_name).lower()
    for kind, words in (("int", ("bigint", "int", "hugeint", "long")), ("float", ("double", "float")), ("text", ("varchar", "string")), ("bool", ("bool",))):
        if any(word in name for word in words):
            return kind
    return name


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    relation = con.sql(sql)
    found: list[str] = []
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} against {sorted(relation.columns)}"]
    kinds = {name: _kind(kind) for name, kind in df.dtypes}
    for name, kind in zip(relation.columns, relation.types):
        if kinds[name] != _kind(kind) or "hugeint" in str(kind).lower():
            found.append(f"type of {name}: {dict(df.dtypes)[name]} against {kind}")
    ours = Counter(tuple(row[name] for name in names) for row in df.collect())
    places = [relation.columns.index(name) for name in names]
    theirs = Counter(tuple(row[place] for place in places) for row in relation.fetchall())
    if ours != theirs:
        extra, lacking = ours - theirs, theirs - ours
        found.append(
            f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only ours {sum(extra.values())} {list(extra)[:2]}; only theirs {sum(lacking.values())} {list(lacking)[:2]}"
        )
    return found
