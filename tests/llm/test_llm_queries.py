"""Registered training-data queries: DuckDB parity, and no Python on native paths."""

from __future__ import annotations

import contextlib
import io

import pytest

from check_oracle import compare, duck
from touchline.llm import chat, queries, secret_ledger, winnowing
from touchline.llm.oracle import ORACLE

SMALL = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "FlatMapCoGroups", "WindowInPandas", "AggregateInPandas")


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_duckdb(spark, key):
    ok, message = compare(spark, key, SMALL, duck(SMALL))
    assert ok, message


@pytest.mark.parametrize("key", ["op3_chat", "op4_secrets", "op8_winnowing"])
def test_native_queries_start_no_python_worker(spark, key, monkeypatch):
    seen = []

    def look(df):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.explain("formatted")
        seen.append(text.getvalue())
        return df

    for module in (chat, queries, secret_ledger, winnowing):
        if hasattr(module, "stored"):
            monkeypatch.setattr(module, "stored", lambda df, name, f=module.stored: f(look(df), name))
    look(queries.queries()[key](spark, SMALL))
    assert seen and not any(node in text for text in seen for node in PYTHON_NODES)
