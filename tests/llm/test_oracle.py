"""The operators that SQL can express against DuckDB, on the given tables and on small odd ones."""

from __future__ import annotations

import duckdb
import pyarrow.parquet as pq
import pytest

from subscope.llm.oracle import ORACLE_SQL
from subscope.llm.queries import QUERIES
from tests.compare import mismatch

TABLES = ("documents", "embeddings")


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def small(tmp_path_factory):
    """Copies, near copies, shared passages, frequent phrases, odd texts and vectors."""
    folder = tmp_path_factory.mktemp("small")
    passage = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " \t\n", "one", "One", "two words", "two  Words", "x" * 350, "é€😀 ß Ünï " * 30, passage, passage,
             "a " + passage + " é", passage.replace("w30", "other"), "B. " + passage + "!\n" + passage, "x" * 99 + "é"]
    texts += [f"new york city, new york city is new york {i % 7}; york" for i in range(120)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, 's', 0)",
                    [(i, t, (None, "en")[i % 2]) for i, t in enumerate(texts)])
    con.execute("create table embeddings (vec_id bigint, embedding float[], label integer)")
    vectors = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [1.0, 0.0], [2.0, 0.0], [1.0, 0.3], [1.0, 0.5], [1.0],
               [float("inf"), 0.0], [-1.0, 0.0], [1.0, 0.0]]
    con.executemany("insert into embeddings values (?, ?, 0)", list(enumerate(vectors)))
    for t in TABLES:
        con.execute(f"copy {t} to '{folder}/{t}.parquet' (format parquet)")
        assert pq.read_table(f"{folder}/{t}.parquet").num_rows
    return str(folder)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_given_tables(spark, sf_dir, name):
    assert mismatch(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_odd_tables(spark, small, name):
    assert mismatch(QUERIES[name](spark, small), duck(small), ORACLE_SQL[name]) is None
