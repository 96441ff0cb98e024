from __future__ import annotations

import pytest

from subscope.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """Where the session names no checkpoint folder, the tests name one."""
    ship(spark)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))


#: Texts every operator on documents has to live with.
ODD_TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "two words"), (6, "x" * 5000), (7, "é€😀 ß Ünï " * 40),
    (8, "the same text again and again in this line " * 8), (9, "the same text again and again in this line " * 8),
    (9, "the same text again and again in this line " * 8), (None, "a document without an id but with some words"),
    (10, "long " * 30_000), (11, "a\x00b\x1c c\u00a0d\u2028e <|endoftext|> f  g\r\n\r\n h   "),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts with clashing and null columns."""
    rows = [(i, t, None, "src", None, "kept", 1.0, None) for i, t in ODD_TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id string, n double, `key` string")
