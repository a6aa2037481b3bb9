"""Every registered query against its DuckDB oracle, on the smallest scale."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["conversations", "documents", "benchmark", "labels", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    return repr(v) if isinstance(v, float) else str(v)


def digest(pdf):
    cols = sorted(pdf.columns)
    rows = sorted("\x1f".join(norm(v) for v in r) for r in pdf[cols].itertuples(index=False))
    return cols, hashlib.sha256("\x1e".join(rows).encode()).hexdigest()


def test_every_query_has_an_oracle():
    # The optional queries of the training-data subpackage have tests of their own.
    from convforge.plans import catalog
    # Tokens of a subword vocabulary are beyond SQL; see test_exact_truncation_on_documents.
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == {"truncate_exact_text"}
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dk = duck.execute(E.oracle_sql()[name]).df()
    assert len(sp) == len(dk)
    assert digest(sp) == digest(dk)


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert {r["split"] for r in rows} == {"train", "val"}
    assert "estimated_tokens" in df.columns


def test_exact_truncation_on_documents(spark, duck):
    """The whole query against a plain loop over the library's tokens."""
    import base64

    import public_tokenizers
    import tiktoken
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for doc_id, text in duck.execute("SELECT doc_id, text FROM documents").fetchall():
        ids = enc.encode_ordinary(text or "")
        want[doc_id] = (text if len(ids) <= 2048 else enc.decode(ids[:2048]), min(len(ids), 2048), len(ids) > 2048)
    got = {r["doc_id"]: (r["text"], r["n_tokens"], r["is_truncated"])
           for r in E.queries()["truncate_exact_text"](spark, SF_SMALL).collect()}
    assert any(cut for _, _, cut in want.values())
    assert got == want
