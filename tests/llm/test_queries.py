"""The registered corpus queries over the smallest shared tables: contract columns, and SQL where there is some."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from applens.llm.queries import ORACLES, QUERIES
from llm_fixtures import docs  # noqa: F401  (a fixture)

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

COLUMNS = {
    "op1": ["page_id", "host", "path", "rule", "verdict"], "op2": ["page_id", "url", "text", "n_chars"],
    "op3": ["doc_id", "item_id", "n_matched"], "op4": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op5": ["doc_id", "held_out", "score", "predicted"], "op6": ["doc_id", "n_words", "n_tokens"],
    "op7": ["doc_id", "start", "n_tokens", "ids_crc32"], "op8": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op9": ["doc_id", "fingerprint", "component_id"], "op10": ["doc_id", "size", "source_size", "target", "taken"],
    "op11": ["doc_id", "n_shingles", "component_id"],
    "op12": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op13": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
}


def test_one_query_per_operator_and_the_pipeline():
    assert [n.split("_")[0] for n in QUERIES] == list(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    number = name.split("_")[0]
    assert df.columns[:len(COLUMNS[number])] == COLUMNS[number]
    rows = [tuple(r) for r in df.collect()]
    if number == "op12":
        assert len(rows) == spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    elif number not in ("op3", "op13"):
        table = "pages" if number in ("op1", "op2") else "documents"
        assert len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name in ORACLES:
        con = duckdb.connect()
        for t in ("documents", "benchmark", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        cur = con.execute(ORACLES[name])
        assert [d[0] for d in cur.description] == df.columns
        assert sorted(rows, key=str) == sorted(cur.fetchall(), key=str)


def test_sql_of_suffix_dedup_and_decontamination_over_odd_rows(spark, docs, tmp_dir):
    """The same SQL over nulls, empty texts, repeated rows and texts of every kind."""
    from applens.llm import decontaminate, suffix_dedup
    from test_decontaminate import make as overlaps
    from test_suffix_dedup import make as repeats
    rows, items = overlaps(7)
    rows = rows + [(d + 5000, t) for d, t in repeats(9, 30)]
    table, bench = docs(rows), spark.createDataFrame(items, "item_id long, text string")
    table.coalesce(1).write.parquet(tmp_dir + "/documents")
    bench.coalesce(1).write.parquet(tmp_dir + "/benchmark")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_dir}/{t}/*.parquet')")
    got = sorted(map(tuple, suffix_dedup.without_repeats(table).collect()))
    assert got == sorted(con.execute(ORACLES["op4_suffix_dedup"]).fetchall())
    got = sorted(map(tuple, decontaminate.benchmark_overlaps(table, bench).collect()))
    assert got == sorted(con.execute(ORACLES["op3_decontamination"]).fetchall())
