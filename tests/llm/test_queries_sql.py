"""The registered corpus queries against their SQL, on the smallest tables."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidemark.llm import licenses
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    found = QUERIES[name](spark, SF)
    said = con.execute(ORACLE[name])
    columns = [d[0] for d in said.description]
    assert sorted(found.columns) == sorted(columns)
    assert rows_of(found.columns, found.collect()) == rows_of(columns, said.fetchall())


def equals_sql(spark, folder, name, table):
    """The rows of a query on one table of ``folder``, after they were held against its SQL."""
    found = QUERIES[name](spark, str(folder))
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    said = con.execute(ORACLE[name])
    columns, rows = [d[0] for d in said.description], found.collect()
    assert rows_of(found.columns, rows) == rows_of(columns, said.fetchall())
    return rows


def test_license_texts_of_the_whole_catalogue_equal_the_sql(spark, tmp_path):
    known = [*licenses.CATALOGUE, *licenses.entire_licenses()]
    notice = "Licensed under the MPL 2.0."
    texts = [t for _, t in known] + ["# Copyright (c) 2020 A B\n" + t.upper() for _, t in known if len(t) > 200] + [
        None, "", "Copyright 2020", "(c) 2019 X", "* Copyright 2021 Y. Released under the MIT License.", f"Words.\n// {notice}\nMore words.",
        "All rights reserved. licensed under CC-BY 4.0", "Copyright holders: Released under the MIT License.", f"{notice}\n{notice}\nReleased under CC0-1.0.",
        "copyrighted. licenced under the GPL v3 or later", "Copyright X released undermined terms", "This is not a license.", "©Licensed under the ISC License."]
    pq.write_table(pa.table({"doc_id": list(range(len(texts))), "text": texts}), tmp_path / "documents.parquet")
    rows = {r.doc_id: r for r in equals_sql(spark, tmp_path, "op6_licenses", "documents")}
    # Every form of the catalogue is found as a whole text (some are short enough to have several names).
    assert all(rows[i].whole for i in range(len(known)))
    assert sum(rows[i].whole == name for i, (name, _) in enumerate(known)) > 0.99 * len(known)
    assert all(rows[i].whole for i, t in enumerate(texts) if t and t.startswith("# Copyright"))


def test_repeated_vectors_equal_the_sql(spark, tmp_path):
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (50, [0.5, 0.5]), (7, [2.0, 0.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0]), (8, [0.0, 3.0]),
            (9, None), (10, []), (None, [9.0, 9.0]), (11, [1.0, None]), (12, [float("nan"), 1.0]), (13, [-1.0, -1.0]), (14, [-1.0, -1.0])]
    ids, vectors = zip(*rows)
    pq.write_table(pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32()))}),
                   tmp_path / "embeddings.parquet")
    found = equals_sql(spark, tmp_path, "op7_topk", "embeddings")
    assert len(found) == 15 and [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == 50] == [8, 7, 7, 7, 0]
