import os
import sys

import duckdb

from conftest import SF_SMALL
from dimstar.sources.driver import requests_entity, table

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402


def test_gate_rejects_repeated_line_keys(spark, tmp_path):
    tables = ("region", "nation", "customer", "supplier", "part", "orders")
    for t in tables:
        os.symlink(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    lines = table(spark, SF_SMALL, "lineitem").dropDuplicates(["l_orderkey", "l_linenumber"])
    n = lines.count()
    lines.union(lines.where("l_orderkey % 2 = 0")).write.parquet(str(tmp_path / "lineitem.parquet"))
    even = lines.where("l_orderkey % 2 = 0").count()
    rows = {r.table: r for r in E.queries()["reject_gate"](spark, str(tmp_path)).collect()}
    edge = {r.table: r for r in E.queries()["reject_gate_edge"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    for t in (*tables, "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet{'/*.parquet' if t == 'lineitem' else ''}'")
    for name, found in (("reject_gate", rows), ("reject_gate_edge", edge)):
        told = {r[0]: r[1:4] for r in con.execute(E.oracle_sql()[name]).fetchall()}
        assert told == {t: (r.n_total, r.n_ok, r.n_ko) for t, r in found.items()}
    assert rows["requests"].n_total == n + even and rows["requests"].n_ko >= 2 * even > 0
    ids = [r.id for r in requests_entity(spark, str(tmp_path), numbered=False).collect()]
    assert len(ids) - len(set(ids)) == even
