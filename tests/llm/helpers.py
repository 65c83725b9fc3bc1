"""Small inputs shared by the tests of the training-data operators."""

import os
import re

import duckdb
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"
# names that the operators use inside
CLASHING = ["row", "t", "fp", "key", "kept", "score", "h", "id", "item", "digest", "n_words", "quality", "_x"]


def documents(spark, texts, clash=False):
    """``texts``: text, or (doc_id, text)."""
    rows = [(x if isinstance(x, tuple) else (i, x)) for i, x in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOCS)
    for c in CLASHING if clash else []:
        df = df.withColumn(c, F.lit("x"))
    return df


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def oracle_rows(sf_dir, sql):
    con = duckdb.connect()
    for t in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{t}'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), sorted(repr(tuple(dict(zip(names, r, strict=True))[c] for c in sorted(names)))
                                 for r in cur.fetchall())


def result_rows(df):
    return sorted(df.columns), sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


def table_rows(sf_dir, name, columns="*"):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()
