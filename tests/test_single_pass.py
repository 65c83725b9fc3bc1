"""Rows that several rules or parts read are made once."""

import fixtures as FX
from dimstar.operators import validation as V
from dimstar.sources import driver_faults as D


def test_requests_are_made_once(spark):
    """the duplicated ids come from the kept rule results."""
    made = spark.sparkContext.accumulator(0)
    requests = FX.requests(spark)
    n, first = requests.count(), requests.first()

    def counted(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    twice = requests.unionByName(spark.createDataFrame([first], requests.schema))
    val = V.validate_all(FX.customers(spark), FX.suppliers(spark), FX.operators(spark),
                         twice.mapInArrow(counted, requests.schema))
    rejected = val.quarantine_of("requests").collect()
    assert sum(r.reason == V.k.R_DUPLICATE_ID and r.key == str(first.id) for r in rejected) == 2
    assert val.requests_ok.count() + len(rejected) == n + 1
    assert made.value == n + 1


def test_faulty_entities_read_their_tables_once(spark):
    """a text of several parts, with a null key and a key in several parts."""
    for entity, text in D.ENTITIES.items():
        one = D._in_one_pass(entity, text)
        assert text.count("UNION ALL") >= 2 and "UNION ALL" not in one
        assert one.endswith(f"FROM {D._SOURCE[entity]})") and one.count(" JOIN ") == D._SOURCE[entity].count(" JOIN ")
    text = D.ENTITIES["operators"]
    part = spark.createDataFrame([(6, "a"), (6 + 47, "b"), (7, "c"), (None, "d"), (6, "a")], "p_partkey bigint, p_name string") \
        .selectExpr("*", "'x' AS p_brand", "'ECONOMY' AS p_type")
    rows = lambda t: sorted(map(str, spark.sql(t, part=part).collect()))
    assert rows(D._in_one_pass("operators", text)) == rows(text)
    assert len(rows(text)) == 5 + 3 + 2
