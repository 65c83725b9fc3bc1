import pytest
from pyspark.sql import functions as F

import fixtures as FX
from dimstar.model import KpiParams
from dimstar.operators import kpis as K
from dimstar.operators import validation as V
from dimstar.operators.checks import ForeignKeyViolation, enforce_fks, fk_orphans
from dimstar.plans.load import build, read_warehouse, write_warehouse
from dimstar.plans.sql_api import run_sql


def test_gate_stops_the_load_before_any_write(spark):
    with pytest.raises(V.RejectRatioExceeded):
        build(FX.customers(spark), FX.suppliers(spark), FX.operators(spark), FX.requests(spark))


def test_load_write_read_kpis(spark, tmp_path):
    loaded = build(FX.customers(spark), FX.suppliers(spark), FX.operators(spark), FX.requests(spark),
                   gate_limit=None)
    paths = write_warehouse(loaded, str(tmp_path / "wh"))
    assert set(paths) == {"time_dim", "customer_dim", "supplier_dim", "operator_dim", "request_fact", "quarantine"}
    star = read_warehouse(spark, str(tmp_path / "wh"), loaded.calendar)
    assert star.fact.count() == 5 and star.time_dim.count() == 730
    p = KpiParams.of("2025-01-01", "2026-12-31")
    s = K.kpi_summary(star, p).collect()[0]
    assert (s.n_requests, s.active_customers) == (5, 1)
    assert s.revenue == 80.0  # requests 1 and 20 are invoiced, 40.00 each
    assert abs(s.cancel_rate - 0.2) < 1e-12
    # rebuild into the same folder: same result (full, idempotent rebuild)
    write_warehouse(loaded, str(tmp_path / "wh"))
    star2 = read_warehouse(spark, str(tmp_path / "wh"), loaded.calendar)
    assert K.kpi_summary(star2, p).collect() == K.kpi_summary(star, p).collect()
    # named-parameter SQL over the same star
    v = run_sql(spark, star, "cancel_rate", KpiParams.of("2025-01-01", "2026-12-31", category="driving_school"))
    assert abs(v.collect()[0].value - 0.2) < 1e-12
    empty = run_sql(spark, star, "cancel_rate", KpiParams.of("2025-01-01", "2026-12-31", province="ZZ"))
    assert empty.collect()[0].value is None


def test_fk_orphans_use_not_in_semantics(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    row = fk_orphans(fact, [("k", dim, "k")]).collect()[0]
    assert row.orphans == 1 and row.ok is False
    with pytest.raises(ForeignKeyViolation):
        enforce_fks(fact, [("k", dim, "k")])
    assert fk_orphans(fact.where(F.col("k") != 2), [("k", dim, "k")]).collect()[0].ok


def test_not_null_contract_catches_null_birth_date(spark):
    from dimstar.operators.checks import not_null_unique
    from dimstar.operators.dims import build_customer_dim_scd2
    val = V.validate_all(FX.customers(spark), FX.suppliers(spark), FX.operators(spark), FX.requests(spark))
    dim = build_customer_dim_scd2(val.customers_ok)
    r = not_null_unique(dim, "customer_dim", ["customer_key", "birth_date"], ["customer_key"]).collect()[0]
    assert (r.n_rows, r.null_violations, r.dup_keys, r.ok) == (3, 1, 0, False)


def test_unreachable_status_is_quarantined(spark):
    from dimstar.operators.states import filter_unreachable
    df = spark.createDataFrame([(1, "booked"), (2, "open"), (3, None), (4, "invoiced")], "id int, status string")
    ok, q = filter_unreachable(df)
    assert sorted(r.id for r in ok.collect()) == [1, 4]
    assert sorted(r.key for r in q.collect()) == ["2", "3"]


def test_share_check_missing_and_empty(spark):
    from dimstar.operators.checks import share_check
    exp = [("a", 0.5, 0.1), ("b", 0.5, 0.1), ("c", 0.0, 0.01)]
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",)], "s string")
    got = {r.value: (r.n, r.share, r.ok) for r in share_check(df, "s", exp).collect()}
    assert got == {"a": (2, 0.5, True), "b": (2, 0.5, True), "c": (0, 0.0, True)}
    empty = share_check(df.where("false"), "s", exp).collect()
    assert all(r.ok is False and r.share is None for r in empty)


def test_cluster_settings_sizing():
    from dimstar.session import cluster_settings
    s = cluster_settings(100 * 1024 ** 4)  # 100 TB
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert s["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(s["spark.sql.adaptive.autoBroadcastJoinThreshold"]) == 64 * 1024 ** 2
    assert int(cluster_settings(10 * 1024 ** 2)["spark.sql.shuffle.partitions"]) == 200  # floor for small inputs


def _csv_folder(tmp_path, texts):
    for entity, text in texts.items():
        (tmp_path / f"{entity}.csv").write_text(text, encoding="utf-8")
    return str(tmp_path)


CUSTOMER = ("status,id,last_name,first_name,fiscal_code_hash,birth_date,email,phone,city,province,zip_code,"
            "registration_datetime,has_marketing_consent\n")
REQUEST = "id,customer_id,supplier_id,operator_id,request_datetime,completed_datetime,status,price,service_duration_minutes,notes\n"


def test_load_csv_quarantines_what_it_cannot_read(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F

    from dimstar.plans import load as L

    folder = _csv_folder(tmp_path, {
        "customers": CUSTOMER + f"active,1,Rossi,Ada,{'a' * 64},1990-01-01,,,Roma,RM,00100,2025-01-01 10:00:00,1\n",
        "suppliers": "name,id,category,vat_number,city,province,zip_code,email,phone,is_active\n"
                     "X,1,medical_center,1,Roma,RM,00100,,,1\n",
        "operators": "id,last_name,first_name,email,hire_date,activity_type,city,province,status\n"
                     "1,B,C,,2020-01-01,call_center,Roma,RM,active\n",
        "requests": REQUEST + "1,1,1,1,2025-02-01 10:00:00,,booked,40.005,,\n" + "2,1,1,1,2025-02-02 10:00:00,,booked,40,,,EXTRA\n"
                    + "3,1,1,1,2025-02-02 10:00:00,garbage,booked,40,,\n" + "4,1,1\n",
    })
    from dimstar.operators.validation import RejectRatioExceeded
    with pytest.raises(RejectRatioExceeded):
        L.load_csv(spark, folder, str(tmp_path / "w0"))
    assert L.complete_versions(spark, str(tmp_path / "w0")) == []
    cfg = L.driver.default_rules()
    cfg = type(cfg)(**{**cfg.__dict__, "operator_activity_types": ("call_center",), "supplier_categories": ("medical_center",)})
    report = L.load_csv(spark, folder, str(tmp_path / "w"), cfg, gate_limit=None)
    rows = {r.table: (r.n_read, r.n_rejected, r.n_inserted) for r in report.collect()}
    assert rows["requests"] == (4, 3, 1) and rows["customers"] == (1, 0, 1)
    base, checked = L.current_version(spark, str(tmp_path / "w"))
    assert checked
    q = spark.read.parquet(f"{base}/quarantine").where(F.col("table") == "requests").collect()
    assert sorted((r.key, r.reason) for r in q) == [("2", "malformed_value"), ("3", "malformed_value"), ("4", "malformed_value")]


def test_read_entity_by_header_name_and_failing_lines(spark, tmp_path):
    import pytest

    from dimstar.sources import csv as CSV

    _csv_folder(tmp_path, {
        "a": "name,id,extra,category,vat_number,city,province,zip_code,email,phone,is_active\nX,1,?,c,2,R,RM,3,,,1\n",
        "b": "id,name\n1,X\n",
        "c": "id,name,category,vat_number,city,province,zip_code,email,phone,is_active\n1,X,c,2,R,RM,3,,,yes\n"})
    row = CSV.read_entity(spark, str(tmp_path / "a.csv"), "suppliers").first()
    assert (row.id, row.name, row.is_active) == (1, "X", 1)
    with pytest.raises(ValueError, match="category"):
        CSV.read_entity(spark, str(tmp_path / "b.csv"), "suppliers")
    with pytest.raises(Exception, match="malformed record in suppliers: id 1, is_active"):
        CSV.read_entity(spark, str(tmp_path / "c.csv"), "suppliers").collect()


def test_versions_are_complete_or_unseen(spark, tmp_path):
    import pytest

    from conftest import SF_SMALL
    from dimstar.plans import load as L

    loaded = L.load_driver(spark, SF_SMALL)
    path = str(tmp_path / "w")
    with pytest.raises(FileNotFoundError):
        L.current_version(spark, path)
    for _ in range(3):
        L.write_warehouse(loaded, path)
    spark.range(1).write.parquet(f"{path}/v=99990101T000000-x/request_fact")  # a rebuild that was lost half-way
    versions = L.complete_versions(spark, path)
    assert len(versions) == 3 and L.current_version(spark, path)[0] == versions[-1]
    assert L.prune_versions(spark, path, keep=1) == versions[-1:]
    broken = L.Loaded(**{**loaded.__dict__, "supplier_dim": loaded.supplier_dim.withColumnRenamed("name", "n")})
    with pytest.raises(L.ContractViolation, match="supplier_dim"):
        L.write_warehouse(broken, path)
    star = L.read_warehouse(spark, path)
    from dimstar.model import KpiParams
    from dimstar.plans.sql_api import MEASURES, run_sql
    plan = run_sql(spark, star, "request_count", KpiParams.of("1996-01-01", "1996-02-29"))._jdf.queryExecution().toString()
    assert "date_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "customer_key" not in plan.split("== Physical Plan ==")[1]  # verified keys: no join that changes nothing
    for m in MEASURES:
        run_sql(spark, star, m, KpiParams.of("1996-01-01", "1996-02-29", province="NATION_3", category="ASIA")).collect()
