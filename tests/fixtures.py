"""Hand-written edge fixtures (FIXTURES.md section 5)."""

from __future__ import annotations

import datetime as dt
import hashlib

from dimstar.sources.csv import CUSTOMERS_SCHEMA, OPERATORS_SCHEMA, REQUESTS_SCHEMA, SUPPLIERS_SCHEMA

H = {c: hashlib.sha256(c.encode()).hexdigest() for c in "ABCDEFGHI"}  # 64 hex chars, distinct
D = dt.date
T = dt.datetime


def _cust(id_, hash_, birth, reg, consent, status):
    return (id_, "Rossi", "Anna", hash_, birth, "a@x.it", None, "Roma", "RM", "00185", reg, consent, status)


CUSTOMERS = [
    (_cust(1, H["A"], D(1990, 1, 1), T(2025, 1, 10, 9), 1, "historicized"), None),
    (_cust(2, H["A"], D(1990, 1, 1), T(2025, 3, 1, 10), 1, "active"), None),
    (_cust(3, H["B"], D(1990, 1, 1), T(2025, 1, 5, 8), 0, "active"), "duplicate_id"),
    (_cust(3, H["C"], D(1990, 1, 1), T(2025, 1, 6, 8), 0, "active"), "duplicate_id"),
    (_cust(4, "xyz", D(1990, 1, 1), T(2025, 1, 7, 8), 0, "active"), "invalid_fiscal_code_hash"),
    (_cust(5, H["D"], D(1990, 1, 1), T(2025, 1, 7, 8), 0, "ACTIVE"), "status_not_allowed"),
    (_cust(6, H["E"], D(1990, 1, 1), T(2025, 1, 7, 8), None, "active"), "consent_not_0_1"),
    (_cust(7, H["F"], D(2026, 1, 1), T(2025, 2, 1, 8), 1, "active"), "birth_date_after_registration"),
    (_cust(8, H["G"], D(1990, 1, 1), T(2025, 1, 7, 8), 1, "historicized"), "active_rows_per_persona_not_1"),
    (_cust(9, H["H"], D(1990, 1, 1), T(2025, 1, 7, 8), 1, "active"), "active_rows_per_persona_not_1"),
    (_cust(10, H["H"], D(1990, 1, 1), T(2025, 1, 8, 8), 1, "active"), "active_rows_per_persona_not_1"),
    (_cust(11, H["I"], None, T(2025, 2, 1, 8), 1, "active"), None),
]

SUPPLIERS = [
    ((1, "Scuola", "driving_school", "01234567890", "Roma", "RM", "00100", None, None, 1), None),
    ((2, "Garage", "garage", "01234567891", "Roma", "RM", "00100", None, None, 1), "category_not_allowed"),
    ((3, "Centro", "medical_center", "01234567892", "Roma", "NA", "80100", None, None, None), "is_active_not_0_1"),
]

OPERATORS = [
    ((1, "Bianchi", "Luca", None, D(2024, 1, 1), "instructor", "Roma", "RM", "active"), None),
    ((2, "Verdi", "Sara", None, None, "examiner", "Roma", "RM", "terminated"), "hire_date_missing"),
    ((3, "Neri", "Ugo", None, D(2024, 1, 1), "pilot", "Roma", "RM", "active"), "activity_type_not_allowed"),
]


def _req(id_, customer=2, supplier=1, operator=1, at=T(2025, 2, 15, 10), completed=None, status="booked",
         price=40.0, duration=None, notes=None):
    return (id_, customer, supplier, operator, at, completed, status, price, duration, notes)


REQUESTS = [
    (_req(1, status="invoiced", completed=T(2025, 2, 15, 12), duration=45), None),
    (_req(2, at=T(2025, 3, 1, 10)), None),
    (_req(3, at=T(2025, 1, 10, 9)), "request_not_after_first_registration"),
    (_req(4, customer=3), "customer_id_not_found"),
    (_req(5, supplier=2), "supplier_id_not_found"),
    (_req(6, price=0.0), "price_not_positive"),
    (_req(7, price=None), "price_not_positive"),
    (_req(8, status="completed"), "completed_without_datetime_or_duration"),
    (_req(9, duration=30), "pending_with_datetime_or_duration"),
    (_req(10, status="cancelled"), "cancelled_incoherent_or_without_notes"),
    (_req(11, status="invoiced", duration=45, completed=T(2025, 2, 15, 9)), "completed_before_request"),
    (_req(12, at=T(2026, 5, 23, 0, 0, 0)), "request_after_cutoff"),
    (_req(13, at=T(2026, 5, 22, 23, 59, 59)), None),
    (_req(14, status="cancelled", notes="x"), None),
    (_req(15, supplier=2, price=0.0), "supplier_id_not_found"),
    (_req(16, operator=2), "operator_id_not_found"),
    (_req(17, status="open"), "status_not_allowed"),
    (_req(18), "duplicate_id"),
    (_req(18), "duplicate_id"),
    (_req(19, price=float("nan")), "price_not_positive"),
    (_req(20, status="invoiced", duration=45, completed=T(2025, 2, 15, 10)), None),
    (_req(None), "missing_key"),
    (_req(21, at=None), "missing_timestamp"),
]


def frame(spark, rows, schema):
    return spark.createDataFrame([r for r, _ in rows], schema)


def customers(spark):
    return frame(spark, CUSTOMERS, CUSTOMERS_SCHEMA)


def suppliers(spark):
    return frame(spark, SUPPLIERS, SUPPLIERS_SCHEMA)


def operators(spark):
    return frame(spark, OPERATORS, OPERATORS_SCHEMA)


def requests(spark):
    return frame(spark, REQUESTS, REQUESTS_SCHEMA)
