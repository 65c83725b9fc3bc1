"""Fixed values of the data model.

Everything in the block below must equal the values the source system uses,
otherwise validation and the calendar give different answers. They are kept
together, in their natural order, as plain text.
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values ---------------------------------------------------------
CUSTOMER_STATUSES = ("active", "historicized")
SUPPLIER_CATEGORIES = ("driving_school", "motorization", "renewal_agency", "medical_center")
OPERATOR_ACTIVITY_TYPES = ("front_office", "back_office", "instructor", "examiner", "administrative")
OPERATOR_STATUSES = ("active", "terminated")
REQUEST_STATUSES = ("booked", "confirmed", "completed", "invoiced", "cancelled")

REQUEST_CUTOFF = _dt.datetime(2026, 5, 22, 23, 59, 59)
CALENDAR_START = _dt.date(2025, 1, 1)
CALENDAR_END = _dt.date(2026, 12, 31)
REJECT_RATIO_LIMIT = 0.05
WEEKLY_THRESHOLD_DAYS = 90

MONTH_NAMES_IT = (
    "gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno",
    "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre",
)
DAY_NAMES_IT = ("lunedì", "martedì", "mercoledì", "giovedì", "venerdì", "sabato", "domenica")

FIXED_HOLIDAYS_IT = {
    "01-01": "Capodanno",
    "04-25": "Festa della Liberazione",
    "05-01": "Festa del Lavoro",
    "06-02": "Festa della Repubblica",
    "08-15": "Ferragosto",
    "11-01": "Ognissanti",
    "12-08": "Immacolata Concezione",
    "12-25": "Natale",
    "12-26": "Santo Stefano",
}
EASTER_DATES_IT = {
    "2025-04-20": "Pasqua",
    "2026-04-05": "Pasqua",
}

# State machine of a request: (state, event) -> next state.
TRANSITIONS = (
    ("initial", "create", "booked"),
    ("booked", "confirm", "confirmed"),
    ("confirmed", "complete", "completed"),
    ("completed", "invoice", "invoiced"),
    ("booked", "cancel", "cancelled"),
    ("confirmed", "cancel", "cancelled"),
)
INITIAL_STATE = "initial"
TERMINAL_STATES = ("invoiced", "cancelled")
DEFAULT_CANCEL_FROM = "booked"

# Reason texts written to the quarantine table (ours, in English).
R_DUPLICATE_ID = "duplicate_id"
R_HASH_FORMAT = "invalid_fiscal_code_hash"
R_CUSTOMER_STATUS = "status_not_allowed"
R_CONSENT = "consent_not_0_1"
R_BIRTH_AFTER_REG = "birth_date_after_registration"
R_ACTIVE_COUNT = "active_rows_per_persona_not_1"
R_CATEGORY = "category_not_allowed"
R_IS_ACTIVE = "is_active_not_0_1"
R_ACTIVITY = "activity_type_not_allowed"
R_OPERATOR_STATUS = "status_not_allowed"
R_HIRE_DATE = "hire_date_missing"
R_FK_CUSTOMER = "customer_id_not_found"
R_FK_SUPPLIER = "supplier_id_not_found"
R_FK_OPERATOR = "operator_id_not_found"
R_REQUEST_STATUS = "status_not_allowed"
R_PRICE = "price_not_positive"
R_DONE_MISSING = "completed_without_datetime_or_duration"
R_PENDING_FILLED = "pending_with_datetime_or_duration"
R_CANCEL_INCOHERENT = "cancelled_incoherent_or_without_notes"
R_COMPLETED_BEFORE = "completed_before_request"
R_AFTER_CUTOFF = "request_after_cutoff"
R_BEFORE_REGISTRATION = "request_not_after_first_registration"
R_MISSING_KEY = "missing_key"
R_MISSING_TIMESTAMP = "missing_timestamp"
