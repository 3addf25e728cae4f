"""Fixed values.

These have to equal the values of the source system and of the published
tables for results to agree, so they are stated here once, as plain text.
"""

# Text formats of the landed records.
DATE_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
INSTANT_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSX"
LOCAL_TIME_PATTERN = r"^(\d\d)/(\d\d)/(\d{4})\s+(\d\d):(\d\d)(?=[\u0085\u2028\u2029]?\z)"
ISO_MILLIS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"

# Source system columns and their names in the base table.
SYSTEM_COLUMNS = {
    ":id": "source_row_id",
    ":version": "source_version",
    ":created_at": "source_created_at",
    ":updated_at": "source_updated_at",
}

# Merge identity and ordering.
BUSINESS_KEY = "incident_report_number"
UPDATED_AT = "source_updated_at"
VERSION = "source_version"
ROW_ID = "source_row_id"

# Codes in the flag columns.
FLAG_TRUE = "Y"
FLAG_FALSE = "N"
CLEARED_CODES = ("C", "O")
NOT_CLEARED_CODE = "N"
MISSING_LABEL = "MISSING"

# Load modes and run, batch and extraction states.
NO_CHANGES = "NO_CHANGES"
FULL_SNAPSHOT = "FULL_SNAPSHOT"
REVIEW_REQUIRED = "REVIEW_REQUIRED"
INCREMENTAL = "INCREMENTAL"
RUNNING = "RUNNING"
SUCCESS = "SUCCESS"
FAILED = "FAILED"
BLOCKED = "BLOCKED"
PARTIAL = "PARTIAL"
COUNT_MISMATCH = "COUNT_MISMATCH"
BULK_CHANGE_REVIEW = "BULK_CHANGE_REVIEW"
DATA_QUALITY_FAILURE = "DATA_QUALITY_FAILURE"
UNKNOWN_ERROR = "UNKNOWN_ERROR"

# Sizes and thresholds.
PAGE_SIZE = 10_000
BULK_REVIEW_THRESHOLD = 0.80
PROFILE_ROWS = 10
PREVIEW_ROWS = 20
SHARE_ROWS = 100
CHART_ROWS = 10_000
TOP_TYPES = 10
