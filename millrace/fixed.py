"""Names, texts and patterns that outside tables and users depend on."""

# Control table names.
DATASET_TABLE = "CTL_DATASET_MASTER"
COLUMN_TABLE = "CTL_COLUMN_METADATA"
RULE_TABLE = "CTL_DQM_MASTER"
DEPENDENCY_TABLE = "CTL_DEPENDENCY_MASTER"

# Generated columns, and the view a CUSTOM rule reads.
ROW_ID = "ROW_ID"
LANDING_VIEW = "landingTable"

# Rule types and the text each writes to QC_DESC.
DESCRIPTIONS = {
    "NULL": "{column} must not be NULL",
    "LENGTH": "{column} must have a length {param}",
    "DOMAIN": "{column} must be one of: {param}",
    "CUSTOM": "{column} must satisfy custom check",
}

# What counts as blank once trimmed and upper-cased.
BLANK_TEXTS = ("NULL", "")

# Length operators, longest first.
LENGTH_OPERATORS = ("<=", ">=", "=", "<", ">")

# Severity test and flags, summary results, audit texts.
CRITICAL_PATTERN = "%CRITICAL%"
YES, NO = "Y", "N"
PASS, FAIL = "PASS", "FAIL"
SUCCESS, FAILED = "SUCCESS", "FAILED"
INGESTION, FACT, REPORTING = "INGESTION", "FACT", "REPORTING"
RAW_TYPE = "raw"

# Date tokens in file name patterns, longest first.
DATE_TOKENS = {"YYYYMMDDHHMMSS": r"\d{14}", "YYYYMMDD": r"\d{8}"}

# Formats of the cycle id and of the archive folders.
CYCLE_FORMAT = "%Y%m%d"
ARCHIVE_DAY = "%Y-%m-%d"
ARCHIVE_TIME = "%Y%m%dT%H%M%S"
