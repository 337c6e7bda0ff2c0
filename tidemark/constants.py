"""Fixed values of the data contract. They must stay as they are for results to agree."""

# Defaults of an endpoint's configuration.
DEFAULT_NAMESPACE = "ed-fi"
DEFAULT_PAGE_SIZE = 500
DEFAULT_CHANGE_VERSION_STEP = 50000
DEFAULT_NUM_RETRIES = 5

# Version text recorded for a source that has no change versions.
NO_CHANGE_VERSIONS = "ED-FI2"

# Names of the shared tables.
DELETES_TABLE = "_deletes"
KEY_CHANGES_TABLE = "_key_changes"
DESCRIPTORS_TABLE = "_descriptors"
CHANGE_VERSION_TABLE = "_meta_change_versions"
TOTAL_COUNTS_TABLE = "_meta_total_counts"

# The record streams of an endpoint.
RESOURCES = "resources"
DESCRIPTORS = "descriptors"
RESOURCE_DELETES = "resource_deletes"
RESOURCE_KEY_CHANGES = "resource_key_changes"
KINDS = (RESOURCES, DESCRIPTORS, RESOURCE_DELETES, RESOURCE_KEY_CHANGES)

# Query parameter that selects one year of a multi-year source.
SCHOOL_YEAR_PARAMETER = "schoolYear"

# Formats of the dates in a landing path.
PATH_DATE_FORMAT = "yyyyMMdd"
PATH_TIMESTAMP_FORMAT = "yyyyMMdd'T'HHmmss"

# Organisation checks.
LEA_TYPE = "edfi.LocalEducationAgency"
CONNECTION_PREFIX = "edfi"
ORG_STATUSES = ("MATCH", "MISMATCH", "NO_MAPPING", "NO_ORG_ID", "ERROR")
FAIL_ON = ("MISMATCH", "NO_MAPPING", "NO_ORG_ID", "ERROR")

# Identifier matching.
REQUIRED_MATCH_RATE = 0.5

# Error selection in a run's log.
ERROR_LEVEL = "ERROR"
