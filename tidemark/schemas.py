"""Table schemas. Partition columns come last, in directory order."""

from pyspark.sql import types as T

TENANT_YEAR = ["tenant_code", "api_year"]
GRAIN = ["tenant_code", "api_year", "name"]



def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _INT, _LONG, _FLAG, _DATE, _TIME = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType(), T.TimestampType()
_VARIANT, _DOUBLE, _MAP = T.VariantType(), T.DoubleType(), T.MapType(T.StringType(), T.StringType())

# The columns of the tables, in their order.
RAW_PARTITIONS = ["kind", "tenant_code", "api_year", "name"]
RAW = _struct(
    pull_date=_DATE, pull_timestamp=_TIME, file_row_number=_LONG, filename=_TEXT, ods_version=_TEXT,
    data_model_version=_TEXT, v=_VARIANT, kind=_TEXT, tenant_code=_TEXT, api_year=_INT, name=_TEXT,
)

LEDGER_PARTITIONS = TENANT_YEAR
LEDGER = _struct(
    name=_TEXT, pull_date=_DATE, pull_timestamp=_TIME, max_version=_LONG, is_active=_FLAG, is_deletes=_FLAG,
    is_key_changes=_FLAG, tenant_code=_TEXT, api_year=_INT,
)

TOTAL_COUNTS_PARTITIONS = TENANT_YEAR
TOTAL_COUNTS = _struct(
    name=_TEXT, pull_date=_DATE, pull_timestamp=_TIME, total_count=_LONG, tenant_code=_TEXT, api_year=_INT,
)

MATCH_RATE_PARTITIONS = ["tenant_code", "api_year", "assessment_name"]
MATCH_RATE_FILE = _struct(
    source_column_name=_TEXT, edfi_column_name=_TEXT, num_matches=_LONG, num_rows=_LONG, match_rate=_DOUBLE,
)
MATCH_RATES = T.StructType(
    MATCH_RATE_FILE.fields + _struct(tenant_code=_TEXT, api_year=_INT, assessment_name=_TEXT).fields
)

RUN_LOG_PARTITIONS = TENANT_YEAR
RUN_LOG = _struct(
    grain_update=_TEXT, run_type=_TEXT, run_date=_DATE, run_timestamp=_TIME, result=_VARIANT, tenant_code=_TEXT,
    api_year=_INT,
)

LOG_RECORD = _struct(
    timestamp=_TEXT, name=_TEXT, level=_TEXT, message=_TEXT, pathname=_TEXT, lineno=_INT, args=_MAP,
    kwargs=_MAP,
)

ENDPOINTS = _struct(
    tenant_code=_TEXT, api_year=_INT, kind=_TEXT, name=_TEXT, namespace=_TEXT, enabled=_FLAG,
    fetch_deletes=_FLAG, page_size=_INT, num_retries=_INT, change_version_step_size=_INT, query_parameters=_MAP,
)
