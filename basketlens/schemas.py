"""Table schemas and the DDL that creates them as partitioned Parquet tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

_YMD = ("PARTITIONYEAR", "PARTITIONMONTH", "PARTITIONDAY")
_YMD_DDL = "PARTITIONYEAR INT, PARTITIONMONTH INT, PARTITIONDAY INT"

# Column names, types and partitioning of the stored tables.
_DDL = {
    "tempdb.batch_ledger": (
        "batchID INT, date STRING, startTime STRING, item STRING, status STRING",
        ("item",),
    ),
    "tempdb.source_audit": (
        "batchID STRING, date STRING, startTime STRING, notebook STRING, "
        "count STRING, file STRING, exist STRING",
        (),
    ),
    "history.behaviour_log": (
        "EVENT_TIME TIMESTAMP, EVENT_TYPE STRING, PRODUCT_ID STRING, CATEGORY_ID STRING, "
        "CATEGORY_CODE STRING, BRAND STRING, PRICE STRING, USER_ID STRING, "
        f"USER_SESSION STRING, BATCHNUMBER INT, {_YMD_DDL}",
        (*_YMD, "BATCHNUMBER"),
    ),
    "history.sales_target": (
        f"COUNTRY STRING, YEARMONTH INT, TARGET DOUBLE, BATCHNUMBER INT, {_YMD_DDL}",
        (*_YMD, "BATCHNUMBER"),
    ),
    "curated.dim_date": (
        "Date_Key TIMESTAMP, Year INT, HalfYear INT, Quarter INT, Month INT, MonthName STRING, "
        "YearMonth INT, Week INT, Day INT, Weekday INT, Date TIMESTAMP",
        (),
    ),
    "curated.dim_product": (
        "PRODUCT_ID_KEY BIGINT, PRODUCT_ID STRING, CATEGORY_ID STRING, CATEGORY STRING, "
        "SUBCATEGORY1 STRING, SUBCATEGORY2 STRING, SUBCATEGORY3 STRING, BRAND STRING, "
        "ETLUPDATEDDATETIME TIMESTAMP",
        (),
    ),
    "curated.fact_behaviour_log": (
        "BEHAVIOUR_KEY BIGINT, PRODUCT_ID_FK BIGINT, EVENT_DATETIME TIMESTAMP, "
        "EVENT_DATE STRING, EVENT_TIME STRING, EVENT_WEEKDAY INT, EVENT_TYPE STRING, "
        "PRODUCT_ID STRING, PRICE DOUBLE, USER_ID STRING, USER_SESSION STRING, "
        f"ACTION_ITEMS INT, SALES_BRANCH STRING, {_YMD_DDL}, ETLUPDATEDDATETIME TIMESTAMP",
        _YMD,
    ),
    "curated.fact_target": (
        "TARGET_KEY BIGINT, COUNTRY STRING, DATE DATE, YEARMONTH INT, YEAR INT, MONTH INT, "
        f"DAY INT, DAILYTARGET DOUBLE, TARGET DOUBLE, {_YMD_DDL}, ETLUPDATEDDATETIME TIMESTAMP",
        _YMD,
    ),
    "curated.fact_usersession_cal": (
        "DATE_KEY TIMESTAMP, USER_SESSION STRING, MAX_EVENT_DATETIME TIMESTAMP, "
        f"MIN_EVENT_DATETIME TIMESTAMP, USER_SESSION_DURATION DOUBLE, {_YMD_DDL}, "
        "ETLUPDATEDDATETIME TIMESTAMP",
        _YMD,
    ),
    "curated.da_rfm_analysis": (
        "USER_ID_KEY BIGINT, USER_ID STRING, RECENCY INT, FREQUENCY BIGINT, "
        "MONETARY DECIMAL(30,2), R_QUARTILE INT, F_QUARTILE INT, M_QUARTILE INT, "
        f"RFM_SEGMENTATION STRING, RFM_SCORE INT, RFM_LABEL STRING, {_YMD_DDL}, "
        "ETLUPDATEDDATETIME TIMESTAMP",
        _YMD,
    ),
    "curated.ml_sales_prediction": (
        "WEEK_NUMBER_CYCLE BIGINT, WEEK_NUMBER BIGINT, PRODUCT_ID STRING, MEAN_PRICE DOUBLE, "
        "ACTUAL_SALES BIGINT, SALES_PREDICTION_XG BIGINT, SALES_PREDICTION_GB BIGINT, "
        "SALES_PREDICTION_RF BIGINT, ELASTICITY DOUBLE, LR_R2_SCORE DOUBLE, "
        "COEFFICIENT_PVALUE DOUBLE",
        ("WEEK_NUMBER_CYCLE", "WEEK_NUMBER"),
    ),
}

# A behaviour log as it lands: all text.
LANDED_BEHAVIOUR_DDL = (
    "event_time STRING, event_type STRING, product_id STRING, category_id STRING, "
    "category_code STRING, brand STRING, price STRING, user_id STRING, user_session STRING"
)

PARTITIONING: dict[str, tuple[str, ...]] = {name: parts for name, (_, parts) in _DDL.items()}
DATABASES = ("tempdb", "landing", "history", "curated")

# One row per record that failed a data-quality check.
DQ_DDL = (
    "dataDate STRING, errorType STRING, checkTable STRING, checkField STRING, "
    "checkFieldValue STRING, primaryKey STRING, primaryKeyValue STRING, "
    "errorMessage STRING, runDate TIMESTAMP"
)
DQ_COLUMNS = [column.split()[0] for column in DQ_DDL.split(", ")]


def schema(name: str) -> StructType:
    """The schema of a stored table (needs a running session)."""
    return StructType.fromDDL(_DDL[name][0])


def create_table_sql(name: str, location: str) -> str:
    ddl, parts = _DDL[name]
    by = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{by} LOCATION '{location}'"


def create_tables(spark: SparkSession, root: str) -> None:
    """Create the four databases and the external tables below ``root``."""
    for database in DATABASES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in _DDL:
        spark.sql(create_table_sql(name, f"{root}/{name.replace('.', '/')}"))
