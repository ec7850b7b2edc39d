"""Log-shaped views over the given tables, stated once for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.filters import nonempty_message
from ledgerline.operators.sequence import ack_positions, assign_seqno
from ledgerline.operators.stats import position_update

# Fixed value: the log line pattern.
MESSAGE_PATTERN = (
    r"^(?:(?P<P_DTTM>[^ ]+)\s+)?:(?P<P_SERVICE>[^ ]+)\s+(?P<P_LEVEL>[^ ]+):\s+(?P<P_MESSAGE>.*)$"
)
# Units of the view below: one instance per database.
UNIT_PATTERN = r"^[^@]+@(?P<P_DBNAME>[^.@]+)\.service$"
START_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T"

_SPARK = {
    "ts_us": "unix_micros(CAST(ts AS TIMESTAMP))",
    "iso_ts": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")",
}
_DUCKDB = {"ts_us": "epoch_us(ts)", "iso_ts": "strftime(ts, '%Y-%m-%dT%H:%M:%S')"}

RECORDS = """
SELECT concat('host-', CAST(user_id % 4 AS STRING)) AS client_id,
       event_id AS seqno,
       concat('c', lpad(CAST(event_id AS STRING), 10, '0')) AS cursor,
       @ts_us AS realtime_ts,
       CASE event_type WHEN 'error' THEN 3 WHEN 'purchase' THEN 5 ELSE 6 END AS priority,
       CASE WHEN user_id % 10 = 0 THEN '' ELSE event_type END AS syslog_identifier,
       concat(event_type, '@db', CAST(user_id % 3 AS STRING), '.service') AS systemd_unit,
       CASE WHEN event_id % 97 = 0 THEN ''
            WHEN event_id % 4 = 3 THEN concat('frame ', CAST(event_id AS STRING), chr(9), 'user ', CAST(user_id AS STRING))
            ELSE concat(@iso_ts, ' :', upper(event_type),
                        CASE WHEN event_type = 'error' THEN ' ERROR' ELSE ' INFO' END, ': ', props) END AS message,
       props AS fields_json
FROM events
"""

# Texts a number or boolean transform may meet, good and bad.
VALUES = """
SELECT event_id,
       CASE event_id % 14
         WHEN 0 THEN CAST(event_id AS STRING)
         WHEN 1 THEN concat('-', CAST(event_id AS STRING))
         WHEN 2 THEN concat('+', CAST(event_id AS STRING))
         WHEN 3 THEN concat(' ', CAST(event_id AS STRING))
         WHEN 4 THEN concat(CAST(event_id AS STRING), '.5')
         WHEN 5 THEN '9223372036854775808'
         WHEN 6 THEN ''
         WHEN 7 THEN event_type
         WHEN 8 THEN '18446744073709551615'
         WHEN 9 THEN NULL
         WHEN 10 THEN concat('00', CAST(event_id AS STRING))
         WHEN 11 THEN concat(CAST(event_id % 100 AS STRING), 'e2')
         WHEN 12 THEN '18446744073709551616'
         ELSE concat(CAST(event_id AS STRING), 'd') END AS raw,
       CASE event_id % 16
         WHEN 0 THEN 'true' WHEN 1 THEN 'T' WHEN 2 THEN '1' WHEN 3 THEN 'True' WHEN 4 THEN 'TRUE'
         WHEN 5 THEN 't' WHEN 6 THEN 'false' WHEN 7 THEN 'F' WHEN 8 THEN '0' WHEN 9 THEN 'False'
         WHEN 10 THEN 'f' WHEN 11 THEN 'yes' WHEN 12 THEN 'tRuE' WHEN 13 THEN ' true'
         WHEN 14 THEN NULL ELSE event_type END AS flag,
       CASE event_id % 12
         WHEN 0 THEN concat(@iso_ts, 'Z')
         WHEN 1 THEN concat(@iso_ts, '.123456789Z')
         WHEN 2 THEN concat(@iso_ts, '+03:00')
         WHEN 3 THEN replace(concat(@iso_ts, '.5'), 'T', ' ')
         WHEN 4 THEN @iso_ts
         WHEN 5 THEN substring(@iso_ts, 1, 10)
         WHEN 6 THEN CAST(@ts_us AS STRING)
         WHEN 7 THEN concat(' ', CAST(@ts_us AS STRING), ' ')
         WHEN 8 THEN substring(@iso_ts, 1, 7)
         WHEN 9 THEN replace(concat(@iso_ts, 'Z'), 'T', ' ')
         WHEN 10 THEN NULL
         ELSE event_type END AS moment,
       value, ts
FROM events
"""

KEPT = """
SELECT *, coalesce(lag(cursor) OVER (PARTITION BY client_id ORDER BY seqno), 'p0') AS position,
       row_number() OVER (PARTITION BY client_id ORDER BY seqno) - 1 AS rn
FROM v_records WHERE message <> ''
"""

ENVELOPES = """
SELECT client_id, arrival, arrival % 9 = 0 AS reset,
       CASE WHEN arrival % 7 = 3 THEN 'bad' ELSE current_position END AS current_position,
       next_position, n_records, max_seqno, max_realtime_ts
FROM (SELECT client_id, CAST(floor(rn / 50) AS BIGINT) AS arrival, min(position) AS current_position,
             max(cursor) AS next_position, count(*) AS n_records,
             max(seqno) AS max_seqno, max(realtime_ts) AS max_realtime_ts
      FROM v_kept GROUP BY client_id, CAST(floor(rn / 50) AS BIGINT)) b
"""


def _fill(sql: str, words: dict[str, str]) -> str:
    for name, text in words.items():
        sql = sql.replace(f"@{name}", text)
    return sql


def duckdb_ctes(*names: str) -> str:
    """``WITH`` clause for the oracle side of the views."""
    wanted = {"values": ["v_values"], "records": ["v_records"], "kept": ["v_records", "v_kept"],
              "envelopes": ["v_records", "v_kept", "v_batches"]}
    text = {"v_values": VALUES, "v_records": RECORDS, "v_kept": KEPT, "v_batches": ENVELOPES}
    views = list(dict.fromkeys(v for n in names for v in wanted[n]))
    return "WITH " + ",\n".join(f"{v} AS ({_fill(text[v], _DUCKDB)})" for v in views)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    text = _fill(sql, _SPARK).replace("FROM events", "FROM {events}")
    return spark.sql(text, events=table(spark, sf_dir, "events"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw journal records: a quarter continuation lines, some empty ones."""
    return with_maps(_view(spark, sf_dir, RECORDS))


def with_maps(df: DataFrame) -> DataFrame:
    return df.withColumn("fields", F.from_json("fields_json", "map<string,string>"))


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, VALUES)


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a message, each with the position it was acknowledged at."""
    return ack_positions(nonempty_message(records(spark, sf_dir)), "p0")


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_seqno(kept(spark, sf_dir), 0, to="rn").withColumn("arrival", F.expr("rn div 50"))


def envelopes(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Envelopes of 50 records; every 7th has a wrong position, every 9th resets."""
    rows = numbered(spark, sf_dir) if rows is None else rows
    batches = rows.groupBy("client_id", "arrival").agg(
        F.min("position").alias("current_position"),
        F.max("cursor").alias("next_position"),
        F.count(F.lit(1)).alias("n_records"),
        F.max("seqno").alias("max_seqno"),
        F.max("realtime_ts").alias("max_realtime_ts"),
    )
    return batches.withColumns(
        {
            "reset": F.col("arrival") % 9 == 0,
            "current_position": F.when(F.col("arrival") % 7 == 3, "bad").otherwise(F.col("current_position")),
        }
    )


def updates(rows: DataFrame) -> DataFrame:
    return position_update(rows, ["client_id", "arrival"])
