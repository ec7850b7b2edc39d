"""Record, batch and position types, and the declared table columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())

RECORD = T.StructType(
    [
        T.StructField("message", T.StringType()),
        T.StructField("parsed", STRING_MAP),
        T.StructField("seqno", T.LongType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("syslog_identifier", T.StringType()),
        T.StructField("systemd_unit", T.StringType()),
        T.StructField("realtime_ts", T.LongType()),
        T.StructField("fields", STRING_MAP),
    ]
)

BATCH = T.StructType(
    [
        T.StructField("client_id", T.StringType()),
        T.StructField("reset", T.BooleanType()),
        T.StructField("current_position", T.StringType()),
        T.StructField("next_position", T.StringType()),
        T.StructField("arrival", T.LongType()),
        T.StructField("records", T.ArrayType(RECORD)),
    ]
)

VERDICT = T.StructType(
    [
        T.StructField("client_id", T.StringType()),
        T.StructField("arrival", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("code", T.IntegerType()),
        T.StructField("next_position", T.StringType()),
        T.StructField("expected_position", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

POSITION = T.StructType(
    [
        T.StructField("client_id", T.StringType(), False),
        T.StructField("exp_pos", T.StringType()),
        T.StructField("ts_wall", T.TimestampType()),
        T.StructField("seqno", T.LongType()),
        T.StructField("ts_orig", T.TimestampType()),
    ]
)

UINT64 = T.DecimalType(20, 0)

# Column type name -> Spark type that carries it.
COLUMN_TYPES: dict[str, T.DataType] = {
    "utf8": T.StringType(),
    "bytes": T.BinaryType(),
    "bool": T.BooleanType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": UINT64,
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "timestamp64": T.TimestampType(),
    "json": T.StringType(),
    "jsondocument": T.StringType(),
    "yson": T.BinaryType(),
}

# Integer ranges by column type name.
INTEGER_RANGES: dict[str, tuple[int, int]] = {
    "int8": (-(2**7), 2**7 - 1),
    "int16": (-(2**15), 2**15 - 1),
    "int32": (-(2**31), 2**31 - 1),
    "int64": (-(2**63), 2**63 - 1),
    "uint8": (0, 2**8 - 1),
    "uint16": (0, 2**16 - 1),
    "uint32": (0, 2**32 - 1),
    "uint64": (0, 2**64 - 1),
}


@dataclass(frozen=True)
class TableColumn:
    name: str
    type: str
    nullable: bool = True

    def __post_init__(self):
        if self.type not in COLUMN_TYPES:
            raise ValueError(f"unsupported column type {self.type!r}")

    @property
    def spark_type(self) -> T.DataType:
        return COLUMN_TYPES[self.type]


def struct_of(columns: list[TableColumn]) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.spark_type, c.nullable) for c in columns])


LOG_TABLE = [
    TableColumn("ts_orig", "timestamp64"),
    TableColumn("dbname", "utf8"),
    TableColumn("service", "utf8"),
    TableColumn("level", "utf8"),
    TableColumn("msg", "utf8"),
    TableColumn("unit", "utf8"),
    TableColumn("seqno", "int64", nullable=False),
    TableColumn("ts_log", "timestamp64", nullable=False),
    TableColumn("message_hash", "uint64", nullable=False),
    TableColumn("hostname", "utf8", nullable=False),
]

LOG_TABLE_KEY = ["ts_log", "seqno", "hostname", "message_hash"]
