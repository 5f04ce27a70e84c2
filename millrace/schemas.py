"""Fixed schemas. No job infers one."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


DAG_LOG = T.StructType(
    [
        T.StructField("dag_id", T.StringType()),
        T.StructField("completion_date", T.DateType()),
        T.StructField("completion_datetime", T.TimestampNTZType()),
    ]
)

DEPENDENCY_MANAGER = T.StructType(_text("asis_dag", "tobe_dag"))

PARTITION_MANAGER = T.StructType(
    [
        *_text("schema_nm", "table_nm"),
        T.StructField("store_d_num", T.IntegerType()),
        T.StructField("partition_tf", T.BooleanType()),
    ]
)

ADDRESS_MASTER = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("legacy_address", T.StringType()),
        T.StructField("accuracy", T.IntegerType()),
        T.StructField("road_address_tf", T.BooleanType()),
        *_text(
            "address_name",
            "region_1depth_name",
            "region_2depth_name",
            "region_3depth_name",
            "region_3depth_h_name",
            "building_name",
            "building_dong",
            "building_ho",
            "zone_no",
            "x",
            "y",
        ),
        T.StructField("register_dt", T.TimestampNTZType()),
    ]
)

ADDRESS_DICTIONARY = T.StructType(
    [
        T.StructField("keyword", T.StringType()),
        T.StructField("total_count", T.IntegerType()),
        T.StructField(
            "road_address",
            T.StructType(
                _text(
                    "address_name",
                    "building_name",
                    "region_1depth_name",
                    "region_2depth_name",
                    "region_3depth_name",
                    "x",
                    "y",
                    "zone_no",
                )
            ),
        ),
        T.StructField(
            "address",
            T.StructType(
                _text(
                    "address_name",
                    "region_1depth_name",
                    "region_2depth_name",
                    "region_3depth_name",
                    "region_3depth_h_name",
                    "x",
                    "y",
                )
            ),
        ),
    ]
)

PAYLOADS = T.StructType(
    [*_text("feed", "category"), T.StructField("page_no", T.IntegerType()), *_text("payload")]
)

PUBLIC_INSTITUTION = T.StructType(
    [*_text("kind", "name", "addr", "tel", "lat", "lon"), T.StructField("addr_seq", T.LongType())]
)
