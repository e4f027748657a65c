"""Message and record schemas.

JSON messages are read with text leaves (numbers may arrive quoted) and cast after
parsing, so each message has a wire schema and a table of target types.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of a pump message's ``data`` object and their types.
PUMP_DATA = {
    "factoryNum": "string",
    "equType": "string",
    "equNum": "string",
    "workSta": "string",
    "deptName": "string",
    "roomNo": "string",
    "bedNo": "string",
    "state": "string",
    "drugName": "string",
    "injectMode": "string",
    "presetValue": "float",
    "speed": "float",
    "alreadyInjectTime": "int",
    "remainTime": "int",
    "alreadyInjectValue": "float",
    "residual": "float",
    "alarm1": "string",
    "alarm2": "string",
    "alarm3": "string",
    "alarm4": "string",
    "pressureValue": "float",
    "pressureUint": "string",
}

# The fields around ``data``.
PUMP_ENVELOPE = {"host": "string", "port": "int", "code": "int", "ts": "bigint"}

# Column order of the flattened pump record (routing key, tags, values).
PUMP_TAGS = ["host", "port", "factoryNum", "equType", "equNum"]
PUMP_VALUES = [
    "ts",
    "presetValue",
    "speed",
    "alreadyInjectTime",
    "remainTime",
    "alreadyInjectValue",
    "residual",
    "pressureValue",
    "pressureUint",
    "workSta",
    "drugName",
    "injectMode",
]

ALARMS = ["alarm1", "alarm2", "alarm3", "alarm4"]

# Flat message types.
USER = {"name": "string", "age": "int", "gender": "int", "address": "string"}
BEHAVIOR = {
    "user_id": "string",
    "item_id": "bigint",
    "category_id": "bigint",
    "behavior": "string",
    "ts": "bigint",
}
ORDER_EVENT = {
    "userId": "bigint",
    "orderId": "bigint",
    "siteId": "bigint",
    "cityId": "bigint",
    "orderStatus": "int",
    "price": "double",
    "quantity": "int",
    "timestamp": "bigint",
}
WEATHER = {"temperature": "bigint", "humidity": "bigint", "area": "string", "altitude": "bigint"}

CELLS = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("cell_ts", T.LongType()),
    ]
)


def text_leaves(fields: dict[str, str]) -> T.StructType:
    """Wire schema of a flat message: every leaf read as text."""
    return T.StructType([T.StructField(name, T.StringType()) for name in fields])


def pump_wire(data: list[str] | None = None) -> T.StructType:
    """Wire schema of a pump message, with all or some inner fields; the empty header is left out."""
    inner = text_leaves({k: PUMP_DATA[k] for k in data} if data else PUMP_DATA)
    return T.StructType([*text_leaves(PUMP_ENVELOPE).fields, T.StructField("data", inner)])
