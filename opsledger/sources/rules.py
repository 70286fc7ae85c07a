"""Routing rules: event type to an ordered list of channels, plus a default list."""

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.model import CHANNEL, RULES

try:
    import yaml
except ImportError:
    yaml = None

MAX_RULES_BYTES = 4 * 1024 * 1024

# The notification rules in use.
NOTIFICATION_RULES = {
    "handlers": {
        "order.created": [
            {"type": "email", "template": "order_confirmation", "retry": 3},
            {"type": "push", "template": "order_created_push", "retry": 1},
        ],
        "order.confirmed": [
            {"type": "email", "template": "order_confirmed", "retry": 3},
            {"type": "push", "template": "order_confirmed_push", "retry": 1},
        ],
        "order.cancelled": [
            {"type": "email", "template": "order_cancellation", "retry": 3},
        ],
        "order.shipped": [
            {"type": "email", "template": "order_shipped", "retry": 3},
            {"type": "sms", "template": "order_shipped_sms", "retry": 2},
        ],
    },
    "default": [{"type": "log", "level": "warning"}],
}

# Fixed value: the channels of an event without a rule, where the rules name no default.
_FALLBACK_DEFAULT = [{"type": "log", "level": "warning"}]


def load_rules(path: str) -> dict:
    """Parse a small YAML or JSON rules file on the driver."""
    if os.path.getsize(path) > MAX_RULES_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RULES_BYTES} bytes; load it as a table")
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            return json.load(f)
        if yaml is None:
            raise RuntimeError("PyYAML is not installed; give the rules as JSON")
        return yaml.safe_load(f)


def _channel(entry: dict) -> tuple:
    return tuple(entry.get(field.name) for field in CHANNEL)


def rules_table(spark: SparkSession, config: dict) -> DataFrame:
    """One row per event type. A type mapped to ``[]`` keeps its empty array.

    The config is at most ``MAX_RULES_BYTES`` of text, so the table may be broadcast.
    """
    if len(json.dumps(config)) > MAX_RULES_BYTES:
        raise ValueError(f"the rules exceed {MAX_RULES_BYTES} bytes; keep them in a table")
    handlers = config.get("handlers") or {}
    rows = [
        (event_type, [_channel(entry) for entry in channels])
        for event_type, channels in handlers.items()
        if channels is not None
    ]
    return spark.createDataFrame(rows, RULES)


def default_channels(config: dict) -> Column:
    """The default list as a literal column."""
    entries = config.get("default", _FALLBACK_DEFAULT)
    structs = [
        F.struct(
            *[
                F.lit(value).cast(field.dataType).alias(field.name)
                for field, value in zip(CHANNEL, _channel(entry))
            ]
        )
        for entry in entries
    ]
    return F.array(*structs).cast(RULES["channels"].dataType)
