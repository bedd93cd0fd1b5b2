"""Writers: lake layers (batch), CSV exports, Kafka records."""

from tributary.sinks.kafka import kafka_records, write_kafka
from tributary.sinks.lake import (
    LayerWriter,
    export_csv,
    preview,
    write_layer,
)

__all__ = ["LayerWriter", "export_csv", "kafka_records", "preview", "write_kafka", "write_layer"]
