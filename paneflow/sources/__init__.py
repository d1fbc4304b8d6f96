from paneflow.sources.kafka import kafka_stream, read_kafka, registry_payload
from paneflow.sources.payload import (
    avro_decoders,
    company_columns,
    decode_registry,
    parse_avro,
    parse_company_json,
    parse_json,
    required_fields,
    split_valid,
)
from paneflow.sources.synthetic import per_id_events, rounds, synthetic_events, synthetic_stream

__all__ = [
    "avro_decoders",
    "company_columns",
    "decode_registry",
    "kafka_stream",
    "parse_avro",
    "parse_company_json",
    "parse_json",
    "per_id_events",
    "read_kafka",
    "registry_payload",
    "required_fields",
    "rounds",
    "split_valid",
    "synthetic_events",
    "synthetic_stream",
]
