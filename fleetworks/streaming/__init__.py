from fleetworks.streaming.landing import FaultLanding, KeyedUpsert, TelemetryLanding, drain, land_streams
from fleetworks.streaming.messages import decode, file_source, kafka_source
from fleetworks.streaming.rollup import EventLog, LateRollup, daily_fault_rollup

__all__ = [
    "FaultLanding", "KeyedUpsert", "TelemetryLanding", "drain", "land_streams", "decode", "file_source",
    "kafka_source", "EventLog", "LateRollup", "daily_fault_rollup",
]
