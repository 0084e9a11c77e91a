from headway.functions.event_time import EVENT_PARTITIONS, epoch_of, from_hour, hour_of, with_event_parts
from headway.functions.service_time import (
    is_service_time,
    local_epoch,
    seconds_late,
    service_date,
    service_seconds,
)

__all__ = [
    "EVENT_PARTITIONS",
    "epoch_of",
    "from_hour",
    "is_service_time",
    "local_epoch",
    "seconds_late",
    "service_date",
    "service_seconds",
    "with_event_parts",
]
