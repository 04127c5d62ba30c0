"""Explicit schemas, so that no source is scanned just to guess its types."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "date": T.DateType()}


def _struct(fields: str) -> T.StructType:
    """``name type`` pairs -> schema. Unlike Spark's own DDL reader it needs no session."""
    pairs = (pair.split() for pair in fields.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])

# Column names and types of one reservation row. `children`, `agent`,
# `company` and `country` carry text tokens for "missing", so they stay strings.
RAW = _struct(
    """
    hotel string, is_canceled int, lead_time int, arrival_date_year int,
    arrival_date_month string, arrival_date_week_number int, arrival_date_day_of_month int,
    stays_in_weekend_nights int, stays_in_week_nights int, adults int, children string,
    babies int, meal string, country string, market_segment string,
    distribution_channel string, is_repeated_guest int, previous_cancellations int,
    previous_bookings_not_canceled int, reserved_room_type string, assigned_room_type string,
    booking_changes int, deposit_type string, agent string, company string,
    days_in_waiting_list int, customer_type string, adr double,
    required_car_parking_spaces int, total_of_special_requests int,
    reservation_status string, reservation_status_date date
    """
)

# Fields of the event message.
EVENT = _struct(
    """
    hotel string, is_canceled int, lead_time int, arrival_date_year int,
    arrival_date_month string, arrival_date_day_of_month int, stays_in_weekend_nights int,
    stays_in_week_nights int, adults int, children int, babies int, meal string,
    country string, market_segment string, distribution_channel string,
    is_repeated_guest int, previous_cancellations int, reserved_room_type string,
    assigned_room_type string, booking_changes int, deposit_type string,
    customer_type string, adr double, days_in_waiting_list int,
    total_of_special_requests int, reservation_status string, event_time string,
    event_id string
    """
)


def cleaned_schema() -> T.StructType:
    """RAW after cleaning: no `company`, `children` as a number."""
    fields = []
    for field in RAW.fields:
        if field.name == "company":
            continue
        dtype = T.IntegerType() if field.name == "children" else field.dataType
        fields.append(T.StructField(field.name, dtype))
    return T.StructType(fields)


CLEANED = cleaned_schema()

# Roles of the 21 model columns.
TARGET = "is_canceled"
CATEGORICAL = [
    "hotel", "meal", "country", "market_segment", "distribution_channel",
    "reserved_room_type", "deposit_type", "customer_type", "agent",
]
NUMERIC = [
    "lead_time", "total_guests", "total_nights", "total_estimated_cost",
    "total_past_bookings", "cancellation_rate", "days_in_waiting_list",
    "required_car_parking_spaces", "total_of_special_requests",
]
FLAGS = ["is_repeated_guest", "is_family"]
