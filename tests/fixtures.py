"""Hand-written reservations and helpers."""

from __future__ import annotations

import datetime

from staylens.schemas import RAW

# A plain, valid row; every test row states only what differs from it.
PLAIN = dict(
    hotel="City Hotel", is_canceled=0, lead_time=30, arrival_date_year=2016, arrival_date_month="July",
    arrival_date_week_number=27, arrival_date_day_of_month=1, stays_in_weekend_nights=1, stays_in_week_nights=2,
    adults=2, children="0", babies=0, meal="BB", country="PRT", market_segment="Direct",
    distribution_channel="Direct", is_repeated_guest=0, previous_cancellations=0,
    previous_bookings_not_canceled=0, reserved_room_type="A", assigned_room_type="A", booking_changes=0,
    deposit_type="No Deposit", agent="9", company="NULL", days_in_waiting_list=0, customer_type="Transient",
    adr=100.0, required_car_parking_spaces=0, total_of_special_requests=0, reservation_status="Check-Out",
    reservation_status_date=datetime.date(2016, 7, 4),
)


def bookings(spark, *changes: dict):
    rows = [tuple({**PLAIN, **change}[f.name] for f in RAW.fields) for change in changes]
    return spark.createDataFrame(rows, RAW)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    table = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in table.collect()), key=repr)
