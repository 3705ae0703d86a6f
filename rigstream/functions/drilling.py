"""Operational measures of a rig, as column expressions.

Readings may be NaN. A comparison with NaN is false on the wire format's number
model, while Spark sorts NaN above every number, so each open upper bound is guarded.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Fixed values.
UNKNOWN_STATUS = 2147483647
NULL_DEPTH = -999.25
MISSING_CHANNEL = -9999.0
STILL_BAND = 0.1
PUMP_ON = 0.00630902
PUMP_PRESSURE = 3447380.0
TOP_DRIVE_OFF = 1.05
TOP_DRIVE_ON = 3.15
BIT_ABOVE = -0.3048
BIT_TOUCHING = 0.33

# Label, pipe direction, pump, top drive, slip, bit on bottom; None matches
# anything. The first matching row wins.
RIG_STATES = [
    ("Stationary", 0, -1, -1, 0, 1),
    ("Rotating", 0, -1, 1, 0, 1),
    ("Rotating Pumping", 0, 1, 1, 0, 1),
    ("Pumping", 0, 1, -1, None, 1),
    ("Rotary Drilling", -1, 1, 1, 0, 0),
    ("Slide Drilling", -1, 1, -1, 0, 0),
    ("Tripping Out Pumping", 1, 1, -1, 0, 1),
    ("Tripping Out", 1, -1, -1, 0, 1),
    ("Tripping Out Rotating", 1, -1, 1, 0, 1),
    ("Tripping In Pumping", -1, 1, -1, 0, 1),
    ("Tripping In", -1, -1, -1, 0, 1),
    ("Tripping In Rotating", -1, -1, 1, 0, 1),
    ("In Slips", None, None, None, 1, 1),
    ("Back Ream", 1, 1, 1, 0, 1),
    ("Ream In", -1, 1, 1, 0, 1),
]


def ieee_divide(top: Column, bottom: Column) -> Column:
    """Division that yields infinity or NaN for a zero divisor instead of raising."""
    return F.when(bottom == 0, top * F.pow(bottom, F.lit(-1.0))).otherwise(F.try_divide(top, bottom))


def _above(value: Column, bound: float) -> Column:
    return (value > bound) & ~F.isnan(value)


def direction(before: Column, after: Column) -> Column:
    """1 up, 0 stopped, -1 down."""
    moved = after - before
    return F.when(_above(moved, 0.0), 1).when(moved == 0, 0).otherwise(-1)


def direction_text(before: Column, after: Column) -> Column:
    moved = after - before
    return F.when(_above(moved, 0.0), "up").when(moved == 0, "stopped").otherwise("down")


def velocity(before: Column, after: Column, ts_before: Column, ts_after: Column) -> Column:
    """Distance per whole second between two readings."""
    seconds = F.call_function("div", ts_after - ts_before, F.lit(1000)).cast("double")
    return F.abs(ieee_divide(after - before, seconds))


def pipe_direction(bit_before: Column, bit_now: Column) -> Column:
    """0 still, -1 going in, 1 coming out."""
    moved = bit_now - bit_before
    return (
        F.when(F.abs(moved) <= STILL_BAND, 0)
        .when(_above(moved, 0.0), -1)
        .when(moved < 0, 1)
        .otherwise(UNKNOWN_STATUS)
    )


def pump_status(output: Column, pressure: Column) -> Column:
    on = _above(output, PUMP_ON) & (pressure >= PUMP_PRESSURE) & ~F.isnan(pressure)
    return F.when(output <= PUMP_ON, -1).when(on, 1).otherwise(UNKNOWN_STATUS)


def top_drive_status(rpm: Column) -> Column:
    return (
        F.when(rpm <= TOP_DRIVE_OFF, -1)
        .when(_above(rpm, TOP_DRIVE_ON), 1)
        .when(rpm <= TOP_DRIVE_ON, 0)
        .otherwise(UNKNOWN_STATUS)
    )


def bit_on_bottom(bit: Column, hole: Column) -> Column:
    gap = hole - bit
    return F.when(gap < BIT_ABOVE, -1).when(gap < BIT_TOUCHING, 0).otherwise(1)


def rig_state(
    bit: Column, hole: Column, pipe: Column, pump: Column, top_drive: Column, slip: Column, bottom: Column
) -> Column:
    """The rig's activity label from its four statuses and the slip flag."""
    label = F.when((bit == NULL_DEPTH) & (hole == NULL_DEPTH), "Depth Data Issue").when(
        (bit <= 0) & (bit != NULL_DEPTH) & _above(hole, 0.0), "Out of Hole"
    )
    for name, *wanted in RIG_STATES:
        tests = [have == want for have, want in zip((pipe, pump, top_drive, slip, bottom), wanted) if want is not None]
        match = tests[0]
        for test in tests[1:]:
            match = match & test
        label = label.when(match, name)
    return label.otherwise("Unknown")


def specific_energy(torque: Column, rpm: Column, rop: Column, wob: Column, diameter: Column) -> Column:
    """Mechanical specific energy: rotary work per drilled volume plus axial stress."""
    area = diameter * diameter
    rotary = ieee_divide(F.lit(480.0) * torque * rpm, area * rop)
    axial = ieee_divide(F.lit(4.0) * wob, area * F.lit(math.pi))
    return rotary + axial


def time_to_limit(rate: Column, level: Column, limit: float) -> Column:
    """Whole seconds until ``level`` reaches ``limit``: 0 when reached, -1 when it is not coming closer."""
    top = F.lit(float(limit))
    seconds = F.floor(F.try_divide(top - level, rate))
    return (
        F.when(_above(rate, 0.0) & (top > level), seconds)
        .when((rate >= 0) & ~F.isnan(rate) & (level >= top) & ~F.isnan(level), F.lit(0).cast("bigint"))
        .otherwise(F.lit(-1).cast("bigint"))
    )
