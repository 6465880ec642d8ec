"""Aviation vocabulary: units, flight phases, manufacturers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unit factors and the climb threshold in metres per second.
FEET_PER_METRE = 3.28084
KNOTS_PER_METRE_SECOND = 1.94384
CLIMB_THRESHOLD_MS = 1.5

# Labels stored in the marts.
GROUND = "sol"
CLIMB = "montee"
DESCENT = "descente"
CRUISE = "croisiere"
UNKNOWN_PHASE = "inconnu"
PHASES = (GROUND, CLIMB, DESCENT, CRUISE, UNKNOWN_PHASE)
UNKNOWN = "Inconnu"
OTHER = "Autre"

# Manufacturer group and the name fragments that select it, first match wins.
MANUFACTURERS = (
    ("Airbus", ("airbus",)),
    ("Boeing", ("boeing",)),
    ("Embraer", ("embraer",)),
    ("Bombardier", ("bombardier", "canadair")),
    ("ATR", ("atr",)),
)


def feet(metres: Column) -> Column:
    return metres * FEET_PER_METRE


def knots(metres_per_second: Column) -> Column:
    return metres_per_second * KNOTS_PER_METRE_SECOND


def flight_phase(on_ground: Column, vertical_rate: Column) -> Column:
    """Phase from the climb rate; the threshold keeps transponder noise inside cruise."""
    return (
        F.when(on_ground, GROUND)
        .when(vertical_rate.isNull(), UNKNOWN_PHASE)
        .when(vertical_rate > CLIMB_THRESHOLD_MS, CLIMB)
        .when(vertical_rate < -CLIMB_THRESHOLD_MS, DESCENT)
        .otherwise(CRUISE)
    )


def manufacturer_group(manufacturer: Column) -> Column:
    folded = F.lower(manufacturer)
    label = F.when(manufacturer.isNull(), UNKNOWN)
    for group, fragments in MANUFACTURERS:
        matches = F.lit(False)
        for fragment in fragments:
            matches = matches | folded.contains(fragment)
        label = label.when(matches, group)
    return label.otherwise(OTHER)
