"""Vehicle rental: rent/return outcomes, current state, availability, cost.

The two-state machine (free <-> rented) has a closed form: after any rent
event the vehicle is rented, after any return it is free, whatever the
outcome. So an event's outcome only depends on the kind of the previous event
of the same vehicle — a chunked ``lag``, never a whole-vehicle window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import DEFAULT_CHUNK, earliest_per_key, flag_first, latest_per_key, previous_in_key


def fleet(vehicles: DataFrame) -> DataFrame:
    """Registered vehicles; the first registration of an id wins."""
    return earliest_per_key(vehicles, "vehicle_id", "seq", ["base_price", "vehicle_type"]).drop("seq")


def rental_outcomes(events: DataFrame, vehicles: DataFrame, chunk_width: int = DEFAULT_CHUNK,
                    before: DataFrame | None = None) -> DataFrame:
    """Per event (seq, vehicle_id, kind in rent/return):
    rented / already_rented / returned / not_rented / not_found. ``before``
    (vehicle_id, kind) are the last events ahead of these."""
    ids = fleet(vehicles).select(F.col("vehicle_id").alias("__vid")).withColumn("__known", F.lit(True))
    e = events.join(ids, events["vehicle_id"] == F.col("__vid"), "left").drop("__vid")
    known = e.filter(F.col("__known").isNotNull())
    unknown = e.filter(F.col("__known").isNull())
    known = previous_in_key(known, "vehicle_id", "seq", "kind", "__prev", chunk_width)
    if before is not None:
        last = before.select(F.col("vehicle_id").alias("__vid"), F.col("kind").alias("__last"))
        known = known.join(last, known["vehicle_id"] == F.col("__vid"), "left") \
            .withColumn("__prev", F.coalesce("__prev", "__last")).drop("__vid", "__last")
    was_rented = F.coalesce(F.col("__prev") == "rent", F.lit(False))
    outcome = (F.when(F.col("kind") == "rent", F.when(was_rented, "already_rented").otherwise("rented"))
               .otherwise(F.when(was_rented, "returned").otherwise("not_rented")))
    known = known.withColumn("outcome", outcome).drop("__prev", "__known")
    unknown = unknown.withColumn("outcome", F.lit("not_found")).drop("__known")
    return known.unionByName(unknown)


def vehicle_state(events: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Every registered vehicle (``seq`` = registration order) and whether it
    is rented now. Events act on the first registration of an id, so that one
    is rented iff the id's last event is a rent; a later registration of the
    same id is listed too, and never rented (as in the source's listings)."""
    v = flag_first(vehicles.select("seq", "vehicle_id", "vehicle_type", "base_price"), "vehicle_id", "seq",
                   "__first")
    last = latest_per_key(events, "vehicle_id", "seq", ["kind"]).select(
        F.col("vehicle_id").alias("__vid"), F.col("kind").alias("__last"))
    out = v.join(last, v["vehicle_id"] == F.col("__vid"), "left")
    rented = F.col("__first") & F.coalesce(F.col("__last") == "rent", F.lit(False))
    return out.select("seq", "vehicle_id", "vehicle_type", "base_price", rented.alias("is_rented"))


def available_vehicles(state: DataFrame) -> DataFrame:
    """P10: vehicles not currently rented."""
    return state.filter(~F.col("is_rented"))


def rented_vehicles(state: DataFrame) -> DataFrame:
    return state.filter(F.col("is_rented"))


def rental_cost(requests: DataFrame, state: DataFrame) -> DataFrame:
    """cost = base_price x days for a currently rented vehicle, else
    status ``not_rented`` / ``not_found``. Requests: (seq, vehicle_id, days)."""
    s = earliest_per_key(state, "vehicle_id", "seq", ["base_price", "is_rented"]).select(
        F.col("vehicle_id").alias("__vid"), "base_price", "is_rented")   # the first registration
    out = requests.join(s, requests["vehicle_id"] == F.col("__vid"), "left")
    status = (F.when(F.col("__vid").isNull(), F.lit("not_found"))
              .when(~F.col("is_rented"), F.lit("not_rented")).otherwise(F.lit("ok")))
    cost = F.when(status == "ok", F.col("base_price") * F.col("days"))
    return out.select(*requests.columns, status.alias("status"), cost.alias("cost"))
