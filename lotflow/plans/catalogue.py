"""The registered queries: each takes (session, table folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.functions.columns import div, floor_of
from lotflow.operators import checkout, lifetime, pricing, quality, records, sketches, slot_state, slots, transitions, views, visits
from lotflow.schemas import EVENT_JSON, TIMESTAMP_PATTERN
from lotflow.settings import Settings
from lotflow.sources import config, ledger
from lotflow.sources.feed import parse_records, to_record
from lotflow.sources.slots import slot_dimension
from lotflow.sources.tables import noisy_records, table_events

# Parameters of the registered queries, used by their SQL twins too.
SETTINGS = Settings()
VIP_LISTED = ("A1",)
LEDGER_CLOSED = "2024-01-16 00:00:00"  # payments of exits before this are in the ledger
AS_OF = 1706745600  # 2024-02-01 00:00:00 UTC
CONFIG_FILE = '{"price": {"price_per_10min": 6000}, "parking": {"total_slots": 60}}'
LEGACY_FILE = '{"price_per_10min": 7000}'

Query = Callable[[SparkSession, str], DataFrame]


def _fees(spark: SparkSession, sf: str, until: str | None = None) -> DataFrame:
    return lifetime.lifetime_fees(table_events(spark, sf, until), SETTINGS)


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger as of mid feed: every vehicle that was EXITING then has paid."""
    return checkout.as_payments(checkout.checkout_records(_fees(spark, sf, LEDGER_CLOSED)))


def _view(spark: SparkSession, sf: str) -> DataFrame:
    return views.status_view(views.snapshot(_fees(spark, sf)), _ledger(spark, sf))


def _versions(spark: SparkSession, sf: str) -> DataFrame:
    """A price list as long as the feed: each PARKED event changes the price; some lack the price or its time."""
    number = F.col("event_id")
    return table_events(spark, sf).where("status_code = 'PARKED'").select(
        F.when(number % 13 != 0, F.col("timestamp_unix")).alias("valid_from"),
        F.when(number % 17 != 0, 4000 + number % 9 * 500).alias("price"),
    )


def parse_events(spark, sf):
    parsed = parse_records(to_record(table_events(spark, sf)))
    return parsed.select(
        "event_id", *EVENT_JSON.fieldNames(), F.unix_timestamp("event_time").alias("event_time_unix")
    )


def malformed_events(spark, sf):
    return quality.malformed_events(parse_records(noisy_records(spark, sf)))


def billable_events(spark, sf):
    return quality.billable_events(table_events(spark, sf)).select(
        "event_id", *EVENT_JSON.fieldNames(), "parked_time", "parked_timestamp"
    )


def clock_check(spark, sf):
    """Records whose text clock drifts at the exit, by -90 to 90 seconds."""
    events = table_events(spark, sf)
    drift = F.when(F.col("status_code") == "EXITING", F.pmod("event_id", F.lit(7)) * 30 - 90).otherwise(0)
    text = F.date_format(F.timestamp_seconds(F.unix_timestamp("event_time") + drift), TIMESTAMP_PATTERN)
    return quality.clock_check(parse_records(to_record(events.withColumn("timestamp", text))))


def lifetime_fees(spark, sf):
    return _fees(spark, sf)


def lifetime_fees_entering(spark, sf):
    return lifetime.lifetime_fees_entering(table_events(spark, sf), SETTINGS)


def window_fees_30s(spark, sf):
    return lifetime.window_fees(table_events(spark, sf), SETTINGS)


def fee_table(spark, sf):
    return pricing.fee_table(_fees(spark, sf), SETTINGS.price_per_10min)


def display_columns(spark, sf):
    return views.display_columns(_view(spark, sf))


def active_vehicles(spark, sf):
    return views.by_slot(views.active_vehicles(_fees(spark, sf)))


def snapshot_all(spark, sf):
    return views.by_slot(views.snapshot(_fees(spark, sf)))


def checkout_records(spark, sf):
    return checkout.checkout_records(_fees(spark, sf))


def status_view(spark, sf):
    return views.by_slot(_view(spark, sf))


def summary_stats(spark, sf):
    return views.summary_stats(_view(spark, sf), SETTINGS)


def floor_summary(spark, sf):
    return views.floor_summary(_view(spark, sf), slot_dimension(spark, SETTINGS))


def location_detail(spark, sf):
    return views.location_detail(_view(spark, sf), slot_dimension(spark, SETTINGS))


def vehicle_totals(spark, sf):
    return views.vehicle_totals(_view(spark, sf))


def vehicle_locations(spark, sf):
    return views.vehicle_locations(_view(spark, sf))


def slot_dimension_query(spark, sf):
    return slots.slot_sightings(slot_dimension(spark, SETTINGS), quality.valid_events(table_events(spark, sf)))


def free_slots(spark, sf):
    state = slot_state.slot_fsm_current(table_events(spark, sf), SETTINGS)
    return slots.free_slots(slot_dimension(spark, SETTINGS), state).orderBy("location")


def vip_slots(spark, sf):
    dimension = slot_dimension(spark, SETTINGS)
    listed = dimension.where(F.col("location").isin(*VIP_LISTED))
    vip = slots.vip_slots(dimension, listed)
    counts = quality.valid_events(table_events(spark, sf)).groupBy("location").agg(F.count(F.lit(1)).alias("sightings"))
    sightings = F.coalesce("sightings", F.lit(0).cast("long")).alias("sightings")
    return vip.join(counts, "location", "left").select("location", sightings).orderBy("location")


def slot_conflicts(spark, sf):
    return slots.slot_conflicts(slots.latest_places(table_events(spark, sf)))


def visit_fees(spark, sf):
    return visits.visit_fees(table_events(spark, sf), SETTINGS)


def visit_fees_with_gap(spark, sf):
    return visits.visit_fees(table_events(spark, sf), SETTINGS, max_gap_seconds=86400)


def park_exit_pairs(spark, sf):
    return visits.park_exit_pairs(visits.visits(table_events(spark, sf)))


def occupied_by_visits(spark, sf):
    return visits.occupied_by_visits(visits.visits(table_events(spark, sf)))


def visit_paths(spark, sf):
    return visits.visit_paths(table_events(spark, sf))


def status_changes(spark, sf):
    return transitions.status_changes(table_events(spark, sf))


def transition_audit(spark, sf):
    return transitions.transition_audit(transitions.status_changes(table_events(spark, sf)))


def status_dwell(spark, sf):
    return transitions.status_dwell(transitions.status_spells(table_events(spark, sf)))


def slot_fsm_events(spark, sf):
    return slot_state.slot_fsm_events(table_events(spark, sf), SETTINGS).drop("timestamp_unix", "status_rank")


def slot_fsm_current(spark, sf):
    return slot_state.slot_fsm_current(table_events(spark, sf), SETTINGS)


def live_state(spark, sf):
    return slot_state.live_state(slot_fsm_current(spark, sf), AS_OF, SETTINGS)


def vip_tier_fees(spark, sf):
    return pricing.vip_tier_fees(_fees(spark, sf), Settings(vip_locations=VIP_LISTED))


def price_asof_fees(spark, sf):
    return pricing.price_asof_fees(_fees(spark, sf), _versions(spark, sf))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """A configuration document per PARKED event; most leave the price as it was, some lack it or its time."""
    number = F.col("event_id")
    price = F.struct(
        F.when(number % 7 != 0, 4000 + div("timestamp_unix", 200_000) % 3 * 500).alias("price_per_10min"),
        F.when(number % 11 != 0, F.col("timestamp")).alias("updated_at"),
    )
    return table_events(spark, sf).where("status_code = 'PARKED'").select(F.to_json(F.struct(price.alias("price"))).alias("value"))


def price_history(spark, sf):
    return pricing.price_history(_documents(spark, sf))


def config_price_fees(spark, sf):
    return pricing.config_price_fees(_fees(spark, sf), _documents(spark, sf), SETTINGS)


def exact_plates(spark: SparkSession, sf: str, estimated: DataFrame) -> DataFrame:
    """Distinct plates of each floor, and whether the estimate (floor, plates) is within its error."""
    rows = quality.valid_events(table_events(spark, sf)).where(F.col("license_plate").isNotNull())
    exact = rows.groupBy(floor_of("location").alias("floor")).agg(F.countDistinct("license_plate").alias("exact"))
    close = F.abs(F.col("plates") - F.col("exact")) <= F.greatest(F.lit(1.0), sketches.PLATE_ERROR * F.col("exact"))
    joined = exact.join(estimated, "floor", "left")
    return joined.select("floor", F.col("exact").alias("plates"), F.coalesce(close, F.lit(False)).alias("within_error"))


def plate_sketches(spark, sf):
    """Floors from sketches of slots and days."""
    found = sketches.plate_sketches(table_events(spark, sf))
    return exact_plates(spark, sf, sketches.distinct_plates(found, floor_of("location").alias("floor")))


def dwell_quantiles(spark, sf):
    """Medians and 95th percentiles from sketches of days, and whether the exact ranks of the answers fit."""
    spells = transitions.status_spells(table_events(spark, sf)).where(F.col("dwell_seconds").isNotNull())
    found = sketches.dwell_quantiles(sketches.dwell_sketches(spells))
    seconds = F.col("dwell_seconds")
    ranks = spells.join(F.broadcast(found), "status_code").groupBy("status_code", "level").agg(
        F.count(F.lit(1)).alias("spells"),
        F.count(F.when(seconds < F.col("seconds"), 1)).alias("below"),
        F.count(F.when(seconds <= F.col("seconds"), 1)).alias("reached"),
    )
    slack, wanted = sketches.RANK_ERROR * F.col("spells") + 1, F.col("level") * F.col("spells")
    fits = (F.col("below") <= wanted + slack) & (F.col("reached") >= wanted - slack)
    return ranks.select("status_code", "level", "spells", fits.alias("within_bounds"))


def layered_config(spark, sf):
    """Lifetime fees under the price of each depth of layering."""
    text = lambda value: spark.range(1).select(F.lit(value).alias("value"))
    file_layer = config.config_layer(text(CONFIG_FILE), 1)
    legacy = config.legacy_layer(text(LEGACY_FILE), 2)
    with_file = config.settings_from(config.effective_config(file_layer), SETTINGS)
    with_legacy = config.settings_from(config.effective_config(file_layer, legacy), SETTINGS)
    fees = _fees(spark, sf)
    fee = lambda s: (F.col("fee_blocks") * F.lit(s.price_per_10min).cast("long"))
    return fees.select(
        "location",
        "license_plate",
        "fee_blocks",
        fee(SETTINGS).alias("fee_default"),
        fee(with_file).alias("fee_file"),
        fee(with_legacy).alias("fee_legacy"),
    )


def ledger_rows(spark, sf):
    return ledger.ledger_rows(ledger.ledger_documents(_ledger(spark, sf)))


def ledger_upsert(spark, sf):
    payments = checkout.as_payments(checkout.checkout_records(_fees(spark, sf)))
    return checkout.ledger_upsert(_ledger(spark, sf), payments)


def ledger_per_stay(spark, sf):
    payments = checkout.as_payments(checkout.checkout_records(_fees(spark, sf)))
    return checkout.ledger_upsert(_ledger(spark, sf), payments, per_stay=True)


def unpaid_stays(spark, sf):
    """Closed visits whose stay (plate, slot, entry time) has no payment of its own."""
    stays = visits.visit_fees(table_events(spark, sf), SETTINGS).where("closed").select(
        "license_plate", F.col("last_location").alias("location"), "entry_time", "exit_time", "total_fee"
    )
    paid = visits.visit_fees(table_events(spark, sf, LEDGER_CLOSED), SETTINGS).where("closed").select(
        "license_plate", F.col("last_location").alias("location"), "entry_time"
    )
    return checkout.unpaid_stays(stays, paid)


def checkout_requests(spark, sf):
    """Every event asks to pay for its vehicle, in lower case; entering vehicles forget the slot."""
    events = table_events(spark, sf)
    requests = events.select(
        F.col("event_id").alias("request_id"),
        F.lower("license_plate").alias("license_plate"),
        F.when(F.col("status_code") != "ENTERING", F.lower("location")).alias("location"),
    )
    return checkout.checkout_requests(requests, _view(spark, sf))


def checkout_repeats(spark, sf):
    """The same with ids that two requests share or that are missing, and every request sent twice."""
    events = table_events(spark, sf)
    requests = events.select(
        F.when(F.col("event_id") % 11 != 0, F.expr("event_id div 2")).alias("request_id"), "license_plate", "location"
    )
    return checkout.checkout_requests(requests.unionAll(requests), _view(spark, sf))


def checkout_stays(spark, sf):
    """Every event asks to pay, when it happens, for the stay of its vehicle; stays over by a day are paid already."""
    stays = visits.visit_fees(table_events(spark, sf), SETTINGS)
    paid = visits.visit_fees(table_events(spark, sf, LEDGER_CLOSED), SETTINGS).where("closed")
    paid = paid.select("license_plate", F.col("last_location").alias("location"), "entry_time")
    requests = table_events(spark, sf).select(
        F.col("event_id").alias("request_id"),
        F.lower("license_plate").alias("license_plate"),
        "location",
        F.when(F.col("event_id") % 7 != 0, F.col("timestamp_unix")).alias("requested_unix"),
    )
    return checkout.stay_requests(requests, stays, paid)


def torn_records(records: DataFrame) -> DataFrame:
    """Records over four partitions, with ranges of offsets taken out."""
    kept = records.where("offset div 97 % 5 <> 0")
    return kept.select((F.col("offset") % 4).cast("int").alias("partition"), F.expr("offset div 4").alias("offset"))


def record_gaps(spark, sf):
    """Ranges of offsets that never came."""
    return records.gaps(records.islands(torn_records(to_record(table_events(spark, sf)))))


def checkout_history(spark, sf):
    return checkout.checkout_history(table_events(spark, sf))


BATCH: dict[str, Query] = {
    "parse_events": parse_events,
    "malformed_events": malformed_events,
    "billable_events": billable_events,
    "clock_check": clock_check,
    "lifetime_fees": lifetime_fees,
    "lifetime_fees_entering": lifetime_fees_entering,
    "window_fees_30s": window_fees_30s,
    "fee_table": fee_table,
    "display_columns": display_columns,
    "active_vehicles": active_vehicles,
    "snapshot_all": snapshot_all,
    "checkout_records": checkout_records,
    "status_view": status_view,
    "summary_stats": summary_stats,
    "floor_summary": floor_summary,
    "location_detail": location_detail,
    "vehicle_totals": vehicle_totals,
    "vehicle_locations": vehicle_locations,
    "slot_dimension": slot_dimension_query,
    "free_slots": free_slots,
    "vip_slots": vip_slots,
    "slot_conflicts": slot_conflicts,
    "visit_fees": visit_fees,
    "visit_fees_with_gap": visit_fees_with_gap,
    "park_exit_pairs": park_exit_pairs,
    "occupied_by_visits": occupied_by_visits,
    "visit_paths": visit_paths,
    "status_changes": status_changes,
    "transition_audit": transition_audit,
    "status_dwell": status_dwell,
    "slot_fsm_events": slot_fsm_events,
    "slot_fsm_current": slot_fsm_current,
    "live_state": live_state,
    "vip_tier_fees": vip_tier_fees,
    "price_asof_fees": price_asof_fees,
    "price_history": price_history,
    "config_price_fees": config_price_fees,
    "plate_sketches": plate_sketches,
    "dwell_quantiles": dwell_quantiles,
    "layered_config": layered_config,
    "ledger_rows": ledger_rows,
    "ledger_upsert": ledger_upsert,
    "ledger_per_stay": ledger_per_stay,
    "unpaid_stays": unpaid_stays,
    "checkout_repeats": checkout_repeats,
    "checkout_stays": checkout_stays,
    "record_gaps": record_gaps,
    "checkout_requests": checkout_requests,
    "checkout_history": checkout_history,
}
