"""Leaving: checkout rows, bulk payment requests against the ledger, the ledger itself, history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotflow.operators.quality import valid_events
from lotflow.schemas import CHECKOUT, LEDGER_ENTRY

# Outcomes of a payment request.
SUCCESS, MISSING, NOT_FOUND, NOT_EXITING = "success", "missing_field", "not_found", "not_exiting"


def checkout_records(fees: DataFrame, processed: bool = False) -> DataFrame:
    """(Slot, vehicle) rows that are EXITING with a started clock; ``processed`` adds the wall clock."""
    rows = fees.where((F.col("current_status") == "EXITING") & F.col("entry_time").isNotNull())
    rows = rows.withColumn("exit_location", F.col("location")).select(*CHECKOUT.fieldNames())
    return rows.withColumn("processed_time", F.current_timestamp()) if processed else rows


def as_payments(checkouts: DataFrame, checkout_time: Column | None = None) -> DataFrame:
    """Checkout rows as ledger rows, paid at their exit unless another time is given."""
    return checkouts.select(
        "license_plate",
        F.col("exit_location").alias("location"),
        "total_fee",
        "parked_minutes",
        (checkout_time if checkout_time is not None else F.col("exit_timestamp")).alias("checkout_time"),
        "entry_time",
    )


def ledger_latest(log: DataFrame, per_stay: bool = False) -> DataFrame:
    """The latest entry per key of a log of payments.

    The key is (plate, slot), which hides every later stay too; ``per_stay`` adds the entry time
    so that only the paid stay counts as paid.
    """
    keys = ["license_plate", "location", *(["entry_time"] if per_stay else [])]
    names = [name for name in LEDGER_ENTRY.fieldNames() if name not in keys]
    latest = F.max_by(F.struct(*names), F.struct("checkout_time", "total_fee", "parked_minutes"))
    return log.groupBy(*keys).agg(latest.alias("entry")).select(*keys, "entry.*")


def ledger_upsert(ledger: DataFrame, payments: DataFrame, per_stay: bool = False) -> DataFrame:
    """Ledger and payments as one ledger: an aggregate with map-side combine, no join of the two."""
    names = LEDGER_ENTRY.fieldNames() + (["entry_time"] if per_stay else [])
    return ledger_latest(ledger.select(*names).unionByName(payments.select(*names)), per_stay)


def unpaid_stays(stays: DataFrame, ledger: DataFrame) -> DataFrame:
    """Stays (plate, location, entry_time) without a ledger entry of their own."""
    keys = ["license_plate", "location", "entry_time"]
    return stays.join(ledger.select(*keys), keys, "left_anti")


def _lacks_a_field() -> Column:
    empty = lambda name: F.coalesce(F.col(name), F.lit("")) == ""
    return empty("license_plate") | empty("location") | F.col("request_id").isNull()


def _told_apart(rows: DataFrame) -> DataFrame:
    """Rows with ``copy``, which numbers equal ones from 1; they are counted before they move."""
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("int").alias("copies"))
    return counted.select(*rows.columns, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))


def checkout_requests(requests: DataFrame, view: DataFrame) -> DataFrame:
    """The outcome of each (request_id, license_plate, location), letter case aside.

    A stay is charged once: of the requests for one that is leaving, the least request_id succeeds and
    the others find nothing, as if the ledger had hidden it from them; of equal requests one counts as the
    first. A request without an id lacks a field: nothing could be booked for it. Where several rows of the view
    differ in case alone, the first by (slot, plate) counts; the view is brought to one row per folded
    key first, so no request meets more than one row. A success names plate and slot as the view has
    them, so that what it books hides that very row.
    """
    plate, slot = F.upper("license_plate").alias("plate_key"), F.upper("location").alias("slot_key")
    own = F.struct("current_status", "total_fee", "parked_minutes", "license_plate", "location")
    found = view.groupBy(plate, slot).agg(F.min_by(own, F.struct("location", "license_plate")).alias("found"))
    blank = _lacks_a_field()
    # requests without a key would all meet in one partition: they do not join at all
    keys = ["plate_key", "slot_key"]
    complete = _told_apart(requests.where(~blank).select("request_id", plate, slot))
    first = complete.groupBy(*keys).agg(F.min("request_id").alias("first_id"))
    leaving = F.coalesce(F.col("found.current_status") == "EXITING", F.lit(False))
    late = leaving & ((F.col("request_id") != F.col("first_id")) | (F.col("copy") > 1))
    outcome = F.when(F.col("found").isNull() | late, NOT_FOUND).when(~leaving, NOT_EXITING).otherwise(SUCCESS)
    answered = complete.join(found.join(first, keys), keys, "left").select(
        "request_id",
        F.when(leaving & ~late, F.col("found.license_plate")).otherwise(F.col("plate_key")).alias("license_plate"),
        F.when(leaving & ~late, F.col("found.location")).otherwise(F.col("slot_key")).alias("location"),
        outcome.alias("outcome"),
        F.when(~late, F.col("found")).alias("found"),
    )
    paid = F.col("outcome") == SUCCESS
    answered = answered.select(
        "request_id",
        "license_plate",
        "location",
        "outcome",
        F.col("found.current_status").alias("current_status"),
        F.when(paid, F.col("found.total_fee")).alias("total_fee"),
        F.when(paid, F.col("found.parked_minutes")).alias("parked_minutes"),
    )
    missing = requests.where(blank).select(
        "request_id",
        F.upper("license_plate").alias("license_plate"),
        F.upper("location").alias("location"),
        F.lit(MISSING).alias("outcome"),
    )
    return answered.unionByName(missing, allowMissingColumns=True)


def stay_requests(requests: DataFrame, stays: DataFrame, ledger: DataFrame) -> DataFrame:
    """The outcome of each (request_id, license_plate, location, requested_unix), stay by stay.

    A request means the latest stay of the vehicle with this slot as its last that had begun when it was made. A
    stay is paid by the first request made after its end (least time, then id; of equal ones one), and the others
    find nothing, as do requests for a stay with a ledger entry (plate, slot, entry time) and requests before any stay. Letter case aside.
    Stays and requests are put in one order by plate and slot, so no request meets more than one row.
    """
    plate, slot = F.upper("license_plate").alias("plate_key"), F.upper("location").alias("slot_key")
    keys = ["plate_key", "slot_key"]
    names = ("license_plate", "location", "exit_time", "entry_time", "total_fee", "parked_minutes")
    ended = stays.select(*names[:1], F.col("last_location").alias("location"), *names[2:])
    paid = ledger.select("license_plate", "location", "entry_time", F.lit(True).alias("paid")).distinct()
    marked = ended.join(paid, ["license_plate", "location", "entry_time"], "left")
    known = marked.select(plate, slot, F.col("entry_time").alias("at"), F.struct(*names, "paid").alias("stay"))

    blank = _lacks_a_field() | F.col("requested_unix").isNull()
    asked = _told_apart(requests.where(~blank).select("request_id", plate, slot, F.col("requested_unix").alias("at")))
    both = known.unionByName(asked, allowMissingColumns=True)
    # of equal times a stay comes before a request
    so_far = Window.partitionBy(*keys).orderBy("at", F.col("request_id").asc_nulls_first(), "copy").rowsBetween(Window.unboundedPreceding, 0)
    met = both.withColumn("stay", F.last("stay", ignorenulls=True).over(so_far)).where("request_id IS NOT NULL")
    over = F.coalesce(F.col("stay.exit_time") <= F.col("at"), F.lit(False))
    turn = F.row_number().over(Window.partitionBy(*keys, "stay.entry_time", "over").orderBy("at", "request_id", "copy"))
    gone = F.col("stay").isNull() | F.col("stay.paid").isNotNull() | (F.col("over") & (F.col("turn") > 1))
    outcome = F.when(gone, NOT_FOUND).when(~F.col("over"), NOT_EXITING).otherwise(SUCCESS)
    answered = met.withColumn("over", over).withColumn("turn", turn).withColumn("outcome", outcome)
    success = F.col("outcome") == SUCCESS
    booked = [F.when(success, F.col(f"stay.{name}")).alias(name) for name in names[3:]]
    answered = answered.select(
        "request_id",
        F.when(success, F.col("stay.license_plate")).otherwise(F.col("plate_key")).alias("license_plate"),
        F.when(success, F.col("stay.location")).otherwise(F.col("slot_key")).alias("location"),
        "outcome",
        *booked,
    )
    missing = requests.where(blank).select("request_id", plate.alias("license_plate"), slot.alias("location"), F.lit(MISSING).alias("outcome"))
    return answered.unionByName(missing, allowMissingColumns=True)


def payments_of(outcomes: DataFrame, checkout_time: Column) -> DataFrame:
    """Ledger rows of the requests that succeeded, with the entry time of the stay where the outcome names one."""
    stay = ["entry_time"] if "entry_time" in outcomes.columns else []
    return outcomes.where(F.col("outcome") == SUCCESS).select(
        "license_plate", "location", "total_fee", "parked_minutes", checkout_time.alias("checkout_time"), *stay
    )


def checkout_history(events: DataFrame) -> DataFrame:
    """EXITING events with an id that a replay gives again."""
    exits = valid_events(events).where(F.col("status_code") == "EXITING")
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("timestamp_unix", "license_plate", "location", "event_id")]
    return exits.select(
        F.sha2(F.concat_ws("|", *parts), 256).alias("event_id"),
        F.col("timestamp_unix").alias("event_time_unix"),
        "license_plate",
        "location",
        F.col("status_code").alias("status"),
    )
