"""Slowly changing customer dimension, type 2.

* ``scd2_initial``: first load, one open version per customer.
* ``scd2_apply``: check strategy on 8 tracked columns.  Current versions and the
  incoming batch are joined on the key (full outer); changes are detected with
  null-safe equality (``<=>``) so NULL → value and value → NULL are changes and
  NULL vs '' is not equated (the output ``row_hash`` does equate them, so it is
  never used for detection).  New keys open a version, changed keys close the
  current version at the load time and open a new one, unchanged keys keep
  theirs, keys missing from the batch stay open unless ``close_missing``.
  Applying the same batch twice is a no-op.
* ``scd2_from_changes``: builds the chains from a change log — consecutive
  identical states collapse, ``valid_to`` = next ``valid_from``.
* ``point_in_time``: fact rows get the version valid at their document date
  (equi-join on the key and a time slice, half-open interval within it).

Plain parquet has no MERGE: ``StoredHistory`` keeps the history in customer
buckets and rewrites the buckets that a load changes (S04).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..plans.ranking import keyed_row_number
from ..plans.stage import discard, stage
from ..sources.parts import PartStore, bucket_of
from .dims import DEFAULT_VALID_FROM, TS_FORMAT, VALID_TO, row_hash, ts, unknown_key

KEY = "customer_id"
CHECK_COLS = ("customer_name", "customer_class_id", "corporate_customer_id", "salesperson_id", "territory_id",
              "payment_terms_id", "credit_limit_amount", "is_inactive")
SNAPSHOT_COLS = ("customer_id", "customer_name", "customer_class_id", "corporate_customer_id",
                 "primary_contact_person", "address_line1", "city", "state", "zip_code", "country", "phone_number_1",
                 "salesperson_id", "territory_id", "payment_terms_id", "credit_limit_amount", "credit_limit_type",
                 "is_inactive", "created_at", "modified_at")
SCD_COLS = ("customer_sk", "valid_from", "valid_to", "is_current", "row_hash")

# Time slice of the point-in-time join, about a quarter: a version of many years is listed a few dozen times.
SLICE_DAYS = 91


def _version(df: DataFrame, valid_from: Column) -> DataFrame:
    return df.select(
        *SNAPSHOT_COLS,
        F.md5(F.concat(F.col(KEY), F.lit("_"), F.date_format(valid_from, TS_FORMAT))).alias("customer_sk"),
        valid_from.alias("valid_from"), ts(VALID_TO).alias("valid_to"), F.lit(True).alias("is_current"),
        row_hash().alias("row_hash"))


def scd2_initial(customers: DataFrame) -> DataFrame:
    """First load: valid from the customer's creation (or 2000-01-01)."""
    return _version(customers, F.coalesce(F.col("created_at"), ts(DEFAULT_VALID_FROM)))


def _changed() -> Column:
    cond = F.lit(False)
    for c in CHECK_COLS:
        cond = cond | ~F.col(f"c.{c}").eqNullSafe(F.col(f"i.{c}"))
    return cond


def scd2_apply(history: DataFrame, incoming: DataFrame, load_ts: str, close_missing: bool = False) -> DataFrame:
    """Apply one batch of source rows to the history (check strategy)."""
    load = ts(load_ts)
    closed_hist = history.where(~F.col("is_current"))
    cur = history.where(F.col("is_current")).alias("c")
    inc = incoming.select(*SNAPSHOT_COLS).alias("i")
    j = cur.join(inc, F.col(f"c.{KEY}") == F.col(f"i.{KEY}"), "full_outer")
    in_cur, in_inc = F.col(f"c.{KEY}").isNotNull(), F.col(f"i.{KEY}").isNotNull()
    changed = in_cur & in_inc & _changed()
    leaves = changed | (in_cur & ~in_inc) if close_missing else changed
    # one join; each pair of states gives its kept, closed and opened versions
    state = {side: [F.col(f"{side}.{c}").alias(c) for c in SNAPSHOT_COLS] for side in "ci"}
    own = [F.col(f"c.{c}") for c in SCD_COLS]
    as_is = dict(zip(SCD_COLS, own, strict=True))
    closed = {**as_is, "valid_to": load, "is_current": F.lit(False)}
    opened = {"customer_sk": F.md5(F.concat(F.col(f"i.{KEY}"), F.lit("_"), F.date_format(load, TS_FORMAT))),
              "valid_from": load, "valid_to": ts(VALID_TO), "is_current": F.lit(True), "row_hash": row_hash("i")}

    def version(side: str, scd: dict) -> Column:
        return F.struct(*state[side], *[scd[c].alias(c) for c in SCD_COLS])

    versions = F.array(F.when(in_cur, F.when(leaves, version("c", closed)).otherwise(version("c", as_is))),
                       F.when(in_inc & (~in_cur | changed), version("i", opened)))
    rows = j.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("v")).select("v.*")
    return closed_hist.select(*SNAPSHOT_COLS, *SCD_COLS).unionByName(rows)


def scd2_from_changes(changes: DataFrame, ts_col: str = "change_ts") -> DataFrame:
    """Chains from a change log (one row per observed state and time).

    Each customer's rows are numbered by ``change_ts`` with
    ``plans.ranking.keyed_row_number`` (a customer with a huge change history
    is spread over many tasks, never sorted in one); the previous state and
    the next version start are equi-joins on the unique (customer, number)
    pair, so no step groups a whole history.
    """
    state = F.struct(*[F.col(c) for c in CHECK_COLS])
    d = keyed_row_number(changes.select(*SNAPSHOT_COLS, F.col(ts_col), state.alias("_state")),
                         [KEY], [F.col(ts_col).asc()], "_rn")
    prev = d.select(F.col(KEY).alias("_p_key"), (F.col("_rn") + 1).alias("_p_rn"), F.col("_state").alias("_prev"))
    d = d.join(prev, F.col(KEY).eqNullSafe(F.col("_p_key")) & (F.col("_rn") == F.col("_p_rn")), "left")
    starts = (d.where(F.col("_prev").isNull() | ~F.col("_state").eqNullSafe(F.col("_prev")))
              .select(*SNAPSHOT_COLS, F.col(ts_col)))
    v = keyed_row_number(starts, [KEY], [F.col(ts_col).asc()], "_vn")
    nxt = v.select(F.col(KEY).alias("_n_key"), (F.col("_vn") - 1).alias("_n_vn"), F.col(ts_col).alias("_next"))
    v = v.join(nxt, F.col(KEY).eqNullSafe(F.col("_n_key")) & (F.col("_vn") == F.col("_n_vn")), "left")
    return v.select(
        *SNAPSHOT_COLS,
        F.md5(F.concat(F.col(KEY), F.lit("_"), F.date_format(ts_col, TS_FORMAT))).alias("customer_sk"),
        F.col(ts_col).alias("valid_from"), F.coalesce(F.col("_next"), ts(VALID_TO)).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"), row_hash().alias("row_hash"))


def _slice(day: Column, days: int) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / days)


def point_in_time(facts: DataFrame, history: DataFrame, date_col: str = "document_date",
                  slice_days: int = SLICE_DAYS) -> DataFrame:
    """Attach the customer version valid at ``date_col`` (half-open interval).

    Every version is listed once for each time slice that it overlaps, clipped to
    the slices of the facts (two scalar subqueries), so the join is an equality on
    (customer, slice); the interval only decides between versions of one slice.
    A customer with a third of all facts is thereby cut into as many join keys as
    there are slices, on both sides, and nothing has to be broadcast."""
    day = F.col(date_col).cast("date")
    first, last = (facts.select(agg(_slice(day, slice_days))).scalar() for agg in (F.min, F.max))
    low = F.greatest(_slice(F.col("valid_from").cast("date"), slice_days), first)
    high = F.least(_slice(F.col("valid_to").cast("date"), slice_days), last)
    spans = history.select(F.col(KEY).alias("h_key"), F.col("customer_sk").alias("h_sk"), "valid_from", "valid_to",
                           low.alias("_low"), high.alias("_high")).where(F.col("_low") <= F.col("_high"))
    h = spans.select("h_key", "h_sk", "valid_from", "valid_to", F.explode(F.sequence("_low", "_high")).alias("h_slice"))
    at = F.col(date_col).cast("timestamp")
    j = facts.join(h, (F.col(KEY) == F.col("h_key")) & (_slice(day, slice_days) == F.col("h_slice"))
                   & (at >= F.col("valid_from")) & (at < F.col("valid_to")), "left")
    return j.select(*[F.col(c) for c in facts.columns],
                    F.coalesce("h_sk", unknown_key(L.UNKNOWN_CUSTOMER)).alias("customer_sk"))


# ------------------------------------------------------------------------ S04
class StoredHistory:
    """The history below ``base_dir`` in customer buckets.

    A load reads the buckets of its customers, writes those in which a version
    was opened or closed, and publishes them at once (``sources.parts``): readers
    see the history before or after a load, an interrupted load leaves no trace,
    and a load without changes writes nothing."""

    def __init__(self, spark: SparkSession, base_dir: str, buckets: int = 64):
        self.store, self.buckets = PartStore(spark, base_dir), buckets

    def read(self, version: int | None = None) -> DataFrame:
        """The history as of the given load, or the latest one."""
        return self.store.read("history", number=version)

    def load(self, incoming: DataFrame, load_ts: str, close_missing: bool = False) -> list[str]:
        """Apply one batch (whole extract or changed customers only); returns the written buckets.
        With ``close_missing`` the batch must be the whole extract."""
        part = bucket_of(KEY, self.buckets)
        change = self.store.change()
        own = [r.part for r in incoming.select(part.alias("part")).distinct().collect()]
        old = self.store.read("history", None if close_missing else own)
        if old is None:
            written = change.replace("history", scd2_initial(incoming).withColumn("part", part), own)
        else:
            new = stage(scd2_apply(old, incoming, load_ts, close_missing).withColumn("part", part), "history")
            # rows that were not there: closed and opened versions
            fresh = new.join(old.select("customer_sk", "valid_to"), ["customer_sk", "valid_to"], "left_anti")
            changed = [r.part for r in fresh.select("part").distinct().collect()]
            if not changed:
                return []
            written = change.replace("history", new.where(F.col("part").isin(changed)), changed)
            discard(new)
        change.publish()
        return sorted(written)
