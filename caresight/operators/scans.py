"""Order-dependent operators that must not funnel a key (or everything) into one task.

* ``global_sequence``  ROW_NUMBER() OVER (ORDER BY ...) over a whole table.
* ``asof_join``        nearest anchor on or before / on or after each row, per key.
* ``anchor_groups``    number anchor rows and give every other row its nearest anchor
                       (forward or backward) in the same single pass.
* ``nearest_within``   existence of a partner within a bounded day window.

The first three scan rows in a total order. Instead of a window over the whole table (one
partition) or over one key (one task for a hot key), rows are range-partitioned on the
*full* sort key, so a hot key is spread over many partitions. Each partition is scanned
locally, and what a partition needs from the others is carried in through a summary of the
keys that cross a boundary: a partition's first and last key, so at most two rows per
partition, which are broadcast. The range partitioning is pinned
by writing it, with partition id and position recorded as columns, to a table in the
shared ``spark.checkpoint.dir`` folder, so ids and positions cannot change if tasks or
executors are re-run.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caresight.sources.tables import SHUFFLES_GO, scratch_folder, setting

_PID, _RID = "_scan_pid", "_scan_rid"


def _pinned_ranges(df: DataFrame, order: Sequence[Column], n: int | None,
                   range_on: Sequence[Column] | None = None) -> DataFrame:
    """Range-partition + sort on ``order``, record partition id and position as columns,
    and pin them by writing the result as a table in the shared checkpoint folder (one
    job, whose shuffle files go with it; later steps only read the recorded columns, never the physical layout). Without a
    width ``n`` AQE sizes the ranges by bytes."""
    spark = df.sparkSession
    path = scratch_folder(spark, "scan")
    keys = range_on or order
    ranged = df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)
    with setting(spark, SHUFFLES_GO, "true"):
        (ranged.sortWithinPartitions(*order)
           .withColumn(_PID, F.spark_partition_id())
           .withColumn(_RID, F.monotonically_increasing_id())
           .write.parquet(path))
    return spark.read.parquet(path)


def _crossing(summary: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of a summary per (partition, key) the rows of each partition's first and last key: rows are in
    order of the key, so no other key lies in two partitions."""
    key = F.struct(*by)
    edges = summary.groupBy(_PID).agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    return summary.join(F.broadcast(edges), _PID).where((key == F.col("_lo")) | (key == F.col("_hi"))).drop("_lo", "_hi")


def global_sequence(df: DataFrame, order: Sequence[Column | str], out: str = "seq",
                    num_partitions: int | None = None) -> DataFrame:
    """Dense 1..N numbering in ``order`` (which must be a total order) without a
    single-partition exchange.

    Position inside a partition comes from ``monotonically_increasing_id`` (partition id
    in the upper 31 bits, row index in the lower 33 bits); partition offsets are a running
    sum over one count per partition — a table bounded by the number of partitions.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = _pinned_ranges(df, order_cols, num_partitions)
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum("_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"))
    local = F.col(_RID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (ranged.join(F.broadcast(offsets), _PID)  # <= num_partitions rows
                  .withColumn(out, (F.col("_offset") + local + 1).cast("long"))
                  .drop(_PID, _RID, "_offset"))


def asof_join(left: DataFrame, anchors: DataFrame, by: Sequence[str], left_ts: str,
              anchor_ts: str, payload: Sequence[str], direction: str = "backward",
              tie_break: Sequence[str] = (), prefix: str = "",
              num_partitions: int | None = None) -> DataFrame:
    """Attach to every ``left`` row the anchor of the same ``by`` key with the latest
    ``anchor_ts <= left_ts`` (backward) or the earliest ``anchor_ts >= left_ts``
    (forward). Equal timestamps qualify. Among anchors with the same timestamp the one
    with the smallest ``tie_break`` values wins. Rows without an anchor keep NULLs.

    Output: all ``left`` columns plus ``prefix + c`` for ``anchor_ts`` and ``payload``.
    One range shuffle over left+anchors, no pairs are ever formed. As with a join on equality
    and a date difference, NULL keys and dates match nothing; such rows skip the shuffle.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction must be 'backward' or 'forward'")
    fwd = direction == "forward"
    lcols = left.columns
    known = F.lit(True)
    for c in (*by, left_ts):
        known = known & F.col(c).isNotNull()
    unmatched = left.where(~known)
    left = left.where(known)
    for c in (*by, anchor_ts):
        anchors = anchors.where(F.col(c).isNotNull())
    # Anchor ranking key: the best anchor is the max of (ts, -tie...) going backward and
    # the min of (ts, tie...) going forward; negating numeric tie-breaks keeps one rule.
    sign = 1 if fwd else -1
    rank_fields = [F.col(anchor_ts).alias("ts")] + [
        (F.col(t) * sign).alias(f"t{i}") for i, t in enumerate(tie_break)]
    anchor_struct = F.struct(*rank_fields, *[F.col(p).alias(f"p_{p}") for p in payload])

    # Left rows carry their whole record in one struct; anchors carry a NULL record.
    row_struct = F.struct(*[F.col(c) for c in lcols])
    row_type = left.select(row_struct.alias("r")).schema["r"].dataType
    a = anchors.select(*[F.col(b) for b in by], F.col(anchor_ts).alias("_ts"),
                       F.lit(0).alias("_tag"), anchor_struct.alias("_anchor"),
                       F.lit(None).cast(row_type).alias("_row"))
    lrows = left.select(*[F.col(b) for b in by], F.col(left_ts).alias("_ts"),
                        F.lit(1).alias("_tag"),
                        F.lit(None).cast(a.schema["_anchor"].dataType).alias("_anchor"),
                        row_struct.alias("_row"))
    both = a.unionByName(lrows)

    ts_order = F.col("_ts").desc() if fwd else F.col("_ts").asc()
    order = [*[F.col(b).asc() for b in by], ts_order, F.col("_tag").asc()]
    ranged = _pinned_ranges(both, order, num_partitions)

    best = F.min if fwd else F.max
    local_w = (Window.partitionBy(_PID, *by).orderBy(_RID)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    scanned = ranged.withColumn("_local", best("_anchor").over(local_w))

    # Carry-in: best anchor of each (partition, key) -- NULL where a partition holds only
    # rows of that key -- then the best over all earlier partitions of the same key.
    per_part = _crossing(ranged.groupBy(_PID, *by).agg(best("_anchor").alias("_p")), by)
    carry_w = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_part.select(_PID, *by, best("_p").over(carry_w).alias("_carry"))

    pick = F.least if fwd else F.greatest
    joined = (scanned.where(F.col("_tag") == 1)
                     .join(F.broadcast(carry), [_PID, *by], "left")  # two rows per partition at most
                     .withColumn("_hit", pick("_local", "_carry")))
    out = [F.col(f"_row.{c}").alias(c) for c in lcols]
    out += [F.col("_hit.ts").alias(prefix + anchor_ts)]
    out += [F.col(f"_hit.p_{p}").alias(prefix + p) for p in payload]
    kinds = {c: anchors.schema[c].dataType for c in (anchor_ts, *payload)}
    return joined.select(*out).unionByName(
        unmatched.select(*[F.col(c) for c in lcols], *[F.lit(None).cast(t).alias(prefix + c) for c, t in kinds.items()]))


def anchor_groups(df: DataFrame, by: Sequence[str], ts: str, tie: Sequence[str], is_anchor: Column,
                  look: Column, out: str = "group", num_partitions: int | None = None) -> DataFrame:
    """Number the anchor rows 1..N in (by, ts, *tie) order and give every other row the
    number of its nearest anchor of the same key, in one pinned range pass.

    ``look`` per row: ``'forward'`` takes the earliest anchor with ts >= own ts,
    ``'backward'`` the latest anchor with ts <= own ts (equal ts qualify; among anchors
    with the same ts the lowest number wins); NULL gives NULL. Anchors get their own
    number. A NULL key or ts matches nothing: such an anchor is numbered but never found, such a
    row gets NULL. Rows are range-partitioned on (by, ts), so rows sharing a key and ts stay in
    one partition and RANGE frames see all same-ts peers; a hot key spans many partitions
    and is carried across them by a broadcast summary of two rows per partition at most.
    """
    order = [*[F.col(b) for b in by], F.col(ts), *[F.col(t) for t in tie]]
    # a number says the direction: the rows are shuffled twice
    tagged = df.withColumn("_anchor", is_anchor).withColumn("_look", F.when(look == "forward", 1).when(look == "backward", -1))
    pinned = _pinned_ranges(tagged, order, num_partitions, range_on=[*[F.col(b) for b in by], F.col(ts)])
    # a task per range: dealt by hashes of their numbers, some tasks would get several
    dealt = pinned.repartitionById(num_partitions, F.col(_PID)) if num_partitions else pinned

    # 1. anchor numbers: partition offset + running count inside the partition
    counts = pinned.groupBy(_PID).agg(F.sum(F.col("_anchor").cast("long")).alias("_n"))
    offsets = counts.select(_PID, F.coalesce(F.sum("_n").over(
        Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    # the order of _RID, written out: the rows are then sorted for the look-up backward too
    running = F.sum(F.col("_anchor").cast("long")).over(
        Window.partitionBy(_PID).orderBy(*order, _RID).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = (dealt.join(F.broadcast(offsets), _PID)  # <= num_partitions rows
                .withColumn("_grp", F.when(F.col("_anchor"), F.col("_off") + running)))

    # 2. nearest anchors inside the partition. RANGE frames include same-ts peers; both
    #    directions use running frames (unbounded preceding .. current row), which Spark
    #    evaluates incrementally -- the forward look-up simply runs in descending ts order.
    known = F.col(ts).isNotNull()
    for b in by:
        known = known & F.col(b).isNotNull()
    back = F.when(F.col("_anchor") & known, F.struct(F.col(ts).alias("t"), (-F.col("_grp")).alias("g")))
    fwd = F.when(F.col("_anchor") & known, F.struct(F.col(ts).alias("t"), F.col("_grp").alias("g")))
    part = Window.partitionBy(_PID, *by)
    upto = (Window.unboundedPreceding, Window.currentRow)
    local = (numbered.withColumn("_lb", F.max(back).over(part.orderBy(F.col(ts).asc()).rangeBetween(*upto)))
             .withColumn("_lf", F.min(fwd).over(part.orderBy(F.col(ts).desc()).rangeBetween(*upto))))

    # 3. carry from earlier (backward) / later (forward) partitions of the same key
    per = _crossing(numbered.where(known).groupBy(_PID, *by).agg(F.max(back).alias("_pb"), F.min(fwd).alias("_pf")), by)
    before = (Window.unboundedPreceding, -1)
    carry = per.select(_PID, *by,
                       F.max("_pb").over(Window.partitionBy(*by).orderBy(F.col(_PID).asc()).rowsBetween(*before)).alias("_cb"),
                       F.min("_pf").over(Window.partitionBy(*by).orderBy(F.col(_PID).desc()).rowsBetween(*before)).alias("_cf"))
    j = local.join(F.broadcast(carry), [_PID, *by], "left")  # two rows per partition at most
    grp = (F.when(F.col("_anchor"), F.col("_grp"))
           .when(known & (F.col("_look") == -1), -F.greatest("_lb", "_cb")["g"])
           .when(known & (F.col("_look") == 1), F.least("_lf", "_cf")["g"]))
    return j.select(*[F.col(c) for c in df.columns], grp.cast("long").alias(out))


#: Days whose bits one number holds.
MASK_DAYS = 62


def _day_number(c: str) -> Column:
    return F.unix_date(F.to_date(F.col(c)))


def nearest_within(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str,
                   right_ts: str, lo_days: int, hi_days: int, out: str | None = None) -> DataFrame:
    """``left`` rows having a ``right`` row of the same key with
    ``lo_days <= days(right_ts) - days(left_ts) <= hi_days`` (a left-semi join); ``out`` names a
    column for the smallest such difference.

    The right side is reduced to the days per key and day bucket of width ``hi - lo + 1``, at most
    that many; a window [d+lo, d+hi] touches two neighbouring buckets, so
    each bucket also takes its successor's days and a left row probes one aggregated row by
    equality. A hot key is spread over its buckets, the aggregation is combined map-side, and no
    (left, right) pairs are formed. NULL keys and dates match nothing. Days of buckets of up to ``MASK_DAYS``
    are the bits of a number (of the successor the first day says all), those of wider ones a set.
    """
    width = hi_days - lo_days + 1
    if width <= 0:
        raise ValueError("empty window")
    bucket = F.floor(F.col("_d") / width)
    days = right.select(*by, _day_number(right_ts).alias("_d")).where(F.col("_d").isNotNull())
    lo = _day_number(left_ts) + lo_days
    probe = left.withColumn("_lo", lo).withColumn("_b", F.floor(F.col("_lo") / width)).where(F.col("_lo").isNotNull())
    if width <= MASK_DAYS:
        bit = F.expr(f"shiftleft(1L, cast(_d - _bucket * {width} as int))")
        own = F.struct(F.col("_bucket").alias("b"), bit.alias("near"), F.lit(None).cast("int").alias("next"))
        before = F.struct((F.col("_bucket") - 1).alias("b"), F.lit(0).cast("long").alias("near"), F.col("_d").alias("next"))
        days = (days.withColumn("_bucket", bucket).select(*by, F.explode(F.array(own, before)).alias("_day"))
                    .groupBy(*by, F.col("_day.b").alias("_b")).agg(F.bit_or("_day.near").alias("_near"), F.min("_day.next").alias("_next")))
        later = f"shiftright(_near, cast(_lo - _b * {width} as int))"
        first = F.expr(f"case when {later} <> 0 then _lo + bit_count(({later} & -{later}) - 1) else _next end")
    else:
        days = (days.distinct().select(*by, "_d", F.explode(F.array(bucket, bucket - 1)).alias("_b"))
                    .groupBy(*by, "_b").agg(F.collect_set("_d").alias("_near"), F.lit(None).cast("int").alias("_next")))
        first = F.array_min(F.filter("_near", lambda d: d >= F.col("_lo")))
    hit = (probe.join(days, [*by, "_b"]).withColumn("_first", first)
                .where(F.col("_first") <= F.col("_lo") + (width - 1)))
    if out:
        hit = hit.withColumn(out, F.col("_first") - F.col("_lo") + lo_days)
    return hit.drop("_lo", "_b", "_near", "_next", "_first")
