"""Sinks of micro-batches that can be repeated without harm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.failures import RETRY, classify_row_error, retry_delay_s, retry_exhausted
from tidelog.model import DEFAULT_BUFFER_CAPACITY, DEFAULT_MAX_ROWS, INSERT_ID, TableSpec
from tidelog.operators.chunks import row_chunks
from tidelog.operators.continuity import log_gaps, marks, require_unbroken
from tidelog.operators.images import cast_failures, missing_required, row_events
from tidelog.operators.positions import high_water
from tidelog.operators.transactions import SLICE_BYTES, assign_transaction, merge_hot_copies, transaction_fates, with_fates
from tidelog.session import broadcast_if_small
from tidelog.sinks.targets import delete_folders, existing, new_rows, read_or_none

BatchWriter = Callable[[DataFrame, int], None]

WRITTEN, QUARANTINE = "written", "quarantine"


def batch_folder(path: str, run: str, batch_id: int) -> str:
    return f"{path}/run={run}/batch_id={batch_id}"


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """All batches under a sink, with ``run`` and ``batch_id``; none before the first write."""
    full = T.StructType([*schema.fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
    return read_or_none(spark, path, full)


def idempotent_sink(path: str, run: str, prune: str, key: str = INSERT_ID, single: bool = False) -> BatchWriter:
    """Each micro-batch owns a folder in every day it has rows of, which a repeat of the batch replaces.

    Rows that any other batch holds are left out, so neither a restart nor a
    replay under a new checkpoint adds a row twice. ``run`` goes with the
    checkpoint: a new checkpoint counts its batches from 0 again. ``prune`` names
    a time column that is equal in every copy of a row, such as the event time of
    log rows. Days lie above batches, and only the days of a batch's own rows are
    listed and read, so the look-up does not grow with the batches before.
    ``single`` says that a batch itself repeats no row.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dated = batch.withColumn(DAY, F.coalesce(F.date_format(prune, "yyyy-MM-dd"), F.lit("none"))).persist()
        try:
            days = [r[0] for r in dated.select(DAY).distinct().collect()]
            others = read_days(spark, path, dated.schema, days)
            if others is not None:
                others = others.where(~((F.col("run") == run) & (F.col("batch_id") == batch_id)))
            fresh = new_rows(dated, others, key, prune, single=single)
            placed = fresh.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")})
            writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(DAY, "run", "batch_id").parquet(path)
        finally:
            dated.unpersist()

    return write


DAY = "_day"


def read_days(spark: SparkSession, path: str, schema: T.StructType, days: list[str]) -> DataFrame | None:
    """The batches of some days of an idempotent sink; no other folder is listed."""
    full = T.StructType([*schema.fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
    folders = existing(spark, [f"{path}/{DAY}={day}" for day in days])
    return spark.read.schema(full).option("basePath", path).parquet(*folders) if folders else None


def append_sink(path: str, run: str) -> BatchWriter:
    """Each micro-batch owns a folder; rows are taken as they come."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, run, batch_id))

    return write


def appended(path: str, run: str, schema: T.StructType) -> Callable[[SparkSession, int], DataFrame]:
    """Reads back what ``append_sink`` has kept of a micro-batch."""

    def read(spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(schema).parquet(batch_folder(path, run, batch_id))

    return read


def row_emitter(emit: Callable[[DataFrame, int], None]) -> BatchWriter:
    """A consumer of the caller's own; it gets each micro-batch and its number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        emit(batch, batch_id)

    return write


def row_outcomes(
    images: DataFrame, spec: TableSpec, typed: list[Column], attempt: Column, sink_errors: Column
) -> DataFrame:
    """Typed rows with their outcome: written, ignored, retry or quarantine.

    A value that does not fit its column and a missing required value are
    permanent errors, so ``typed`` must be lenient; ``sink_errors`` adds what the
    sink itself reports. A row whose tries are used up is set aside instead of
    tried again.
    """

    def invalid(text: str) -> Callable[[Column], Column]:
        return lambda c: F.struct(F.lit("invalid").alias("reason"), F.concat(F.lit(text), c).alias("message"))

    kept = [c for c in images.columns if c not in spec.column_names]
    rows = images.withColumn("_unfit", cast_failures(spec.columns)).select(*kept, "_unfit", *typed)
    checked = rows.withColumn(
        "errors",
        F.concat(
            sink_errors,
            F.transform("_unfit", invalid("value does not fit ")),
            # A value that does not fit is null by now and already reported.
            F.transform(F.array_except(missing_required(spec.columns), F.col("_unfit")), invalid("no value for ")),
        ),
    ).drop("_unfit")
    found = classify_row_error(F.col("errors"), F.lit(0), F.lit(1))
    outcome = (
        F.when(F.size("errors") == 0, F.lit(WRITTEN))
        .when(found == "permanent", F.lit(QUARANTINE))
        .when((found == RETRY) & retry_exhausted(attempt), F.lit(QUARANTINE))
        .otherwise(found)
    )
    return checked.withColumns({"outcome": outcome, "attempt": attempt, "retry_delay_s": retry_delay_s(attempt)})


def outcome_sink(path: str, run: str) -> BatchWriter:
    """Good, repeatable, ignored and set-aside rows in one write, a folder per outcome."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("outcome").parquet(batch_folder(path, run, batch_id))

    return write


RELEASED, HELD, DISCARDED, REACHED, FATES = "released", "held", "discarded", "reached", "fates"


def position_gate_sink(path: str, run: str, deliver: BatchWriter, slice_bytes: int = SLICE_BYTES) -> BatchWriter:
    """Commit gate for a log without transaction numbers: markers decide, batch by batch.

    Each micro-batch of routed events is joined by the events the batch before
    it held back. What is decided goes to ``deliver``; the events of a
    transaction that is still open are held in the batch's folder for the next
    one. Nothing is bound by time. A transaction never spans files, so one that
    is open when a later file has begun is settled as discarded and kept apart.

    The log must arrive in log order: an event at or before the highest position
    of an earlier batch ends the stream with an error, as its transaction may
    have been decided without it. Folders are dropped once two batches have
    followed, when no repeat can ask for them; discarded events stay.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events, here = batch, batch_folder(path, run, batch_id)
        reached = high_water(batch)
        if batch_id > 0:
            earlier = batch_folder(path, run, batch_id - 1)
            before = spark.read.schema(batch.schema).parquet(f"{earlier}/gate={HELD}")
            events = before.unionByName(batch)
            last = spark.read.schema(reached.schema).parquet(f"{earlier}/{REACHED}")
            _check_order(batch, last)
            reached = high_water(reached.unionByName(last).where(F.col("binlog_file").isNotNull()))
        reached.write.mode("overwrite").parquet(f"{here}/{REACHED}")
        newest = spark.read.schema(reached.schema).parquet(f"{here}/{REACHED}").first()["binlog_file"]
        assigned = assign_transaction(merge_hot_copies(events, slice_bytes), slice_bytes)
        abandoned = F.col("undecided") & (F.col("binlog_file") < F.lit(newest))
        gate = (
            F.when(abandoned, F.lit(DISCARDED)).when(F.col("undecided"), F.lit(HELD)).when(F.col("committed"), F.lit(RELEASED))
        )
        decided = assigned.withColumn("gate", gate).where(F.col("gate").isNotNull())
        for name in (RELEASED, HELD, DISCARDED):
            # An empty table keeps each folder readable.
            assigned.limit(0).write.mode("overwrite").parquet(f"{here}/gate={name}")
        decided.write.mode("append").partitionBy("gate").parquet(here)
        deliver(spark.read.schema(assigned.schema).parquet(f"{here}/gate={RELEASED}"), batch_id)
        if batch_id > 1:
            spent = batch_folder(path, run, batch_id - 2)
            delete_folders(spark, [f"{spent}/gate={RELEASED}", f"{spent}/gate={HELD}", f"{spent}/{REACHED}"])

    return write


def _check_order(batch: DataFrame, last: DataFrame) -> None:
    first = batch.agg(F.min(F.struct("binlog_file", "log_pos")).alias("p")).select("p.binlog_file", "p.log_pos").first()
    held = last.first()
    if None in (first[0], held["binlog_file"]) or (first[0], first[1]) > (held["binlog_file"], held["log_pos"]):
        return
    raise RuntimeError(f"the log is out of order: {first[0]}:{first[1]} came after {held['binlog_file']}:{held['log_pos']}")


def discarded_events(spark: SparkSession, path: str, run: str, schema: T.StructType) -> DataFrame:
    """Events of transactions that the position gate settled as discarded, over all batches."""
    return spark.read.schema(schema).parquet(f"{path}/run={run}/batch_id=*/gate={DISCARDED}")


MARKS_SCHEMA = "kind string, name string, reached bigint"


def continuity_sink(path: str, run: str, deliver: BatchWriter) -> BatchWriter:
    """Ends the stream with ``LogGap`` where a micro-batch does not go on right behind the one before.

    File numbers and each source's transaction numbers must have no hole, within
    a batch and between batches; a batch with a hole is not delivered. How far a
    batch reaches is kept in its folder, a row a file series and source, so a
    restart on the checkpoint checks the seam too. The two newest folders stay.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = read_or_none(spark, batch_folder(path, run, batch_id - 1), _struct(MARKS_SCHEMA)) if batch_id else None
        if batch_id and earlier is None:
            raise RuntimeError(f"batch {batch_id} of run {run} has no marks of the batch before it")
        require_unbroken(log_gaps(batch, earlier))
        deliver(batch, batch_id)
        now = marks(batch) if earlier is None else marks(batch).unionByName(earlier)
        now = now.groupBy("kind", "name").agg(F.max("reached").alias("reached"))
        now.coalesce(1).write.mode("overwrite").parquet(batch_folder(path, run, batch_id))
        if batch_id > 1:
            delete_folders(spark, [batch_folder(path, run, batch_id - 2)])

    return write


def _struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def capacity_gate_sink(path: str, run: str, deliver: BatchWriter, capacity: int = DEFAULT_BUFFER_CAPACITY) -> BatchWriter:
    """Commit gate bounded by the number of held row events, for events that carry ``txn_id``.

    A micro-batch is joined by what the one before it held. Rows of transactions
    with a COMMIT are delivered with ``committed`` true, and the transaction is
    forgotten. If the rows that are left reach ``capacity``, transactions are
    delivered as they are, with ``committed`` false, those of the fewest events
    first (ties: the least ``txn_id``), until fewer than ``capacity`` are left;
    what such a transaction still sends begins it anew. So a batch ends with
    fewer held events than the capacity, and with the files of one trigger that
    bounds what a batch works on. Held events lie in the batch's folder, beside
    what becomes of each transaction; a repeated batch starts from the same ones
    and decides the same. Delivered rows are written by ``deliver`` alone.
    """
    if capacity < 1:
        raise ValueError("the capacity must be positive")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, here = batch.sparkSession, batch_folder(path, run, batch_id)
        events = batch
        if batch_id:
            events = spark.read.schema(batch.schema).parquet(batch_folder(path, run, batch_id - 1) + f"/gate={HELD}").unionByName(batch)
        transaction_fates(events, capacity).write.mode("overwrite").parquet(f"{here}/{FATES}")
        shape = T.StructType([batch.schema["txn_id"], T.StructField("committed", T.BooleanType())])
        fates = spark.read.schema(shape).parquet(f"{here}/{FATES}")
        # Each held transaction has an event, so they are fewer than the capacity.
        waiting, _ = broadcast_if_small(fates.where(F.col("committed").isNull()).select("txn_id"))
        rows = row_events(events)
        held = rows.join(waiting, "txn_id", "left_semi").select(*batch.columns).unionByName(rows.where(F.col("txn_id").isNull()))
        held.write.mode("overwrite").parquet(f"{here}/gate={HELD}")
        deliver(with_fates(events, fates.where(F.col("committed").isNotNull()), "inner"), batch_id)
        if batch_id > 1:
            delete_folders(spark, [batch_folder(path, run, batch_id - 2)])

    return write


def held_events(spark: SparkSession, path: str, run: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """What the capacity gate still holds after a batch; ``flush`` of a run that ends."""
    return spark.read.schema(schema).parquet(batch_folder(path, run, batch_id) + f"/gate={HELD}")


# Rows that one task of the exact batches sorts.
PART_ROWS = 1_000_000


def exact_batch_sink(
    path: str, run: str, table: list[str], order: list[str], max_rows: int = DEFAULT_MAX_ROWS, part_rows: int = PART_ROWS
) -> BatchWriter:
    """Rows written in batches of exactly ``max_rows`` per table, whatever the trigger cuts.

    What is left over of a micro-batch goes in front of the next one. Full
    batches are numbered on from those before and lie under ``path``, a folder a
    micro-batch, with ``chunk_id``; ``flush_rest`` writes the short last ones.
    Rows arrive in order, so that a table's chunks are those of one long batch.
    A repeated micro-batch starts from the same rest and replaces its folder.
    A micro-batch is worked out once, to be counted, and sorted in parts of
    ``part_rows``, whatever its size: a stream has no adaptive parts.
    """

    size = max_rows if max_rows > 0 else DEFAULT_MAX_ROWS

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rest, done = _rest_folders(path, run, batch_id)
        taken = batch_folder(f"{path}/taken", run, batch_id)
        batch.write.mode("overwrite").parquet(taken)
        rows, written = spark.read.schema(batch.schema).parquet(taken), None
        if batch_id:
            before, counts = _rest_folders(path, run, batch_id - 1)
            rows = spark.read.schema(batch.schema).parquet(before).unionByName(rows)
            written = spark.read.parquet(counts)
        numbered = row_chunks(rows, table, order, size, -(-rows.count() // part_rows) or 1)
        delete_folders(spark, [taken])
        totals = numbered.groupBy(*table).agg((F.max("row_no") + 1).alias("_rows"))
        totals = totals.withColumn("_full", F.expr(f"_rows div {size}"))
        if written is None:
            written = totals.select(*table, F.lit(0).cast("bigint").alias("_done")).limit(0)
        totals = totals.join(written, table, "full_outer").select(
            *table, F.coalesce("_full", F.lit(0)).alias("_full"), F.coalesce("_done", F.lit(0)).alias("_done")
        )
        # One row a table; a table is a hot key of the join, so the side of the rows is not shuffled where that is small.
        small, _ = broadcast_if_small(totals)
        placed = numbered.join(small, table)
        full = placed.where(F.col("chunk_id") < F.col("_full")).withColumn("chunk_id", F.col("chunk_id") + F.col("_done"))
        full.select(*batch.columns, "chunk_id").write.mode("overwrite").parquet(batch_folder(f"{path}/full", run, batch_id))
        placed.where(F.col("chunk_id") >= F.col("_full")).select(*batch.columns).write.mode("overwrite").parquet(rest)
        totals.select(*table, (F.col("_done") + F.col("_full")).alias("_done")).coalesce(1).write.mode("overwrite").parquet(done)
        if batch_id > 1:
            delete_folders(spark, list(_rest_folders(path, run, batch_id - 2)))

    return write


def _rest_folders(path: str, run: str, batch_id: int) -> tuple[str, str]:
    return batch_folder(f"{path}/rest", run, batch_id), batch_folder(f"{path}/done", run, batch_id)


def flush_rest(spark: SparkSession, path: str, run: str, batch_id: int, table: list[str], schema: T.StructType) -> DataFrame:
    """The rows that wait for a full batch after micro-batch ``batch_id``, as each table's last, short chunk."""
    rest, done = _rest_folders(path, run, batch_id)
    rows, written = spark.read.schema(schema).parquet(rest), spark.read.parquet(done)
    return rows.join(F.broadcast(written), table).withColumn("chunk_id", F.col("_done")).select(*schema.fieldNames(), "chunk_id")


def full_batches(spark: SparkSession, path: str, run: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField("chunk_id", T.LongType())])
    return spark.read.schema(full).parquet(f"{path}/full/run={run}")
