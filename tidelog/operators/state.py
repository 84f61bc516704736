"""Current state of a target, and where two states differ.

A target is append-only: its rows are folded to the last image of each key. Two
states are compared by a hash tree over key ranges: leaves are ranges of keys
with a row count and an order-free checksum, each level above adds up its
children, and only children of nodes that differ are looked at. Rows are read
again for differing ranges only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.model import CDC_OPERATION, DELETE, INSERT_ID, METADATA_COLUMNS
from tidelog.operators.verify import row_checksum
from tidelog.session import broadcast_if_small, stage

# Keys of a leaf and children of a node.
LEAF_KEYS = 1_024
FANOUT = 64

CHANGED, MISSING, EXTRA = "changed", "missing", "extra"

# Fixed value: the text form of a log row's insert id.
_LOG_ID = r"^\((.*), (\d+)\):.*:(\d+)$"


def change_order(insert_id: str = INSERT_ID) -> Column:
    """Log order of a change row by its insert id; snapshot rows come before all log rows."""
    part = F.regexp_extract(insert_id, _LOG_ID, 1), F.regexp_extract(insert_id, _LOG_ID, 2), F.regexp_extract(insert_id, _LOG_ID, 3)
    in_log = F.col(insert_id).rlike(_LOG_ID)
    number = [F.when(in_log, p.cast("bigint")).otherwise(F.lit(-1)) for p in part[1:]]
    return F.struct(F.when(in_log, part[0]).otherwise(F.lit("")), *number)


def current_state(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The last image of each key by log order; keys whose last row is a DELETE are gone.

    Partial aggregation keeps one row a key and task, so a key that changes all
    the time costs no more than any other. An update that changes the key itself
    leaves the old key, as the log has after-images only.
    """
    columns = [c for c in rows.columns if c not in METADATA_COLUMNS and c not in (*key, INSERT_ID)]
    image = F.struct(F.col(CDC_OPERATION).alias("_op"), *(F.col(f"`{c}`") for c in columns))
    last = rows.groupBy(*(F.col(f"`{k}`") for k in key)).agg(F.max_by(image, change_order()).alias("_last"))
    return last.where(F.col("_last._op") != DELETE).select(*(F.col(f"`{k}`") for k in key), *(F.col(f"_last.`{c}`") for c in columns))


def leaf_of(key: str, leaf_keys: int = LEAF_KEYS) -> Column:
    """Range number of a whole-number key, floored, so that negative keys have ranges of their own."""
    return F.floor(F.col(f"`{key}`") / F.lit(leaf_keys)).cast("bigint")


def key_checksums(state: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Key and checksum of each row: all that a comparison reads of a state."""
    return state.select(F.col(f"`{key}`").alias("key"), row_checksum([key, *columns]).cast("decimal(38,0)").alias("checksum"))


def _counted(sums: DataFrame, by: Column) -> DataFrame:
    return sums.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum("checksum").alias("checksum"))


def leaves(state: DataFrame, key: str, columns: Sequence[str], leaf_keys: int = LEAF_KEYS) -> DataFrame:
    """Row count and checksum of each key range; a null key has the range null."""
    return _leaves(key_checksums(state, key, columns), leaf_keys)


def _leaves(sums: DataFrame, leaf_keys: int) -> DataFrame:
    return _counted(sums, leaf_of("key", leaf_keys).alias("node"))


def level_above(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    return nodes.groupBy(F.floor(F.col("node") / F.lit(fanout)).cast("bigint").alias("node")).agg(
        F.sum("n").alias("n"), F.sum("checksum").alias("checksum")
    )


def hash_tree(state: DataFrame, key: str, columns: Sequence[str], leaf_keys: int = LEAF_KEYS, fanout: int = FANOUT, depth: int = 3) -> list[DataFrame]:
    """The levels of the tree from the leaves up; the leaves are staged, as all levels are made from them."""
    return _tree(leaves(state, key, columns, leaf_keys), fanout, depth)


def _tree(leaves_: DataFrame, fanout: int, depth: int) -> list[DataFrame]:
    levels = [stage(leaves_, "leaves")]
    for _ in range(depth - 1):
        levels.append(level_above(levels[-1], fanout))
    return levels


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    a, b = left.alias("a"), right.alias("b")
    both = a.join(b, F.col("a.node").eqNullSafe(F.col("b.node")), "full_outer")
    same = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.checksum").eqNullSafe(F.col("b.checksum"))
    return both.where(~same).select(
        F.coalesce("a.node", "b.node").alias("node"),
        F.coalesce("a.n", F.lit(0)).alias("source_rows"),
        F.coalesce("b.n", F.lit(0)).alias("target_rows"),
    )


def differing_ranges(source: list[DataFrame], target: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Leaves that differ (node, source_rows, target_rows), found from the top down."""
    above = None
    for left, right in zip(reversed(source), reversed(target), strict=True):
        if above is not None:
            inside = F.floor(F.col("node") / F.lit(fanout)).cast("bigint").eqNullSafe(F.col("parent"))
            left, right = (side.join(above, inside, "left_semi") for side in (left, right))
        found = stage(_differing(left, right), "differing")
        above, _ = broadcast_if_small(found.select(F.col("node").alias("parent")))
    return found


def differing_rows(
    source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], leaf_keys: int = LEAF_KEYS, fanout: int = FANOUT, depth: int = 3
) -> DataFrame:
    """Keys at which two states differ: range_lo, range_hi, the key, and what is wrong with the target.

    ``changed`` rows have other values, ``missing`` ones are not in the target,
    ``extra`` ones not in the source. A key held more than once by a side is
    compared as a bag: it is ``changed`` where counts or values differ.
    """
    # A state may be costly to work out, and is looked at twice: it is worked out once, to two numbers a row.
    a, b = (stage(key_checksums(side, key, columns), "checksums") for side in (source, target))
    ranges = differing_ranges(*(_tree(_leaves(side, leaf_keys), fanout, depth) for side in (a, b)), fanout)
    wanted, _ = broadcast_if_small(ranges.select(F.col("node").alias("wanted")))

    def within(side: DataFrame) -> DataFrame:
        inside = side.join(wanted, leaf_of("key", leaf_keys).eqNullSafe(F.col("wanted")), "left_semi")
        return _counted(inside, F.col("key"))

    a, b = within(a).alias("a"), within(b).alias("b")
    both = a.join(b, F.col("a.key").eqNullSafe(F.col("b.key")), "full_outer")
    verdict = (
        F.when(F.col("b.n").isNull(), F.lit(MISSING))
        .when(F.col("a.n").isNull(), F.lit(EXTRA))
        .when((F.col("a.n") != F.col("b.n")) | (F.col("a.checksum") != F.col("b.checksum")), F.lit(CHANGED))
    )
    low = F.floor(F.coalesce("a.key", "b.key") / F.lit(leaf_keys)).cast("bigint") * leaf_keys
    return both.withColumn("verdict", verdict).where(F.col("verdict").isNotNull()).select(
        low.alias("range_lo"), (low + leaf_keys - 1).alias("range_hi"), F.coalesce("a.key", "b.key").alias(key), "verdict"
    )
