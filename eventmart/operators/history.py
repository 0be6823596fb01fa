"""Type-2 history of changing entities."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.operators.incremental import of_keys
from eventmart.operators.joins import all_of, broadcast_if_small, null_safe_join
from eventmart.operators.merge import replace_keys
from eventmart.operators.ordering import HOT_ROWS, drop_chunks, neighbour, split_hot
from eventmart.schemas import AUDIT_COLUMNS
from eventmart.session import ensure_checkpoint_dir

BUCKET = "key_bucket"
BUCKETS = 64
# Column of a key's greatest sequence so far, in the state that goes with a history.
LAST = "last_sequence"


def _list(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    track: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Versions of each key with ``valid_from``, ``valid_to`` and ``is_current``.

    ``sequence_by`` orders a key's changes, most significant column first; that
    first column gives the validity times. ``track`` names the columns whose
    change makes a new version: by default all but keys, sequence and audit
    columns. Of several rows with the same key and sequence the greatest stays.
    """
    sequence = _list(sequence_by)
    fixed = [*keys, *sequence]
    rest = [c for c in changes.columns if c not in fixed]
    tracked = list(track) if track is not None else [c for c in rest if c not in AUDIT_COLUMNS]

    if rest:
        single = (
            changes.groupBy(*fixed)
            .agg(F.max(F.struct(*tracked, *[c for c in rest if c not in tracked])).alias("__row"))
            .select(*fixed, "__row.*")
        )
    else:
        single = changes.distinct()
    state = F.struct(*tracked)

    def versions(part: DataFrame) -> DataFrame:
        starts = (
            neighbour(part, sequence, state, "__before")
            .filter(F.col("__before").isNull() | ~state.eqNullSafe(F.col("__before")))
            .drop("__before")
        )
        following = F.struct(F.col(sequence[0]).alias("at"))
        return drop_chunks(neighbour(starts, sequence, following, "__after", following=True))

    parts = split_hot(single, keys, sequence, hot_rows, counted=changes)
    closed = reduce(DataFrame.unionByName, [versions(p) for p in parts])
    end = F.col("__after")["at"]
    return closed.select(
        *changes.columns,
        F.col(sequence[0]).alias("valid_from"),
        end.alias("valid_to"),
        end.isNull().alias("is_current"),
    )


def current_rows(history: DataFrame) -> DataFrame:
    """The open version of each key."""
    return history.filter(F.col("valid_to").isNull())


def rebuild_keys(
    target: DataFrame | None,
    staged: DataFrame,
    touched: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    track: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The history after the distinct ``touched`` keys are rebuilt from the staged changes."""
    rebuilt = scd2(of_keys(staged, touched, keys), keys, sequence_by, track, hot_rows)
    return rebuilt if target is None else replace_keys(target, rebuilt, touched, keys)


def scd2_apply(
    target: DataFrame | None,
    staged: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    track: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The history after a batch of changes, which may be late or repeated.

    The keys of the batch are rebuilt from the append-only ``staged`` changes,
    which already hold the batch. Doing it twice gives the same history.
    """
    touched = batch.select(*keys).distinct()
    return rebuild_keys(target, staged, touched, keys, sequence_by, track, hot_rows)


def sequence_state(changes: DataFrame, keys: Sequence[str], sequence_by: str | Sequence[str]) -> DataFrame:
    """Per key the greatest sequence among the changes: the state that lets later batches extend a history."""
    return changes.groupBy(*keys).agg(F.max(F.struct(*_list(sequence_by))).alias(LAST))


def _batch_keys(
    batch: DataFrame, target: DataFrame, state: DataFrame, keys: Sequence[str], sequence: Sequence[str]
) -> DataFrame:
    """The batch's keys with its greatest sequence, and ``__fine``: all its changes come after all that the key had.

    That is also asked of the open version, as a state may be older than the
    history if a run stopped between writing the two.
    """
    order = F.struct(*sequence)
    found = batch.groupBy(*keys).agg(
        F.min(order).alias("__first"),
        F.max(order).alias("__newest"),
        F.bool_or(reduce(Column.__or__, [F.col(c).isNull() for c in sequence])).alias("__gap"),
    )
    opened = current_rows(target).select(*keys, order.alias("__open"))
    joined = null_safe_join(null_safe_join(found, state.select(*keys, LAST), keys, "left"), opened, keys, "left")
    known = F.col(LAST).isNotNull() & F.col("__open").isNotNull()
    after = (F.col("__first") > F.col(LAST)) & (F.col("__first") > F.col("__open"))
    fresh = F.col(LAST).isNull() & F.col("__open").isNull()
    fine = ~F.col("__gap") & F.when(known, after).otherwise(fresh)
    return joined.select(*keys, "__newest", F.coalesce(fine, F.lit(False)).alias("__fine"))


def scd2_extend(
    target: DataFrame,
    state: DataFrame,
    staged: DataFrame | Callable[[], DataFrame],
    batch: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Sequence[str],
    track: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The history and its state after a batch of changes, which may be late or repeated.

    A key whose changes all come after what it had is extended: its open version
    and the batch are enough. Only keys with a late or repeated change, or with
    a null in the sequence, are rebuilt from the append-only ``staged`` changes,
    which already hold the batch; without such keys ``staged`` is not read (a
    callable is not called). Doing it twice gives the same result.
    """
    sequence = _list(sequence_by)
    ensure_checkpoint_dir(batch.sparkSession)
    found = broadcast_if_small(_batch_keys(batch, target, state, keys, sequence).checkpoint())
    fine, late = found.filter("__fine"), found.filter("not __fine")
    columns = [c for c in target.columns if c not in ("valid_from", "valid_to", "is_current")]

    opened = of_keys(current_rows(target), fine, keys)
    changes = opened.select(*columns).unionByName(of_keys(batch, fine, keys).select(*columns))
    made = scd2(changes, keys, sequence_by, track, hot_rows)
    renamed = fine.select(*[F.col(k).alias(f"__r_{k}") for k in keys])
    same = all_of([F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    kept = target.join(renamed, same & F.col("valid_to").isNull(), "left_anti")
    newest = fine.select(*keys, F.col("__newest").alias(LAST))
    if late.take(1):
        whole = of_keys((staged() if callable(staged) else staged).select(*columns), late, keys)
        made = made.unionByName(scd2(whole, keys, sequence_by, track, hot_rows))
        kept = null_safe_join(kept, late.select(*keys), keys, "left_anti")
        newest = newest.unionByName(sequence_state(whole, keys, sequence))
    history = kept.unionByName(made.select(*target.columns))
    return history, replace_keys(state, newest.select(*state.columns), found.select(*keys), keys)


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Adds the hash bucket of the key, the partition column of stored histories and marts.

    The key's text is hashed: the same number as int and as bigint must meet.
    """
    texts = [F.col(k).cast("string") for k in keys]
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*texts), F.lit(buckets)).cast("int"))
