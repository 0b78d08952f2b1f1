"""Keyed upsert, delete and the change log that goes with them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierhouse.operators.ordered import neighbour
from tierhouse.operators.skew import HOT_ROWS


@dataclass(frozen=True)
class ChangeSpec:
    """How a table is keyed and what its change log watches.

    `update` lists the columns an update overwrites (the others only come with
    an insert); `watch` is the column whose old and new value is logged.
    """

    key: str
    watch: str
    update: Sequence[str]
    insert_action: str
    update_action: str
    delete_action: str
    stamp: str | None = None
    op: str = field(default="op")
    seq: str = field(default="seq")


# The students table of the change-log tutorial and its labels.
STUDENTS = ChangeSpec(
    key="student_id",
    watch="score",
    update=("score",),
    insert_action="INSERT_STUDENT",
    update_action="UPDATE_SCORE",
    delete_action="DELETE_STUDENT",
    stamp="updated_at",
)


def one_per_key(df: DataFrame, key: str, *also: str) -> DataFrame:
    """`df`, whose job fails if a key (not NULL) has several rows.

    The count runs over the partitioning that a join on the same columns needs
    anyway, so it costs no shuffle of its own.
    """
    many = F.count(F.lit(1)).over(Window.partitionBy(key, *also)) > 1
    error = F.raise_error(F.concat(F.lit(f"several source rows match {key} = "), F.col(key).cast("string")))
    return df.withColumn(key, F.when(many & F.col(key).isNotNull(), error.cast(df.schema[key].dataType)).otherwise(F.col(key)))


def _salted(df: DataFrame, key: str, side: str) -> DataFrame:
    # NULL keys match nothing, so their rows may go to any task; without the
    # salt a full outer join would send all of them to one.
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(salts))).otherwise(F.lit(0))
    return df.select(F.struct(*df.columns).alias(side), F.col(key).alias(f"{side}_key"), salt.alias(f"{side}_salt"))


def _matched(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Full outer match: struct columns `t` and `s`, NULL on the missing side. Fails on several source rows for a key."""
    t, s = _salted(target, key, "t"), one_per_key(_salted(source, key, "s"), "s_key", "s_salt")
    on = (F.col("t_key") == F.col("s_key")) & (F.col("t_salt") == F.col("s_salt"))
    return t.join(s, on, "full_outer").select("t", "s")


def merge_upsert(target: DataFrame, source: DataFrame, spec: ChangeSpec, run_ts: Column | None = None) -> DataFrame:
    """`target` with `source` merged in: new keys inserted, known keys updated and stamped.

    `source` holds one row per key, or the job fails (keep_latest() first if it
    may not), and the target's columns except the stamp. Which side a value
    comes from is decided by the match, not by NULL, so an update to NULL is
    kept. Applying the same source again changes nothing but the stamp, except
    that rows with a NULL key match nothing and are inserted each time.
    """
    in_t, in_s = F.col("t").isNotNull(), F.col("s").isNotNull()
    out = []
    for name in target.columns:
        if name == spec.stamp:
            out.append(F.when(in_s, run_ts).otherwise(F.col(f"t.{name}")).alias(name))
        elif name == spec.key or name not in spec.update:
            out.append(F.when(in_t, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}")).alias(name))
        else:
            out.append(F.when(in_s, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name))
    return _matched(target, source, spec.key).select(*out)


def _log(df: DataFrame, spec: ChangeSpec, action: Column, old: Column, new: Column, key: Column) -> DataFrame:
    data_type = df.schema["t"].dataType[spec.watch].dataType
    return df.select(
        key.alias(spec.key),
        action.alias("action_performed"),
        old.cast(data_type).alias(f"old_{spec.watch}"),
        new.cast(data_type).alias(f"new_{spec.watch}"),
    )


def change_log(target: DataFrame, source: DataFrame, spec: ChangeSpec) -> DataFrame:
    """What merging `source` would log: inserts, and updates that change the watched value."""
    both = _matched(target.select(spec.key, spec.watch), source.select(spec.key, spec.watch), spec.key)
    in_t, in_s = F.col("t").isNotNull(), F.col("s").isNotNull()
    old, new = F.col(f"t.{spec.watch}"), F.col(f"s.{spec.watch}")
    changed = in_s & (~in_t | ~old.eqNullSafe(new))
    action = F.when(in_t, spec.update_action).otherwise(spec.insert_action)
    return _log(both.where(changed), spec, action, old, new, F.col(f"s.{spec.key}"))


def snapshot_log(old_rows: DataFrame, new_rows: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Log of what turns one whole snapshot into another, deletes included."""
    both = _matched(old_rows.select(spec.key, spec.watch), new_rows.select(spec.key, spec.watch), spec.key)
    in_t, in_s = F.col("t").isNotNull(), F.col("s").isNotNull()
    old, new = F.col(f"t.{spec.watch}"), F.col(f"s.{spec.watch}")
    action = (
        F.when(~in_t, spec.insert_action)
        .when(~in_s, spec.delete_action)
        .when(~old.eqNullSafe(new), spec.update_action)
    )
    key = F.when(in_t, F.col(f"t.{spec.key}")).otherwise(F.col(f"s.{spec.key}"))
    logged = _log(both, spec, action, old, new, key)
    return logged.where(F.col("action_performed").isNotNull())


def delete_keys(target: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """`target` without the keys in `deleted`."""
    return target.join(deleted.select(key).distinct(), key, "left_anti")


def delete_log(target: DataFrame, deleted: DataFrame, spec: ChangeSpec) -> DataFrame:
    """One line per key asked for, also when it is absent (old value NULL then)."""
    asked = deleted.select(spec.key).distinct()
    held = target.select(F.col(spec.key).alias("_held"), F.col(spec.watch).alias("_old"))
    return asked.join(held, F.col(spec.key) == F.col("_held"), "left").select(
        spec.key,
        F.lit(spec.delete_action).alias("action_performed"),
        F.col("_old").alias(f"old_{spec.watch}"),
        F.lit(None).cast(target.schema[spec.watch].dataType).alias(f"new_{spec.watch}"),
    )


def update_where_matched(target: DataFrame, updates: DataFrame, spec: ChangeSpec, run_ts: Column) -> DataFrame:
    """Known keys updated and stamped, unknown ones ignored (UPDATE ... WHERE key = ...).

    Fails on several updates for one key.
    """
    side = one_per_key(updates, spec.key).select(
        F.col(spec.key).alias("_u_key"), *[F.col(c).alias(f"_u_{c}") for c in spec.update], F.lit(True).alias("_hit")
    )
    joined = target.join(side, F.col(spec.key) == F.col("_u_key"), "left")
    out = []
    for name in target.columns:
        if name == spec.stamp:
            out.append(F.when(F.col("_hit"), run_ts).otherwise(F.col(name)).alias(name))
        elif name in spec.update:
            out.append(F.when(F.col("_hit"), F.col(f"_u_{name}")).otherwise(F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return joined.select(*out)


def feed_log(target: DataFrame, feed: DataFrame, spec: ChangeSpec, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Log of an ordered feed of upserts and deletes, any number per key.

    `feed` has the key, the watched value, `op` ('upsert' or 'delete') and a
    unique `seq`. Each call sees the outcome of the key's previous call, or the
    target's row for the first one. Returns `seq` and the log columns.
    """
    k, w = spec.key, spec.watch
    data_type = target.schema[w].dataType
    state = F.struct(
        (F.col(spec.op) == "upsert").alias("alive"),
        F.when(F.col(spec.op) == "upsert", F.col(w)).cast(data_type).alias("value"),
    )
    chained = neighbour(
        feed.select(k, w, spec.op, spec.seq), [k], [F.col(spec.seq)], {"_prev": state}, "previous", hot_rows
    )
    held = target.select(F.col(k).alias("_held"), F.col(w).alias("_held_value"))
    joined = chained.join(held, F.col(k) == F.col("_held"), "left")
    first = F.col("_prev").isNull()
    alive = F.when(first, F.col("_held").isNotNull()).otherwise(F.col("_prev.alive"))
    old = F.when(alive, F.when(first, F.col("_held_value")).otherwise(F.col("_prev.value")))
    upsert = F.col(spec.op) == "upsert"
    new = F.when(upsert, F.col(w)).cast(data_type)
    action = (
        F.when(~upsert, spec.delete_action)
        .when(~alive, spec.insert_action)
        .when(~old.eqNullSafe(new), spec.update_action)
    )
    return joined.select(
        spec.seq, k, action.alias("action_performed"), old.alias(f"old_{w}"), new.alias(f"new_{w}")
    ).where(F.col("action_performed").isNotNull())


def apply_feed(target: DataFrame, feed: DataFrame, spec: ChangeSpec, run_ts: Column) -> DataFrame:
    """`target` after an ordered feed of upserts and deletes (see feed_log).

    `feed` also carries the insert-only columns. The last call per key decides,
    and a key that was deleted on the way takes its insert-only columns from
    the first upsert after that.
    """
    k, fixed = spec.key, [c for c in target.columns if c not in {spec.key, spec.stamp, *spec.update}]
    delete_seq = F.when(F.col(spec.op) == "delete", F.col(spec.seq))
    last = F.max_by(F.struct(spec.op, *spec.update), spec.seq)
    per_key = feed.groupBy(k).agg(F.max(delete_seq).alias("_cut"), last.alias("_last"))
    since_cut = F.col("_cut").isNull() | (F.col(spec.seq) > F.col("_cut"))
    born = (
        feed.where(F.col(spec.op) == "upsert")
        .join(per_key.select(k, "_cut"), k)
        .where(since_cut)
        .groupBy(k)
        .agg(F.min_by(F.struct(*fixed, F.lit(1).alias("_")), spec.seq).alias("_born"))
    )
    outcome = per_key.join(born, k, "left").select(k, "_cut", "_born", "_last.*")
    both = _matched(target, outcome, k)
    in_t, in_s = F.col("t").isNotNull(), F.col("s").isNotNull()
    fresh = in_s & (~in_t | F.col("s._cut").isNotNull())
    out = []
    for name in target.columns:
        if name == k:
            value = F.when(in_t, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))
        elif name == spec.stamp:
            value = F.when(in_s, run_ts).otherwise(F.col(f"t.{name}"))
        elif name in fixed:
            value = F.when(fresh, F.col(f"s._born.{name}")).otherwise(F.col(f"t.{name}"))
        else:
            value = F.when(in_s, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))
        out.append(value.alias(name))
    gone = in_s & (F.col(f"s.{spec.op}") == "delete")
    return both.where(~F.coalesce(gone, F.lit(False))).select(*out)
