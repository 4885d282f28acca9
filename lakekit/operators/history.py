"""Tables that keep their versions: plain Parquet folders, a base state now and then and change sets in between.

A job that knows its keys stores only the rows it changes, as they are afterwards, and the keys it deletes; a version without
keys is stored as a whole. A state is the newest base before it, without the rows of changed keys, plus those keys' latest rows.
When the changes since a base exceed a share of it, the next version is stored as a base too. A line in a small commits table
makes a version count, with its time, operation and number of rows. One writer per table.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.functions.columns import moment
from lakekit.operators.changes import as_feed, change_feed, rows_by_key, unique_rows, update_where
from lakekit.operators.joins import broadcast_if_small
from lakekit.sources.workspace import nothing_stored

VERSION_COLUMNS = ("_version", "_committed_at", "_operation")
# Changed rows since the last base, as a share of its rows, beyond which a version becomes a base.
REBASE_SHARE = 0.5


def states_path(path: str) -> str:
    """Base states, one folder per version that has one."""
    return f"{path}/states"


def changes_path(path: str) -> str:
    """Change sets, one folder per version that has one: the table's columns and `_deleted`."""
    return f"{path}/changes"


def commits_path(path: str) -> str:
    return f"{path}/commits"


COMMIT_FIELDS = (
    "_committed_at timestamp_ntz, _operation string, _rows bigint, _changed bigint, _based boolean, _keys array<string>, "
    "_schema string, _version int"
)


def _read(spark: SparkSession, folder: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("basePath", folder).parquet(folder)


def _write_base(df: DataFrame, path: str, version: int, operation: str, committed_at: datetime) -> None:
    stamped = df.select("*", moment(committed_at).alias("_committed_at"), F.lit(operation).alias("_operation"))
    stamped.write.mode("overwrite").parquet(f"{states_path(path)}/_version={version}")


def _commit(
    spark: SparkSession,
    path: str,
    version: int,
    operation: str,
    committed_at: datetime,
    rows: int,
    changed: int,
    based: bool,
    keys: Sequence[str],
    schema: T.StructType,
) -> None:
    """Store the commit line of a version."""
    line = spark.range(1).select(
        moment(committed_at).alias("_committed_at"),
        F.lit(operation).alias("_operation"),
        F.lit(rows).cast("long").alias("_rows"),
        F.lit(changed).cast("long").alias("_changed"),
        F.lit(based).alias("_based"),
        F.array(*[F.lit(k) for k in keys]).cast("array<string>").alias("_keys"),
        F.lit(schema.json()).alias("_schema"),
    )
    line.coalesce(1).write.mode("overwrite").parquet(f"{commits_path(path)}/_version={version}")


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, commits_path(path), COMMIT_FIELDS)


def _newest(spark: SparkSession, path: str, until: Column):
    """The newest commit that meets a condition, with the base its state starts from; None if there is none."""
    lines = _commits(spark, path).where(until).collect()
    if not lines:
        return None
    lines.sort(key=lambda c: c["_version"])
    base = [c for c in lines if c["_based"]][-1]
    return {"last": lines[-1], "base": base, "base_version": base["_version"], "sets": lines}


def write_version(
    df: DataFrame, path: str, version: int, operation: str, committed_at: datetime, keys: Sequence[str] = ()
) -> None:
    """Store a full state under a version number; writing the same number again replaces it.

    With keys, and if there is an earlier version, only what differs from that is stored: one full join of both states.
    """
    spark = df.sparkSession
    before = _newest_if_any(spark, path, version) if keys else None
    if before:
        state = _state(spark, path, before)
        _write_changes(_differences(state, df, keys), path, version, operation, committed_at, keys, before, state, REBASE_SHARE)
        return
    counted = Observation()
    whole = (unique_rows(df, keys) if keys else df).observe(counted, F.count(F.lit(1)).alias("rows"))
    _write_base(whole, path, version, operation, committed_at)
    _commit(spark, path, version, operation, committed_at, counted.get["rows"], counted.get["rows"], True, (), df.schema)


def _differences(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed rows with `_deleted`, and `_known` for keys that were there before."""
    rest = [c for c in after.columns if c not in keys]
    old, new = rows_by_key(before.select(*after.columns), keys, "_old"), rows_by_key(after, keys, "_new")
    changed = old.join(new, list(keys), "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
    columns = [F.col(c) if c in keys else F.col(f"_new.{c}").alias(c) for c in [*keys, *rest]]
    flags = [F.col("_new").isNull().alias("_deleted"), F.col("_old").isNotNull().alias("_known")]
    return changed.select(*columns, *flags).select(*after.columns, "_deleted", "_known")


def changes_between(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a state that are new or different, and the keys that are gone with `_deleted` set."""
    return _differences(before, after, keys).drop("_known")


def write_changes(
    changes: DataFrame,
    path: str,
    version: int,
    operation: str,
    committed_at: datetime,
    keys: Sequence[str],
    rebase_share: float = REBASE_SHARE,
) -> None:
    """Store a version as the rows that it changes: what is written follows the change, not the table.

    `changes` has the table's columns, and if rows are deleted a boolean `_deleted`; a key occurs once and is not NULL, or the
    job stops. Rows that are as before are allowed. The count of rows needs one look at the keys of the state before.
    """
    before = _newest_if_any(changes.sparkSession, path, version)
    if before is None:
        raise ValueError("the first version of a table must be a full state")
    if "_deleted" not in changes.columns:
        changes = changes.withColumn("_deleted", F.lit(False))
    state = _state(changes.sparkSession, path, before)
    _write_changes(unique_rows(changes, keys), path, version, operation, committed_at, keys, before, state, rebase_share)


def _write_changes(
    changes: DataFrame,
    path: str,
    version: int,
    operation: str,
    committed_at: datetime,
    keys: Sequence[str],
    before,
    state: DataFrame,
    rebase_share: float,
) -> None:
    spark = changes.sparkSession
    folder = f"{changes_path(path)}/_version={version}"
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    passed = F.when(known, F.lit(True)).otherwise(F.raise_error(F.lit("a key is NULL")).cast("boolean"))
    gone = F.coalesce("_deleted", F.lit(False))
    counted = Observation()
    measures = [F.count(F.lit(1)).alias("changed"), F.count_if(~gone).alias("set")]
    if "_known" in changes.columns:
        measures += [F.count_if(gone & F.col("_known")).alias("gone"), F.count_if(~gone & F.col("_known")).alias("there")]
    stored_columns = changes.where(passed).observe(counted, *measures).select(*state.columns, gone.alias("_deleted"))
    stored_columns.write.mode("overwrite").parquet(folder)
    stored = spark.read.schema(stored_columns.schema).parquet(folder)
    counts = counted.get
    if "_known" not in changes.columns:
        found = state.select(*keys).join(broadcast_if_small(stored.select(*keys, "_deleted")), list(keys))
        there = found.agg(F.count_if("_deleted").alias("gone"), F.count_if(~F.col("_deleted")).alias("there")).first()
        counts = {**counts, **there.asDict()}
    since = counts["changed"] + sum(s["_changed"] for s in before["sets"] if s["_version"] > before["base_version"])
    based = since > rebase_share * max(1, before["base"]["_rows"])
    if based:
        _write_base(_changed_state(state, stored, keys), path, version, operation, committed_at)
    rows = before["last"]["_rows"] + counts["set"] - counts["there"] - counts["gone"]
    _commit(spark, path, version, operation, committed_at, rows, counts["changed"], based, keys, state.schema)


def update_version(
    spark: SparkSession,
    path: str,
    condition: Column,
    values: Mapping[str, Column],
    operation: str,
    committed_at: datetime,
    keys: Sequence[str],
) -> int:
    """Give the rows that meet a condition new values, as the next version; returns its number."""
    version = last_version(spark, path) + 1
    touched = snapshot_as_of(spark, path, version - 1).where(condition)
    write_changes(update_where(touched, F.lit(True), values), path, version, operation, committed_at, keys)
    return version


def _newest_if_any(spark: SparkSession, path: str, version: int):
    """The newest commit before a version."""
    if version <= 0:
        return None
    try:
        return _newest(spark, path, F.col("_version") < version)
    except AnalysisException as error:
        if not nothing_stored(error):
            raise
        return None


def _changed_state(state: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A state after a change set with one row per key."""
    kept = state.join(broadcast_if_small(latest.select(*keys)), list(keys), "left_anti")
    return kept.unionByName(latest.where(~F.col("_deleted")).select(*state.columns))


def _fields(commit) -> T.StructType:
    return T.StructType.fromJson(json.loads(commit["last"]["_schema"]))


def _base(spark: SparkSession, path: str, version: int, fields: T.StructType) -> DataFrame:
    states = _read(spark, states_path(path), T.StructType([*fields, T.StructField("_version", T.IntegerType())]))
    return states.where(F.col("_version") == F.lit(version)).drop("_version")


def _change_sets(spark: SparkSession, path: str, first: int, last: int, fields: T.StructType) -> DataFrame:
    added = [T.StructField("_deleted", T.BooleanType()), T.StructField("_version", T.IntegerType())]
    sets = _read(spark, changes_path(path), T.StructType([*fields, *added]))
    return sets.where(F.col("_version").between(first, last))


def _state(spark: SparkSession, path: str, commit) -> DataFrame:
    """The state of a commit: its base alone, or with the latest row of each key that has changed since."""
    base, last, keys = commit["base_version"], commit["last"]["_version"], commit["last"]["_keys"]
    state = _base(spark, path, base, _fields(commit))
    if base == last:
        return state
    newest = Window.partitionBy(*keys).orderBy(F.desc("_version"))
    changed = _change_sets(spark, path, base + 1, last, _fields(commit)).withColumn("_newest", F.row_number().over(newest))
    return _changed_state(state, changed.where("_newest = 1").drop("_newest", "_version"), keys)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All states with their version columns. States that are stored as changes are put together one by one."""
    commits = _commits(spark, path).select(*VERSION_COLUMNS, "_based").orderBy("_version").collect()
    based = [c["_version"] for c in commits if c["_based"]]
    fields = _fields(_newest(spark, path, F.lit(True)))
    stamps = [("_committed_at", T.TimestampNTZType()), ("_operation", T.StringType()), ("_version", T.IntegerType())]
    stored = _read(spark, states_path(path), T.StructType([*fields, *[T.StructField(*x) for x in stamps]]))
    parts = [stored.where(F.col("_version").isin(based))]
    for c in commits:
        if not c["_based"]:
            values = (moment(c["_committed_at"]), F.lit(c["_operation"]), F.lit(c["_version"]))
            added = {name: value for (name, _), value in zip(stamps, values, strict=True)}
            parts.append(snapshot_as_of(spark, path, c["_version"]).withColumns(added))
    return reduce(DataFrame.unionByName, parts)


def snapshot_history(spark: SparkSession, path: str) -> DataFrame:
    """Version, time, operation and rows of every commit."""
    return _commits(spark, path).select(
        F.col("_version").cast("int").alias("version"),
        F.col("_committed_at").alias("committed_at"),
        F.col("_operation").alias("operation"),
        F.col("_rows").alias("num_rows"),
    )


def last_version(spark: SparkSession, path: str) -> int:
    """Number of the newest version; one small aggregation over the commits."""
    return snapshot_history(spark, path).agg(F.max("version")).first()[0]


def snapshot_as_of(
    spark: SparkSession, path: str, version: int | None = None, at: datetime | None = None
) -> DataFrame:
    """The state of one version, or the one that was current at a moment; without rows if there was none.

    Read are one base folder and the change sets after it. The base isn't shuffled as long as the changed keys are small.
    """
    if (version is None) == (at is None):
        raise ValueError("give a version or a moment")
    until = F.col("_committed_at") <= moment(at) if version is None else F.col("_version") <= version
    commit = _newest(spark, path, until)
    if commit is None or (version is not None and commit["last"]["_version"] != version):
        return spark.createDataFrame([], _fields(commit or _newest(spark, path, F.lit(True))))
    return _state(spark, path, commit)


def snapshot_compare(spark: SparkSession, path: str, versions: Sequence[int], *measures: Column) -> DataFrame:
    """The same measures over several versions, one row each; versions without rows have none."""
    states = [snapshot_as_of(spark, path, v).withColumn("version", F.lit(v).cast("int")) for v in versions]
    return reduce(DataFrame.unionByName, states).groupBy("version").agg(*measures)


def snapshot_restore(spark: SparkSession, path: str, version: int, committed_at: datetime) -> int:
    """Make an old state current again by storing it as a new version; returns its number.

    If only change sets lie in between, the new version is a change set too: the keys they touched, as they were.
    """
    restored = last_version(spark, path) + 1
    operation = f"RESTORE {version}"
    between = _commits(spark, path).where(F.col("_version") > version).select("_keys").distinct().collect()
    state = snapshot_as_of(spark, path, version)
    if len(between) != 1 or not between[0]["_keys"]:
        write_version(state, path, restored, operation, committed_at)
        return restored
    keys = between[0]["_keys"]
    touched = _change_sets(spark, path, version + 1, restored - 1, state.schema).select(*keys).distinct()
    there = state.join(broadcast_if_small(touched), keys, "left_semi").withColumn("_deleted", F.lit(False))
    gone = touched.join(there.select(*keys), keys, "left_anti").withColumn("_deleted", F.lit(True))
    write_changes(there.unionByName(gone, allowMissingColumns=True), path, restored, operation, committed_at, keys)
    return restored


def change_feed_range(spark: SparkSession, path: str, keys: Sequence[str], first: int, last: int) -> DataFrame:
    """Changes made by the versions first..last.

    Versions stored as change sets give their feed from these alone: only their keys are looked up in the base before, and
    the row before a change is the key's last one. A version stored as a whole is set against the state before it.
    """
    commits = (
        _commits(spark, path).where(F.col("_version").between(first, last)).orderBy("_version").collect()
    )
    parts, run = [], []
    for c in commits:
        if c["_keys"] and list(c["_keys"]) == list(keys):
            run.append(c)
            continue
        if run:
            parts.append(_feed_of_sets(spark, path, keys, run))
            run = []
        before, after = (snapshot_as_of(spark, path, v) for v in (c["_version"] - 1, c["_version"]))
        parts.append(change_feed(before, after, keys, c["_version"], c["_committed_at"]))
    if run:
        parts.append(_feed_of_sets(spark, path, keys, run))
    if not parts:
        nothing = spark.createDataFrame([], _fields(_newest(spark, path, F.lit(True))))
        return change_feed(nothing, nothing, keys, first, datetime(1970, 1, 1))
    return reduce(DataFrame.unionByName, parts)


def _feed_of_sets(spark: SparkSession, path: str, keys: Sequence[str], run: Sequence) -> DataFrame:
    """Feed of consecutive versions that are change sets."""
    first, last = run[0]["_version"], run[-1]["_version"]
    before = _newest(spark, path, F.col("_version") < first)
    base, fields = before["base_version"], _fields(before)
    sets = _change_sets(spark, path, base + 1, last, fields)
    wanted = broadcast_if_small(sets.where(F.col("_version") >= first).select(*keys).distinct())
    state = _base(spark, path, base, fields)
    columns = list(state.columns)
    payload = [c for c in columns if c not in keys]
    row = F.struct(*payload) if payload else F.struct(F.lit(True).alias("_present"))
    images = (
        state.join(wanted, list(keys), "left_semi")
        .select(*keys, F.lit(base).alias("_version"), row.alias("_row"))
        .unionByName(
            sets.join(wanted, list(keys), "left_semi").select(
                *keys, "_version", F.when(~F.col("_deleted"), row).alias("_row")
            )
        )
    )
    by_key = Window.partitionBy(*keys).orderBy("_version")
    changed = (
        images.select(*keys, "_version", F.lag("_row").over(by_key).alias("_old"), F.col("_row").alias("_new"))
        .where(F.col("_version").between(first, last))
        .where(~F.col("_old").eqNullSafe(F.col("_new")))
    )
    times = F.create_map(*[x for c in run for x in (F.lit(c["_version"]), moment(c["_committed_at"]))])
    return as_feed(changed, keys, columns, F.col("_version"), times[F.col("_version")])
