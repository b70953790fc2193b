"""Sinks (SNK-01..SNK-06).

Writes go to Parquet (no lakehouse jars in this runtime). Replacing a date
range or a (dataset, month) set is done with dynamic partition overwrite, so
only the partitions present in the new batch are rewritten and no key list
is collected on the driver. Files are grouped per partition value with a
``rebalance`` hint, which lets AQE split a hot partition over several tasks
instead of sending a whole month to one task. Upserts and key replacements
rewrite only the months they touch (``swap_partitions``).
"""

from __future__ import annotations

import uuid
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart.functions.dates import period_int
from featuremart.operators.columns import add_prefix, to_val_columns, with_period
from featuremart.session import remove_folder, scratch_dir, staged


def new_location(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster)."""
    return f"{scratch_dir(spark, name)}/{uuid.uuid4().hex}"


def _rebalanced(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def save_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] | str,
                     strategy: str = "replace_range") -> str:
    """SNK-01: partitioned Parquet write.

    * ``replace_range``   - only the partitions present in ``df`` are replaced
                            (dynamic partition overwrite); history is kept.
    * ``replace_schema``  - the whole table is replaced (new schema allowed).
    * ``append``          - add files.
    """
    cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    w = _rebalanced(df, cols).write.partitionBy(*cols)
    if strategy == "replace_range":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif strategy == "replace_schema":
        w = w.mode("overwrite").option("partitionOverwriteMode", "static")
    elif strategy == "append":
        w = w.mode("append")
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    w.parquet(path)
    return path


def merge_by_keys(spark: SparkSession, existing: DataFrame | None, new: DataFrame,
                  keys: Sequence[str], out_path: str) -> DataFrame:
    """SNK-02: replace only the key sets (e.g. dataset, month) present in the
    new batch and keep every other row.

    Written as ``existing LEFT ANTI new-keys UNION new`` into a new location
    (reading and overwriting the same path is not safe). When the keys are
    the table's partition columns, ``save_partitioned(..., 'replace_range')``
    does the same in place.
    """
    if existing is None:
        merged = new
    else:
        kept = existing.join(new.select(*keys).distinct(), list(keys), "left_anti")
        merged = kept.unionByName(new, allowMissingColumns=True)
    merged.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def upsert_with_window_delete(target: DataFrame, source: DataFrame, keys: Sequence[str],
                              date_col: str, window_start, window_end, flag_col: str,
                              new_flag=False) -> DataFrame:
    """SNK-04: MERGE semantics without a lakehouse format.

    * key in both           -> target row kept (its values and flag kept)
    * key only in source    -> inserted with the source's values (columns the
                               source lacks are null) and ``new_flag``
    * key only in target    -> deleted when its date lies in the window,
                               kept otherwise
    One full outer join on the keys (one shuffle).
    """
    src_cols = [c for c in source.columns if c not in keys and c != flag_col]
    s = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in src_cols], F.lit(True).alias("__in_s"))
    t = target.withColumn("__in_t", F.lit(True))
    j = t.join(s, list(keys), "full")
    in_window = F.col(date_col).between(F.to_date(F.lit(window_start)), F.to_date(F.lit(window_end)))
    keep = F.col("__in_s").isNotNull() | ~F.coalesce(in_window, F.lit(False))
    inserted = F.col("__in_t").isNull()

    def value(c: str):
        if c in src_cols:
            return F.when(inserted, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c)
        return F.col(c)

    dated = [] if date_col in keys else [value(date_col)]
    other = [c for c in target.columns if c not in keys and c not in (date_col, flag_col)]
    return (j.where(keep).select(
        *keys, *dated, *[value(c) for c in other],
        F.when(inserted, F.lit(new_flag)).otherwise(F.col(flag_col)).alias(flag_col)))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a table's folder exists, asked of Spark's own file systems."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def drop_partition(spark: SparkSession, path: str, partition_col: str, value) -> None:
    """Remove one partition's folder through Spark's own file systems."""
    name = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
    remove_folder(spark, f"{path}/{partition_col}={name}")


def _in_partitions(partition_col: str, values: Sequence) -> Column:
    """Rows of the listed partitions; literal, so other folders are not opened."""
    listed = F.col(partition_col).isin([v for v in values if v is not None])
    return listed | F.col(partition_col).isNull() if None in values else listed


def swap_partitions(spark: SparkSession, path: str, partition_col: str, values: Sequence,
                    content: DataFrame) -> list[dict]:
    """Give the partitions ``values`` of a table the rows of ``content`` and
    leave the files of all others as they are.

    The new rows are staged first (``content`` may read the table itself), then
    put in place by dynamic partition overwrite; partitions left without rows
    are dropped. Run again after a lost driver, it ends in the same state.
    Returns the manifest: partition, rows and action of each.
    """
    new = staged(spark, content, "swap_partitions")
    counts = {r[0]: r[1] for r in new.groupBy(partition_col).count().collect()}  # a row per swapped partition
    if counts:
        save_partitioned(new, path, partition_col, "replace_range")
    manifest = []
    for v in values:
        if v not in counts:
            drop_partition(spark, path, partition_col, v)
        manifest.append({"partition": v, "rows": counts.get(v, 0), "action": "rewritten" if v in counts else "dropped"})
    return manifest


def merge_in_partitions(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str],
                        partition_col: str) -> list[dict]:
    """SNK-02 in place: replace the key sets present in ``new``; only the
    partitions that hold one of them, before or after, are rewritten.

    The old places of the keys are found by a semi-join that reads the key
    columns alone (not at all where the partition is one of the keys).
    """
    stored = spark.read.parquet(path)
    if dict(stored.dtypes)[partition_col] != dict(new.dtypes)[partition_col]:  # types of folder names are guessed
        stored = stored.withColumn(partition_col, F.col(partition_col).cast(new.schema[partition_col].dataType))
    new = staged(spark, new, "merge_new")
    touched = new.select(partition_col)
    if partition_col not in keys:
        hit = stored.select(*keys, partition_col).join(new.select(*keys).distinct(), list(keys), "left_semi")
        touched = touched.unionByName(hit.select(partition_col))
    values = [r[0] for r in touched.distinct().collect()]  # bounded by the number of partitions
    kept = stored.where(_in_partitions(partition_col, values)).join(new.select(*keys).distinct(), list(keys), "left_anti")
    return swap_partitions(spark, path, partition_col, values, kept.unionByName(new, allowMissingColumns=True))


def upsert_in_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], date_col: str,
                         window_start, window_end, flag_col: str, new_flag=False,
                         partition_col: str = "_particion") -> list[dict]:
    """SNK-04 in place, on a table partitioned by the month of ``date_col``
    (``with_period``): the rules of ``upsert_with_window_delete``, but only
    months that gain or lose a row are rewritten.

    Matched keys keep their stored row, so they touch nothing. New keys are
    found by an anti-join on the stored key columns, deletions by one on the
    window's months; both results are staged, and the months in them are the
    manifest. A key set with a null matches nothing, as in a MERGE.
    """
    stored = spark.read.parquet(path)
    lo, hi = F.to_date(F.lit(window_start)), F.to_date(F.lit(window_end))
    source = with_period(source, date_col, partition_col)
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema.fields
              if f.name not in source.columns and f.name != flag_col]
    inserted = source.join(stored.select(*keys), list(keys), "left_anti").select(
        "*", *absent, F.lit(new_flag).alias(flag_col)).select(*stored.columns)
    inserted = staged(spark, inserted, "upsert_inserted")
    window = stored.where(F.col(partition_col).between(period_int(lo), period_int(hi))).where(F.col(date_col).between(lo, hi))
    gone = staged(spark, window.join(source.select(*keys), list(keys), "left_anti").select(*keys, partition_col).distinct(),
                  "upsert_gone")
    values = [r[0] for r in inserted.select(partition_col).unionByName(gone.select(partition_col)).distinct().collect()]
    if not values:
        return []
    old = stored.where(_in_partitions(partition_col, values))
    lost = [old[k].eqNullSafe(gone[k]) for k in keys] + [old[date_col].between(lo, hi)]
    return swap_partitions(spark, path, partition_col, values, old.join(gone, lost, "left_anti").unionByName(inserted))


def rows_as_json(df: DataFrame, out_col: str = "json") -> DataFrame:
    """SNK-05 (re-aimed): one JSON document per row, built on the executors.

    The reference folds the whole table into one row before writing a single
    file; that puts every row through one task, so here each row becomes a
    JSON line and ``write.text``/``write.json`` stays distributed.
    """
    return df.select(F.to_json(F.struct(*df.columns)).alias(out_col))


def write_json_lines(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def document_columns(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """SNK-06: column comments as ``StructField.metadata`` (kept in the
    Parquet schema and by ``saveAsTable``)."""
    for c, text in comments.items():
        if c in df.columns:
            df = df.withMetadata(c, {**df.schema[c].metadata, "comment": text})
    return df


def document_table(spark: SparkSession, table: str, table_comment: str | None,
                   comments: dict[str, str]) -> None:
    """SNK-06 for catalog tables: comment only what changed."""
    current = {f.name: f.metadata.get("comment") for f in spark.table(table).schema.fields}
    if table_comment is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS {sql_str(table_comment)}")
    for c, text in comments.items():
        if c in current and current[c] != text:
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{c}` COMMENT {sql_str(text)}")


def sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def prepare_for_save(df: DataFrame, prefix: str | None, date_col: str,
                     keys: Iterable[str], gate: Callable[[DataFrame], DataFrame] | None = None
                     ) -> DataFrame:
    """SNK-03: the steps before a write, in order: domain prefix -> ``_val``
    decimals -> period int -> quality gate (a function that raises on STOP)."""
    out = add_prefix(df, prefix, keys) if prefix else df
    out = with_period(to_val_columns(out), date_col)
    if gate is not None:
        gate(out)
    return out
