"""Writers: namespaces, table replace, partitioned layout, compaction, JDBC, alert messages.

Streaming writers are idempotent per micro-batch: a replayed ``batch_id`` overwrites its own
partition instead of appending a second copy.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpguard.schemas import ALERT_KEY


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """CREATE NAMESPACE IF NOT EXISTS (no-op when present)."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def replace_table(df: DataFrame, name: str, v2: bool = False) -> None:
    """Full rebuild. ``v2=True`` uses ``writeTo().createOrReplace()`` (atomic on a v2 catalog such
    as Iceberg); otherwise the new content is written to a table beside the old one, which is
    replaced by renaming only after that write succeeded."""
    if v2:
        df.writeTo(name).createOrReplace()
        return
    spark, staged, old = df.sparkSession, f"{name}__staging", f"{name}__old"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(old):
        _rename_table(spark, old, name)     # an earlier run stopped between its two renames
    _clear_table(spark, staged)
    df.write.saveAsTable(staged)
    had = spark.catalog.tableExists(name)
    _clear_table(spark, old)
    if had:
        _rename_table(spark, name, old)
    else:                                   # a folder without a table must not take its place
        fs, left = _folder(spark, _table_folder(spark, name))
        if fs.exists(left):
            _rename(fs, left, _folder(spark, _table_folder(spark, old))[1])
    try:
        _rename_table(spark, staged, name)
    except Exception:
        if had:
            _rename_table(spark, old, name)
        raise
    _clear_table(spark, old)


def _table_folder(spark: SparkSession, name: str) -> str:
    """Where the session catalog puts a managed table of this name."""
    *database, table = name.split(".")
    root = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase())
    return f"{root.locationUri.rstrip('/')}/{table.lower()}"


def _clear_table(spark: SparkSession, name: str) -> None:
    """Drop a table and the folder that a failed write may have left without one."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    fs, folder = _folder(spark, _table_folder(spark, name))
    fs.delete(folder, True)


def _rename_table(spark: SparkSession, a: str, b: str) -> None:
    spark.sql(f"ALTER TABLE {a} RENAME TO {b}")


def _folder(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _rename(fs, a, b) -> None:
    if not fs.rename(a, b):
        raise OSError(f"could not rename {a} to {b}")


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def switch_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put the finished folder ``staged`` in the place of ``path``. The old folder is moved aside
    first and deleted last; when the second move fails it is moved back, and when a run was stopped
    between the two, the next one starts by moving it back."""
    fs, new = _folder(spark, staged)
    target = _folder(spark, path)[1]
    old = _folder(spark, f"{path.rstrip('/')}__old")[1]
    if not fs.exists(target) and fs.exists(old):
        _rename(fs, old, target)            # an earlier run stopped between its two renames
    fs.delete(old, True)
    had = fs.exists(target)
    if had:
        _rename(fs, target, old)
    try:
        _rename(fs, new, target)
    except Exception:
        if had:
            _rename(fs, old, target)
        raise
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def switch_days(spark: SparkSession, staged: str, path: str, column: str,
                days: tuple[str, str]) -> None:
    """Replace the day folders ``column=first .. last`` of ``path`` by those of ``staged``.

    Old days are moved aside, deleted last, and moved back when a step fails. A run that is killed
    in between leaves them in ``path__old_days``; the next switch, or ``restore_days``, brings the
    old layer back as it was."""
    restore_days(spark, path)
    fs, new = _folder(spark, staged)
    target, aside = _folder(spark, path)[1], _folder(spark, _aside(path))[1]
    Path, prefix = spark._jvm.org.apache.hadoop.fs.Path, f"{column}="
    fs.mkdirs(target)

    def folders(root) -> dict:
        found = {s.getPath().getName(): s.getPath() for s in fs.listStatus(root)}
        return {n: d for n, d in found.items() if n.startswith(prefix)}

    def inside(name: str) -> bool:
        return days[0] <= name[len(prefix):] <= days[1]
    fresh = folders(new)
    if not all(map(inside, fresh)):
        raise ValueError(f"{staged} holds days outside {days[0]} .. {days[1]}")
    for name in fresh:          # the names that come in, for a restore
        fs.mkdirs(Path(aside, _COMES + name))
    fs.mkdirs(aside)
    try:
        for name, d in folders(target).items():
            if inside(name):
                _rename(fs, d, Path(aside, name))
        fs.mkdirs(Path(aside, _MOVED))      # from here on these names in the target are new
        for name, d in fresh.items():
            _rename(fs, d, Path(target, name))
        _rename(fs, aside, _folder(spark, f"{_aside(path)}_done")[1])  # the new days count
    except Exception:
        restore_days(spark, path)
        raise
    fs.delete(_folder(spark, f"{_aside(path)}_done")[1], True)
    fs.delete(new, True)
    spark.catalog.refreshByPath(path)


_COMES, _MOVED = "_comes-", "_moved"


def _aside(path: str) -> str:
    return f"{path.rstrip('/')}__old_days"


def restore_days(spark: SparkSession, path: str) -> bool:
    """Bring back the days of a switch that stopped halfway (True), or find nothing to do. May
    itself be stopped and called again."""
    fs, aside = _folder(spark, _aside(path))
    fs.delete(_folder(spark, f"{_aside(path)}_done")[1], True)
    if not fs.exists(aside):
        return False
    target, Path = _folder(spark, path)[1], spark._jvm.org.apache.hadoop.fs.Path
    names = [s.getPath().getName() for s in fs.listStatus(aside)]
    if _MOVED in names:         # new days may be in: they go before any old one is back
        for name in names:
            if name.startswith(_COMES):
                fs.delete(Path(target, name[len(_COMES):]), True)
        fs.delete(Path(aside, _MOVED), True)
    for name in names:
        if not name.startswith("_"):
            _rename(fs, Path(aside, name), Path(target, name))
    fs.delete(aside, True)
    spark.catalog.refreshByPath(path)
    return True


def with_event_date(df: DataFrame, ts_col: str = "event_ts") -> DataFrame:
    return df.withColumn("event_date", F.to_date(F.col(ts_col)))


def _salt(df: DataFrame, n: int | Column) -> Column:
    """A stable spread value in [0, n) from the row's content (reruns land rows identically)."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), n if isinstance(n, Column)
                  else F.lit(n))


def write_partitioned(df: DataFrame, path: str | None = None, table: str | None = None,
                      ts_col: str = "event_ts", bucket_col: str | None = None,
                      buckets: int = 64, mode: str = "overwrite",
                      max_records_per_file: int = 5_000_000) -> None:
    """Day-partitioned layout (``event_date``), optionally bucketed by ``bucket_col``.

    Rows are rebalanced by day before the write: adaptive execution splits a large day over as
    many tasks as its bytes need (``advisoryPartitionSizeInBytes`` each) and puts small days
    together, so a day is never written by one task alone nor by every task. A file is capped
    at ``max_records_per_file`` rows. Bucketing needs a
    catalog table (``table``); later joins/aggregations on ``bucket_col`` then skip the
    shuffle."""
    out = with_event_date(df, ts_col)
    if bucket_col is None:
        out = out.hint("rebalance", F.col("event_date"))
    w = (out.write.mode(mode).partitionBy("event_date")
         .option("maxRecordsPerFile", max_records_per_file))
    if table:
        if bucket_col:
            w = w.bucketBy(buckets, bucket_col).sortBy(bucket_col)
        w.saveAsTable(table)
    else:
        w.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str = "request_id", buckets: int = 512,
                   mode: str = "overwrite") -> None:
    """A catalog table hash-bucketed (and sorted) on ``key``. Tables bucketed alike on the
    same key join and aggregate on it without a shuffle: the Bronze tables bucketed on
    ``request_id`` give a Silver build with no exchange at all."""
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def compact(spark: SparkSession, path: str, target_path: str | None = None,
            rows_per_file: int = 5_000_000, partition_col: str = "event_date",
            where: str | None = None) -> str:
    """Rewrite a (streamed, small-file) partitioned directory into right-sized files.

    Same rows. Each partition value gets ceil(rows / ``rows_per_file``) files: the per-value
    row counts come from one aggregate (a row per partition value), and rows are spread over
    their value's files by a content hash. Only the selected partitions (``where``) are
    rewritten; dynamic partition overwrite leaves the others untouched. A folder that a stream
    writes keeps a log of its files, which a rewrite in place would break: such a folder needs a
    separate ``target_path``."""
    in_place = target_path is None or target_path.rstrip("/") == path.rstrip("/")
    if in_place and folder_exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{path} is written by a stream: compact it to another target_path")
    df = spark.read.parquet(path)
    if where:
        df = df.filter(where)
    cols = df.columns
    per_value = (df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("_rows"))
                 .select(F.col(partition_col).alias("_value"), F.greatest(F.lit(1), F.ceil(F.col("_rows")
                                                                    / F.lit(rows_per_file)))
                         .cast("int").alias("_files")))
    sized = df.join(per_value, F.col(partition_col).eqNullSafe(F.col("_value")), "left")
    out = (sized.repartition(partition_col, _salt(df, F.col("_files")).alias("_s"))
           .select(*cols))
    dest = target_path or path
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(dest))
    return dest


def to_alert_messages(alerts: DataFrame, key_cols: Sequence[str] = ALERT_KEY) -> DataFrame:
    """Alerts as (key, value) for the alerts topic: key = the alert's identity, value = JSON of
    the whole row (timestamps as ISO text with microseconds)."""
    text = {}
    for f in alerts.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        text[f.name] = c
    cols = [c.alias(n) for n, c in text.items()]
    present = [k for k in key_cols if k in alerts.columns]
    key = F.concat_ws("|", *[F.coalesce(text[k].cast("string"), F.lit("")) for k in present])
    body = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return alerts.select(key.alias("key"), body.alias("value"))


def publish(messages: DataFrame, topic: str, bootstrap: str | None = None,
            path: str | None = None) -> None:
    """Batch publish (key, value) to Kafka, or to JSON files when no broker is configured."""
    if bootstrap:
        (messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("topic", topic).save())
    else:
        messages.write.mode("append").json(f"{path.rstrip('/')}/{topic}")


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", batchsize: int = 10_000, partitions: int | None = None,
               column_types: str = "") -> None:
    """Executor-side JDBC write (each task opens its own connection; nothing goes through the
    driver). ``partitions`` caps concurrent connections."""
    out = df.coalesce(partitions) if partitions else df
    writer = out.write.mode(mode).option("batchsize", batchsize)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    (writer
     .jdbc(url, table, properties=dict(properties or {})))


def delete_batch(spark: SparkSession, url: str, table: str, batch_id: int,
                 properties: dict | None = None) -> None:
    """Remove the rows of one micro-batch from a table, if it exists (before a replayed batch
    writes them again)."""
    delete_rows(spark, url, table, "batch_id", int(batch_id), properties)


def delete_rows(spark: SparkSession, url: str, table: str, column: str, value: int | str,
                properties: dict | None = None) -> None:
    """Remove the rows of a table, if it exists, whose ``column`` is ``value``."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        plain = table.split(".")[-1].strip('"')
        found = any(connection.getMetaData().getTables(None, None, name, None).next()
                    for name in {plain, plain.upper(), plain.lower()})
        if found:
            quote = connection.getMetaData().getIdentifierQuoteString().strip()  # as Spark writes it
            text = str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"
            connection.createStatement().executeUpdate(
                f"DELETE FROM {table} WHERE {quote}{column}{quote} = {text}")
            if not connection.getAutoCommit():
                connection.commit()
    finally:
        connection.close()


def alerts_only(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("severity") != "low")


@dataclass
class AlertSink:
    """Where alerts go. ``kind``: 'parquet' (path, partitioned by batch_id) or 'jdbc' (rows carry
    batch_id). Both are idempotent on replay: a batch first removes what it wrote before.
    ``all_versions`` keeps rows of severity low too, so that an alert that falls back to low
    replaces its earlier version when the versions are merged (``latest_alerts``)."""

    kind: str = "parquet"
    path: str = ""
    url: str = ""
    table: str = "fraud_alerts"
    properties: dict = field(default_factory=dict)
    all_versions: bool = False
    topic: str = ""                 # also publish each alert as (key, JSON) to this topic ...
    topic_bootstrap: str = ""       # ... on Kafka
    topic_path: str = ""            # ... or as JSON files (offline), per batch id

    def write(self, alerts: DataFrame, batch_id: int) -> None:
        publish_too = bool(self.topic and (self.topic_bootstrap or self.topic_path))
        rows = (alerts.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
                .withColumn("created_at", F.current_timestamp()))
        if publish_too:
            rows = rows.persist()    # one micro-batch feeds two writes: compute it once
        try:
            if self.kind == "jdbc":
                delete_batch(alerts.sparkSession, self.url, self.table, batch_id, self.properties)
                write_jdbc(rows, self.url, self.table, self.properties)
            else:
                (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch_id").parquet(self.path))
            if publish_too:
                msgs = to_alert_messages(alerts_only(rows).drop("batch_id", "created_at"))
                if self.topic_bootstrap:
                    publish(msgs, self.topic, bootstrap=self.topic_bootstrap)
                else:
                    (msgs.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
                     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                     .partitionBy("batch_id")
                     .json(f"{self.topic_path.rstrip('/')}/{self.topic}"))
        finally:
            if publish_too:
                rows.unpersist()


def write_alerts(sink: AlertSink):
    """A ``foreachBatch`` function: write through ``sink``, without severity 'low' unless the
    sink keeps all versions."""
    def fn(df: DataFrame, batch_id: int) -> None:
        sink.write(df if sink.all_versions else alerts_only(df), batch_id)
    return fn


def write_anomalies(scored: DataFrame, url: str = "", table: str = "fraud_anomalies",
                    properties: dict | None = None, path: str = "",
                    keys: Sequence[str] = ("enterprise_id",), scan_date: str | None = None) -> None:
    """Flagged entities with ``scored_at = now()`` and ``scan_date`` (an ISO date; default: today),
    table created on first write. A rerun of the same scan date replaces that date's rows, in files
    and in the database; other dates are kept."""
    if scan_date is None:
        scan_date = str(scored.sparkSession.range(1).select(F.current_date()).first()[0])
    out = (scored.filter(F.col("is_anomaly"))
           .select(*keys, "requests", "verify_rate", "anomaly_score")
           .withColumns({"scored_at": F.current_timestamp(), "scan_date": F.lit(scan_date)}))
    if url:
        delete_rows(scored.sparkSession, url, table, "scan_date", scan_date, properties)
        # a text of fixed length, which every database can compare
        write_jdbc(out, url, table, properties, column_types="scan_date VARCHAR(10)")
    else:
        spark = scored.sparkSession
        fs, day = _folder(spark, f"{path.rstrip('/')}/scan_date={scan_date}")
        out = out.drop("scan_date")
        out.write.mode("overwrite").parquet(day.toString())  # an empty scan leaves an empty date
        spark.catalog.refreshByPath(path)
