"""Has the source changed?"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.sources.artifacts import exists

LISTING_TASK_BYTES = str(1 << 40)


def file_signature(spark, path):
    """Signature of the file listing (name, size, time). Reads no file content.

    Spark packs files into tasks by their size even though nothing is read here, so the
    listing runs in a session of its own with a large task size.
    """
    listing = spark.newSession()
    listing.conf.set("spark.sql.files.maxPartitionBytes", LISTING_TASK_BYTES)
    files = listing.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    return _signature(files)


def content_fingerprint(df):
    """Signature of the rows, whatever their order: one scan, one number per partition.

    Row count plus the sum of row hashes. Null flags are hashed too, because the hash skips
    nulls; sums use 38 digits, so they do not overflow.
    """
    return _signature(df)


def _sums(names):
    """Count and hash sum of the rows of ``names``, whatever other columns there are."""
    content = [c for n in sorted(names) for c in (F.col(n), F.col(n).isNull())]
    hash_sum = F.sum(F.xxhash64(*content).cast("decimal(38,0)")).cast("string")
    return F.count(F.lit(1)).alias("n_rows"), F.coalesce(hash_sum, F.lit("0")).alias("hash_sum")


def row_hash_sum(df):
    return df.agg(*_sums(df.columns))


def day_sums(df, *keys):
    """Count and hash sum of each day's rows (of each day and ``keys``, which are not hashed)."""
    return df.groupBy(*keys, "date").agg(*_sums([c for c in df.columns if c not in keys]))


def total_signature(sums):
    """The signature of all rows from that of parts: sums of sums."""
    row = sums.agg(F.sum("n_rows").alias("n"), F.sum(F.col("hash_sum").cast("decimal(38,0)")).cast("string").alias("h")).first()
    return f"{row['n'] or 0}:{row['h'] or 0}"


class FileHashes:
    """Count and hash sum of each file and day of a source, so that only new or changed files are read.

    Row hashes add up, so the fingerprint of any span of days is a sum over the table. Rows of files
    that are gone or were rewritten stay in the table and no longer match the listing (by path, size
    and time). The table is appended to; a file counts only if all its days arrived (``parts``), and
    rows of two updates at the same time are equal and count once.
    """

    KEYS = ("path", "length", "modified")
    SCHEMA = "path string, length bigint, modified timestamp, date date, n_rows bigint, hash_sum string, parts bigint"
    MOST_PATHS = 10_000  # files that are read by name; more are read with the whole source

    def __init__(self, spark, store):
        self.spark, self.store = spark, store.rstrip("/")
        self.scanned = 0  # files that the last update read

    def listing(self, source):
        """(path, length, modified) of the source's files; reads no content."""
        listing = self.spark.newSession()
        listing.conf.set("spark.sql.files.maxPartitionBytes", LISTING_TASK_BYTES)
        meta = listing.read.format("binaryFile").load(source).select("_metadata")
        files = meta.select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_modification_time").alias("modified")
        )
        return files

    def known(self):
        if not exists(self.spark, self.store):
            return self.spark.createDataFrame([], self.SCHEMA)
        rows = self.spark.read.schema(self.SCHEMA).parquet(self.store).distinct()
        arrived = rows.groupBy(*self.KEYS).agg(F.count("*").alias("n"), F.max("parts").alias("parts")).filter("n = greatest(parts, 1)")
        return rows.join(arrived.select(*self.KEYS), list(self.KEYS), "left_semi")

    def update(self, source, typed):
        """Brings the table up to date and returns (date, n_rows, hash_sum) of the source's days.

        ``typed(raw)`` makes the dated rows of raw ones and has to pass a column ``source_file`` on.
        """
        names = list(self.KEYS)
        files = self.spark.createDataFrame(self.listing(source).collect(), "path string, length bigint, modified timestamp")
        new = files.join(self.known().select(*names).distinct(), names, "left_anti")
        paths = [r["path"] for r in new.select("path").limit(self.MOST_PATHS + 1).collect()]
        self.scanned = len(paths)
        if paths:
            raw = self.spark.read.parquet(*paths) if len(paths) <= self.MOST_PATHS else self.spark.read.parquet(source)
            rows = typed(raw.withColumn("source_file", F.col("_metadata.file_path")))
            sums = day_sums(rows, "source_file").withColumnRenamed("source_file", "path")
            found = new.join(sums, "path", "left")  # a file without dated rows has one row without a date
            parts = found.groupBy("path").agg(F.count("date").alias("parts"))
            found.join(parts, "path").select(*[c.split()[0] for c in self.SCHEMA.split(", ")]).repartition("path").write.mode("append").parquet(self.store)
        now = self.known().join(files, names, "left_semi").filter("date IS NOT NULL")
        sums = F.sum(F.col("hash_sum").cast("decimal(38,0)")).cast("string").alias("hash_sum")
        return now.groupBy("date").agg(F.sum("n_rows").alias("n_rows"), sums)


def _signature(df):
    row = row_hash_sum(df).first()
    return f"{row['n_rows']}:{row['hash_sum']}"
