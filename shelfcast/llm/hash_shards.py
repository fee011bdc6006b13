"""Sharding by extendible hashing.

A document's hash is read as bits from the left: 48 bits of the MD5 of its id, then 48 of the MD5
of its text, then 48 of a row number, so that repeated ids and repeated rows can be split, too.
The directory maps a prefix of these bits to a shard. It starts as one bucket; a bucket whose
documents exceed the byte limit splits on its next bit, the others stay, until every shard fits.

Buckets only shrink with depth, so a document's shard is the shortest prefix whose bucket fits.
One aggregate by the next CELL_BITS bits gives all depths of a level; only cells that are still
too large go on to the next level, so the number of levels follows the number of bits needed, and
no level holds more than 4,096 cells for each oversized one above it.

Defined cases: a null text has no bytes; a null id hashes as empty text; a document above the
limit ends in a shard of its own, the only kind above the limit; an empty table has no shards;
a column of the input with the name of an added one is replaced.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.llm.tables import documents, own_name, without, written
from shelfcast.session import shared_dir

LIMIT_BYTES = 64 << 20
QUERY_LIMIT_BYTES = 1 << 20  # of the registered query: shards that are read in one request, and that also small tables have several of
CELL_BITS = 12
CELL_DIGITS = CELL_BITS // 4
PART_DIGITS = 12
ADDED = ("n_bytes", "shard", "depth", "shard_bytes")


def _digest(column):
    return F.substring(F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), 1, PART_DIGITS)


def directory(cells, limit):
    """For each cell (above, digits, n_bytes) its bits, d (bits of them that the shard takes) and shard_bytes.

    ``d`` is null where the cell is too large as a whole.
    """
    cells = cells.withColumn("bits", F.lpad(F.conv("digits", 16, 2), CELL_BITS, "0"))
    depths = F.explode(F.sequence(F.lit(0), F.lit(CELL_BITS)))
    heads = cells.select("*", depths.alias("d")).withColumn("head", F.expr("substring(bits, 1, d)"))
    buckets = heads.groupBy("above", "d", "head").agg(F.sum("n_bytes").alias("bucket_bytes"), F.sum("n").alias("bucket_rows"))
    fits = (F.col("bucket_bytes") <= limit) | (F.col("bucket_rows") == 1)
    buckets = buckets.filter(fits).select("above", "d", "head", "bucket_bytes")
    best = F.min(F.struct("d", "bucket_bytes")).alias("best")
    found = heads.select("above", "digits", "bits", "d", "head").join(buckets, ["above", "d", "head"]).groupBy("above", "digits").agg(best)
    return cells.select("above", "digits", "bits").join(found, ["above", "digits"], "left").select(
        "above", "digits", "bits", F.col("best.d").alias("d"), F.col("best.bucket_bytes").alias("shard_bytes")
    )


def assign(df, id_col="doc_id", text_col="text", limit=LIMIT_BYTES):
    """The table with n_bytes, shard (the prefix as text of 0 and 1), depth (its length), shard_bytes."""
    df = without(df, *ADDED)
    path, at, found = (own_name(df, n) for n in ("shard_path", "shard_level", "shard_found"))
    rows = df.withColumn("n_bytes", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"))
    rows = rows.withColumn(path, F.concat(_digest(F.col(id_col)), _digest(F.col(text_col))))
    levels, rows = _directories(rows, path, limit)
    rows = rows.withColumn(found, F.lit(None).cast("struct<shard: string, shard_bytes: bigint>"))
    prefix = F.lit("")
    for level, table in enumerate(levels):
        taken = F.struct(F.expr("substring(bits, 1, d)").alias("bits"), "shard_bytes")
        table = table.select(F.concat("above", "digits").alias(at), F.when(F.col("d").isNotNull(), taken).alias(f"{found}_here"))
        mine = F.substring(path, 1, (level + 1) * CELL_DIGITS)
        rows = rows.join(table, mine == F.col(at), "left").drop(at)
        here = F.struct(F.concat(prefix, F.col(f"{found}_here.bits")).alias("shard"), F.col(f"{found}_here.shard_bytes").alias("shard_bytes"))
        rows = rows.withColumn(found, F.coalesce(found, F.when(F.col(f"{found}_here").isNotNull(), here))).drop(f"{found}_here")
        prefix = F.concat(prefix, F.lpad(F.conv(F.substring(path, level * CELL_DIGITS + 1, CELL_DIGITS), 16, 2), CELL_BITS, "0"))
    shard = F.col(f"{found}.shard")
    return rows.select(*df.columns, "n_bytes", shard.alias("shard"), F.length(shard).alias("depth"), F.col(f"{found}.shard_bytes").alias("shard_bytes"))


def _directories(rows, path, limit):
    """The directory of each level, and the rows (with longer paths where equal rows need them)."""

    def cut(table, level):
        start = level * CELL_DIGITS
        return table.withColumn("above", F.substring("path", 1, start)).withColumn("digits", F.substring("path", start + 1, CELL_DIGITS))

    pool = written(rows.select(F.col(path).alias("path"), "n_bytes"), "shard-sizes")
    levels = []
    for level in range(3 * PART_DIGITS // CELL_DIGITS):
        if level * CELL_DIGITS == 2 * PART_DIGITS:
            # equal ids with equal texts: a row number goes on; the rows are written, so that it stays
            rows = rows.withColumn(path, F.concat(path, _digest(F.monotonically_increasing_id())))
            rows = written(rows, "shard-rows")
            pool = cut(rows.select(F.col(path).alias("path"), "n_bytes"), level - 1).join(large, ["above", "digits"], "left_semi")
        pool = cut(pool, level)
        cells = pool.groupBy("above", "digits").agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n"))
        levels.append(written(directory(cells, limit), "shard-directory"))
        large = levels[-1].filter("d is null").select("above", "digits")
        if large.isEmpty():
            break
        pool = pool.join(large, ["above", "digits"], "left_semi")
    return levels, rows


def write_shards(assigned, path, file_format="parquet"):
    """Writes one folder per shard; a shard's rows meet in one task, which the limit bounds."""
    named = assigned.withColumn("shard", F.concat(F.lit("p"), "shard"))
    named.repartition("shard").write.partitionBy("shard").format(file_format).save(path)


def read_shards(spark, path, text_col="text", file_format="parquet"):
    """The rows of written shards with n_bytes, shard, depth and shard_bytes, all from what is in the files."""
    rows = spark.read.format(file_format).load(path)
    rows = rows.withColumn("shard", F.expr("substring(shard, 2)")).withColumn("depth", F.length("shard"))
    rows = rows.withColumn("n_bytes", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"))
    sizes = rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"))
    return rows.join(sizes, "shard")


def op7_hash_shards(spark, sf_dir):
    """All documents are written in shards; the columns come from the shards as read back."""
    path = shared_dir(spark, "shards")
    write_shards(assign(documents(spark, sf_dir).select("doc_id", "text"), limit=QUERY_LIMIT_BYTES).select("doc_id", "text", "shard"), path)
    return read_shards(spark, path).select("doc_id", *ADDED)


OP7_SQL = f"""
WITH d AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
    CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) AS h FROM documents),
e AS (SELECT doc_id, n_bytes, h, unnest(range(0, 49)) AS depth FROM d),
b AS (SELECT depth, h >> CAST(48 - depth AS BIGINT) AS p, sum(n_bytes) AS bytes, count(*) AS n FROM e GROUP BY 1, 2),
f AS (SELECT e.doc_id, min(e.depth) AS depth FROM e JOIN b ON e.depth = b.depth AND (e.h >> CAST(48 - e.depth AS BIGINT)) = b.p
    WHERE b.bytes <= {QUERY_LIMIT_BYTES} OR b.n = 1 GROUP BY e.doc_id)
SELECT d.doc_id, d.n_bytes, array_to_string(list_transform(range(0, f.depth), lambda i: CAST((d.h >> CAST(47 - i AS BIGINT)) & 1 AS VARCHAR)), '') AS shard,
    CAST(f.depth AS INT) AS depth, CAST(b.bytes AS BIGINT) AS shard_bytes
FROM d JOIN f ON d.doc_id = f.doc_id JOIN b ON b.depth = f.depth AND b.p = (d.h >> CAST(48 - f.depth AS BIGINT))
"""
