"""Full replay of wide snapshots: the history crosses the shuffle without its payload.

Only key, 16-byte digest, snapshot number and the address of the row (its file and its number in it) are
shuffled by key. What comes out, one narrow row per change, is written; then the files are read a second
time, and only the rows that were emitted go on to be joined with their changes.

Which rows those are is asked before they are shuffled: a sieve of a fixed number of bits over the hashes
of the emitted addresses is broadcast. It grows with the changes up to ``SIEVE_BITS`` (32 MB); beyond that
it lets more rows through, and the join, which is on the whole address and the key, still finds the right
ones. ``capture_changes`` reads once and shuffles everything: better for narrow rows, or if most rows change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.digest import row_digest
from ledgerline.operators.changes import _DIGEST, _events, _marked
from ledgerline.operators.snapshots import BY_FILE, SEQ, numbered_snapshots
from ledgerline.session import work_folder
from ledgerline.spec import (
    LOG_DATASOURCE,
    LOG_DELETED,
    LOG_MD5,
    LOG_SOURCEFILE,
    LOG_TIMESTAMP,
    STD_FILENAME,
    STD_TIMESTAMP,
    DatasetSpec,
)

#: Bits of the sieve for each change, and at most; bits of one row of it.
BITS_PER_CHANGE, SIEVE_BITS, ROW_BITS = 16, 1 << 28, 1 << 15
_FILE, _ROW = "__file", "__row"


def _addressed(files: DataFrame) -> DataFrame:
    """Rows of Parquet files with their address."""
    meta = F.col("_metadata")
    return files.select("*", F.xxhash64(meta["file_path"]).alias(_FILE), meta["row_index"].alias(_ROW))


def _slot(bits: int) -> Column:
    """The bit of an address, from 1."""
    return F.pmod(F.xxhash64(_FILE, _ROW), F.lit(bits)) + 1


def _sieve(changes: DataFrame, bits: int) -> DataFrame:
    """(bucket, bitmap) of the emitted addresses: at most bits / ROW_BITS rows of 4 KB."""
    slot = _slot(bits)
    places = changes.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("place"))
    return places.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bitmap"))


def _is_set(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1


def narrow_changes(
    spec: DatasetSpec, files: DataFrame, snapshots: DataFrame | None = None, by: tuple[str, ...] = BY_FILE
) -> DataFrame:
    """Key, digest, address, snapshot number and deletion of every change; no payload."""
    numbered = numbered_snapshots(files, snapshots, by)
    digest = F.unhex(row_digest(spec.schema, spec.digest_columns)).alias(_DIGEST)
    rows = _addressed(files).join(numbered.select(*by, SEQ), list(by)).select(*spec.keys, SEQ, digest, _FILE, _ROW)
    rows = _events(_marked(spec, rows.repartition(*spec.keys), seeded=False))
    seq = F.when(F.col(LOG_DELETED), F.col(SEQ) + 1).otherwise(F.col(SEQ))
    rows = rows.select(*spec.keys, _FILE, _ROW, F.lower(F.hex(_DIGEST)).alias(LOG_MD5), seq.alias(SEQ), LOG_DELETED)
    return rows.join(numbered.select(SEQ, STD_FILENAME, STD_TIMESTAMP), SEQ).drop(SEQ)


def narrow_replay(
    spec: DatasetSpec, files: DataFrame, snapshots: DataFrame | None = None, by: tuple[str, ...] = BY_FILE
) -> DataFrame:
    """The same log as ``full_replay`` of *files*, a scan of Parquet files."""
    spark = files.sparkSession
    found = narrow_changes(spec, files, snapshots, by)
    path = work_folder(spark, "narrow-changes")
    found.write.parquet(path)
    changes = spark.read.schema(found.schema).parquet(path)
    bits = min(SIEVE_BITS, max(ROW_BITS, 1 << (BITS_PER_CHANGE * changes.count()).bit_length()))
    sieve = F.broadcast(_sieve(changes, bits))
    slot = _slot(bits)
    rows = _addressed(files).select(*spec.names, _FILE, _ROW)
    rows = rows.withColumns({"bucket": F.bitmap_bucket_number(slot), "place": F.bitmap_bit_position(slot)})
    rows = rows.join(sieve, "bucket").where(_is_set(F.col("bitmap"), F.col("place"))).select(*spec.names, _FILE, _ROW)
    return changes.join(rows, [*spec.keys, _FILE, _ROW]).select(
        *spec.names,
        LOG_MD5,
        F.col(STD_TIMESTAMP).alias(LOG_TIMESTAMP),
        F.lit(spec.code).alias(LOG_DATASOURCE),
        F.col(STD_FILENAME).alias(LOG_SOURCEFILE),
        LOG_DELETED,
    )
