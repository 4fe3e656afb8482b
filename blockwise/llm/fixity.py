"""Merkle fixity audit of record files (operator 1).

A replica is a table of records: shard (file), offset and length of the record's bytes,
and their SHA-256.  Leaves are blocks of ``BLOCK`` bytes of a shard: a block's digest
covers the records that begin in it, by offset.  ``FANOUT`` neighbouring nodes make a
node of the next level, up to one root per shard.  Because nodes stand for fixed offset
ranges, a lost, added or altered record changes only the nodes above its offset.

The audit compares the roots of two replicas and descends level by level, looking only
at children of nodes that differ, down to blocks and then to single records.

Nulls and edges: null url or payload count as empty text; a null id lays a record into
one of many shards of its own kind by its hash; records that repeat at one offset of a
replica are added up by a digest of the multiset, so no group of ties is gathered;
an empty replica differs from a full one in every shard; two empty replicas give no rows.
Other columns of a record table are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

BLOCK = 1 << 14
FANOUT = 16
SHARD_RECORDS = 1024
NULL_ID_SHARDS = 1 << 20


def warc_record(url: Column, payload: Column) -> Column:
    """A WARC/1.0 resource record of the payload, as text."""
    url, payload = F.coalesce(url, F.lit("")), F.coalesce(payload, F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), url,
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"),
                    F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def lay_out(pages: DataFrame, id_col: str, record: Column, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """(shard, offset, length, record_id, sha256): records written to shard files in id order.

    A shard holds the ids of one range, so it is bounded by ``shard_records`` ids; identical
    rows are summed up before the shuffle and lie one after another, as one record run.
    """
    key = F.col(id_col).cast("long")
    rows = pages.select(key.alias("record_id"), record.alias("record"))
    rows = rows.select("record_id", F.octet_length("record").cast("long").alias("size"), F.sha2("record", 256).alias("sha256"))
    null_shard = -1 - F.pmod(F.xxhash64("sha256"), F.lit(NULL_ID_SHARDS))
    runs = (rows.withColumn("shard", F.coalesce(F.floor(F.col("record_id") / shard_records), null_shard).cast("long"))
            .groupBy("shard", "record_id", "sha256", "size").agg(F.count("*").alias("copies")))
    before = Window.partitionBy("shard").orderBy("record_id", "sha256").rowsBetween(Window.unboundedPreceding, -1)
    bytes_ = F.col("size") * F.col("copies")
    return runs.select("shard", F.coalesce(F.sum(bytes_).over(before), F.lit(0)).cast("long").alias("offset"), bytes_.alias("length"),
                       "record_id", "sha256")


def _records(replica: DataFrame) -> DataFrame:
    """One row per (shard, offset): count and a digest of the multiset of records that begin there."""
    piece = [F.conv(F.substring("sha256", 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)") for k in range(4)]
    whole = F.sha2(F.concat_ws("|", F.col("length").cast("string"), F.coalesce("sha256", F.lit("-"))), 256)
    rows = replica.select("shard", "offset", whole.alias("sha256"))
    return (rows.groupBy("shard", "offset").agg(F.count("*").alias("n"), *[F.sum(p).alias(f"s{k}") for k, p in enumerate(piece)])
            .select("shard", "offset", F.sha2(F.concat_ws("|", "n", *[F.col(f"s{k}").cast("string") for k in range(4)]), 256).alias("digest")))


def _parents(nodes: DataFrame, width: int) -> DataFrame:
    """Nodes one level up; a node gathers ``width`` children at most."""
    child = F.struct("node", "digest")
    return (nodes.groupBy("shard", F.floor(F.col("node") / width).alias("parent"))
            .agg(F.sort_array(F.collect_list(child)).alias("children"))
            .select("shard", F.col("parent").alias("node"),
                    F.sha2(F.array_join(F.transform("children", lambda c: F.concat_ws(":", c["node"].cast("string"), c["digest"])), ","), 256).alias("digest")))


def tree(replica: DataFrame, levels: int, block: int = BLOCK, fanout: int = FANOUT) -> list[DataFrame]:
    """[records, blocks, ..., roots]: (shard, node, digest) per level; records have their offset as node."""
    found = [materialize(_records(replica).withColumnRenamed("offset", "node"), "merkle-0")]
    for level in range(1, levels):
        found.append(materialize(_parents(found[-1], block if level == 1 else fanout), f"merkle-{level}"))
    return found


def height(a: DataFrame, b: DataFrame, block: int = BLOCK, fanout: int = FANOUT) -> int:
    """Levels that make one root of the longest shard."""
    last = a.select("offset").unionByName(b.select("offset")).agg(F.max("offset")).first()[0] or 0
    levels, nodes = 2, last // block + 1
    while nodes > 1:
        levels, nodes = levels + 1, -(-nodes // fanout)
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    b = b.select("shard", "node", F.col("digest").alias("other"))
    return a.join(b, ["shard", "node"], "full").filter(~F.col("digest").eqNullSafe(F.col("other")))


def audit(a: DataFrame, b: DataFrame, block: int = BLOCK, fanout: int = FANOUT) -> DataFrame:
    """Every offset at which replica ``b`` does not hold what ``a`` holds.

    (shard, offset, status): ``altered``, ``missing`` (in b) or ``extra`` (in b only).
    """
    levels = height(a, b, block, fanout)
    left, right = tree(a, levels, block, fanout), tree(b, levels, block, fanout)
    bad = _differing(left[-1], right[-1]).select("shard", "node")
    for level in range(levels - 2, -1, -1):
        width = block if level == 0 else fanout
        up = materialize(bad, f"merkle-bad-{level}").withColumnRenamed("node", "parent")
        under = [x.withColumn("parent", F.floor(F.col("node") / width)).join(up, ["shard", "parent"], "left_semi") for x in (left[level], right[level])]
        bad = _differing(*under)
        if level:
            bad = bad.select("shard", "node")
    status = F.when(F.col("other").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("altered")
    return bad.select("shard", F.col("node").alias("offset"), status.alias("status"))


def report(a: DataFrame, b: DataFrame, block: int = BLOCK, fanout: int = FANOUT) -> DataFrame:
    """The audit's findings with the records of both replicas, and one ``intact`` row per shard without any."""
    a, b = materialize(a.select("shard", "offset", "length", "record_id", "sha256"), "replica-a"), materialize(b.select("shard", "offset", "length", "record_id", "sha256"), "replica-b")
    found = materialize(audit(a, b, block, fanout), "findings")
    own = a.select("shard", "offset", "record_id", "length")
    other = b.select("shard", "offset", F.col("record_id").alias("copy_id"), F.col("length").alias("copy_length"))
    rows = (found.join(own, ["shard", "offset"], "left").join(other, ["shard", "offset"], "left")
            .select("shard", "offset", "status", F.coalesce("record_id", "copy_id").alias("record_id"), F.coalesce("length", "copy_length").alias("length")))
    shards = a.groupBy("shard").agg(F.sum("length").alias("length"))
    clean = shards.join(found.select("shard").distinct(), "shard", "left_anti").select(
        "shard", F.lit(0).cast("long").alias("offset"), F.lit("intact").alias("status"), F.lit(None).cast("long").alias("record_id"), "length")
    return rows.unionByName(clean)
