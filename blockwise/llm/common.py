"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys up to this count are looked up in a bit table of 32 bits a key (16 MB at most); more are joined.
BIT_TABLE_KEYS = 1 << 22


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Only where the session names none (tests on one machine) a scratch folder is made.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = sc.getCheckpointDir()
        if path is None:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            path = tempfile.mkdtemp(prefix="blockwise-shared-")
            sc.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/blockwise-llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor rereads the table instead of recomputing what made it.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Gives back to the system what this process has freed; Arrow's pool and malloc keep it otherwise, and Spark holds on to idle workers."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


_HELD: dict[str, Callable[[], None]] = {}


def hold_cache(owner: str, clear: Callable[[], None]) -> None:
    """Called in a task before its operator fills a cache of the Python worker; Spark gives workers to one operator
    after another, so the caches that others left there are emptied first, and a worker holds those of one alone.
    Tasks without a cache of their own call it too, with ``dict``."""
    others = [x for x in _HELD if x != owner]
    for other in others:
        _HELD.pop(other)()
    if others:
        release_memory()
    _HELD[owner] = clear


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose sizes sum to ``limit`` at most (one row at least)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def scratch_column(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until no column of ``df`` has it (any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file: ``$BLOCKWISE_TOKENIZERS``/name if set, else the installed package's."""
    folder = os.environ.get("BLOCKWISE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    """The public pattern that splits text before the merges of the rank files."""
    import public_tokenizers
    return public_tokenizers.PATTERN


def key_test(keys: DataFrame) -> Callable[[Column], Column] | None:
    """A test whether a long is among ``keys`` (one long column), true for a few others too.

    The test looks into a bit table of bounded size, so the tested rows need no shuffle.
    None beyond ``BIT_TABLE_KEYS`` keys: then the caller joins.
    """
    key = F.col(keys.columns[0])
    n = keys.count()
    if n > BIT_TABLE_KEYS:
        return None
    words = 1 << max(6, (n // 2).bit_length())

    def word(k: Column) -> Column:
        return F.pmod(F.shiftright(k, 6), F.lit(words)).cast("int")

    def bit(k: Column) -> Column:
        return k.bitwiseAND(F.lit(63)).cast("int")

    masks = keys.select(word(key).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit(key)).alias("mask"))
    masks = masks.groupBy("word").agg(F.bit_or("mask").alias("mask"))
    every = keys.sparkSession.range(0, words, 1, 1).select(F.col("id").cast("int").alias("word")).join(masks, "word", "left")
    table = every.agg(F.sort_array(F.collect_list(F.struct("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask")))).alias("t")).select("t.mask").scalar()
    return lambda k: F.coalesce(F.call_function("getbit", F.get(table, word(k)), bit(k)) == 1, F.lit(False))


def keep_keyed(rows: DataFrame, columns: list[Column], keys: DataFrame) -> DataFrame:
    """Rows of which one of the ``columns`` is in ``keys``; by the bit table a few others may come along."""
    test = key_test(keys)
    if test is not None:
        return rows.filter(reduce(or_, map(test, columns)))
    key, mark = F.col(keys.columns[0]), scratch_column(rows, "key_")
    numbered = rows.withColumn(mark, F.explode(F.array_distinct(F.array(*columns))))
    return numbered.join(keys.select(key.alias(mark)), mark, "left_semi").drop(mark)
