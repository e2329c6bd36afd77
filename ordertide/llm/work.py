"""Shared work folder, chunk counts and packing helpers of the llm operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one chunk, shard or bin is meant to hold.
CHUNK_BYTES = 4 << 20
_own: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the cluster; only a local session without one gets its own folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="llm-work-")
    return _own[app]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared work folder: lineage ends there, executors may be lost."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str) -> int:
    return df.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0


def chunk_count(df: DataFrame, text: str, target: int = CHUNK_BYTES) -> int:
    """Chunks of about ``target`` bytes of text, and one for each shuffle partition at least."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, partitions, -(-text_bytes(df, text) // target))


def plain_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only the key as long, the text as string and its hash: no other column, whatever its name, is looked at."""
    whole = F.col(text).cast("string")
    return df.select(F.col(key).cast("long").alias("doc"), F.xxhash64(whole).alias("tie"), whole.alias("text"))


def by_chunk(texts: DataFrame, n: int) -> DataFrame:
    """Whole texts dealt out by a hash of the key into ``n`` chunks of bounded size."""
    spark = texts.sparkSession
    chunked = texts.select(F.pmod(F.xxhash64("doc"), F.lit(n)).cast("long").alias("chunk"), "doc", "tie", "text")
    return chunked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of any types and lengths as one compressed string."""
    head = np.array([len(arrays), *(x for a in arrays for x in (a.itemsize, len(a)))], np.int64)
    raw = b"".join([head.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)


def unpack(blob: bytes, *types: type | str) -> list[np.ndarray]:
    raw = pa.Codec("zstd", compression_level=3).decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    head = np.frombuffer(raw, np.int64, 1 + 2 * len(types))
    at, out = head.nbytes, []
    for k, kind in enumerate(types):
        out.append(np.frombuffer(raw, kind, int(head[2 + 2 * k]), at))
        at += int(head[1 + 2 * k] * head[2 + 2 * k])
    return out


def spans_of(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """All indices of the ranges ``starts[i]:starts[i] + lens[i]``, one after another."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(lens) - lens
    return np.arange(total) + np.repeat(starts - begin, lens)


def only(docs: DataFrame, key: str, text: str, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key and text hash are in ``chosen`` (doc, tie); null keys meet."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(key).cast("long").alias("d"), F.xxhash64(F.col(text).cast("string")).alias("t"))
    return rows.join(chosen, F.col("d").eqNullSafe(F.col("doc")) & (F.col("t") == F.col("tie")), "left_semi").select("row.*")
