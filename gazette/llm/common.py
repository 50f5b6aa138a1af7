"""Helpers that the operators of this subpackage share: tables, scratch space, Arrow batches, hashing.

The hashing helpers work on whole Arrow batches with numpy. A *chunk* is a run of
documents of a fraction of a megabyte, so the memory of a task doesn't depend on its partition.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into numpy arrays at a time (one longer document is a chunk of its own).
CHUNK_BYTES = 1 << 18
#: Bytes of an Arrow batch on its way to a Python worker, unless the session sets another size. Spark's own 64 MB bear hard on small executors.
BATCH_SETTING, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a folder of our own only where none is set, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write a table in the shared folder and read it again. It survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def drop_written(df: DataFrame) -> None:
    """Remove a table made by written() once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.written_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null texts as empty ones; other columns, whatever their names, go."""
    conf = docs.sparkSession.conf
    if conf.get(BATCH_SETTING) == f"{BATCH_DEFAULT}b":
        conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))


def in_training(doc_id) -> "F.Column":
    """Rows whose labels may be learnt from: crc32 of the id's digits, mod 5, isn't 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK_BYTES) -> Iterator[tuple[pa.Array, pa.StringArray]]:
    """(doc_ids, texts) of CHUNK_BYTES each. Ids stay Arrow arrays: they may be null."""
    for batch in batches:
        ids = batch.column("doc_id")
        text = batch.column("text")
        if text.null_count:
            text = pc.fill_null(text, "")
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ids):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield ids.slice(at, to - at), text.slice(at, to - at)
            at = to


def raw(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the n + 1 offsets of its rows in them."""
    wide = pa.types.is_large_string(text.type)
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = text.buffers()[2]
    body = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, offsets - offsets[0]


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_A = np.uint64(0xD6E8FEB86659FD93)
#: Spans are hashed by a polynomial modulo this prime; the base was drawn at random once.
PRIME = (1 << 61) - 1
_BASE = 0x0F3C9A1D5E7B2486
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_LOW31, _LOW30, _P61 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1), np.uint64(PRIME)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _reduced(x: np.ndarray) -> np.ndarray:
    """Below PRIME."""
    x = (x >> np.uint64(61)) + (x & _P61)
    return np.where(x >= _P61, x - _P61, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME for factors below it, in halves of 31 bits."""
    high_a, low_a, high_b, low_b = a >> np.uint64(31), a & _LOW31, b >> np.uint64(31), b & _LOW31
    middle = low_a * high_b + high_a * low_b
    return _reduced(high_a * high_b * np.uint64(2) + (middle >> np.uint64(30)) + ((middle & _LOW30) << np.uint64(31)) + low_a * low_b)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        m = max(n, CHUNK_BYTES * 2 + 1)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, PRIME))):
            powers = np.ones(1, np.uint64)
            while len(powers) < m:  # the table doubles
                powers = np.concatenate([powers, _times(powers, np.full(1, pow(base, len(powers), PRIME), np.uint64))])
            _powers[key] = powers
    return _powers["up"][:n], _powers["down"][:n]


def _sums(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=out[1:])
    return out


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[start:end] by prefix sums of a polynomial modulo a prime, all spans at once.

    A power of two as the modulus would be cheaper, but regular texts of two letters collide under it.
    """
    up, down = _power(len(values) + 1)
    up = up[: len(values)]
    terms = (values.astype(np.uint64) + np.uint64(1)) if values.dtype == np.uint8 else _times(_reduced(values.astype(np.uint64)), up)
    if values.dtype == np.uint8:  # the powers in halves: no sum of a chunk leaves 64 bits
        high, low = _sums(terms * (up >> np.uint64(31))), _sums(terms * (up & _LOW31))
    else:
        high, low = _sums(terms >> np.uint64(31)), _sums(terms & _LOW31)
    high, low = _reduced(high[ends] - high[starts]), _reduced(low[ends] - low[starts])
    total = _reduced(_times(high, np.full(1, 1 << 31, np.uint64)) + low)
    return mix(_times(total, down[starts]) + (ends - starts).astype(np.uint64) * _A)


def window_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all runs of k neighbouring values. Bytes are packed in eights, so that every run is read in a few numbers without a polynomial."""
    n = len(values) - k + 1
    if values.dtype != np.uint8 or k < 8:
        at = np.arange(n)
        return span_hashes(values, at, at + k)
    packed = values.astype(np.uint64)
    for size in (1, 2, 4):
        packed = packed[:-size] << np.uint64(8 * size) | packed[size:]
    h = mix(packed[:n].copy())
    for at in [*range(8, k - 7, 8), *([k - 8] if k % 8 else [])]:  # the last eight may overlap those before
        h *= _A
        h += packed[at : at + n]
        h = mix(h)
    return h


def words(body: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the maximal runs of bytes that are no separators; no word crosses a row."""
    if not len(body):
        return (np.zeros(0, np.int64),) * 3
    gap = separators[body]
    first, last = np.empty(len(body), bool), np.empty(len(body), bool)
    first[0] = last[-1] = True
    first[1:], last[:-1] = gap[:-1], gap[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(body))]
    first[inner] = True
    last[inner - 1] = True
    starts = np.flatnonzero(~gap & first)
    ends = np.flatnonzero(~gap & last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def lower_ascii(body: np.ndarray) -> np.ndarray:
    return np.where((body >= 65) & (body <= 90), body | 0x20, body)


def grams(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k neighbouring words of one row, and the index of each run's first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = hashes[:n].copy()
    for j in range(1, k):
        h = h * _A + hashes[j : j + n]
    at = np.flatnonzero(rows[:n] == rows[k - 1 :])
    return mix(h[at]), at


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs values[start : start + size] one after the other, and where each begins (with the end as the last)."""
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return values[np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes)], at


def released(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps; without this they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


#: Bits of the map that thins out rows before a shuffle: 4 MB, whatever the input.
ID_BITS = 1 << 25
_PAGE = 1 << 15


def _slots(ids: np.ndarray, size: int = ID_BITS) -> np.ndarray:
    ids = ids.astype(np.int64)
    return (ids ^ ids >> 25 ^ ids >> 50) & (size - 1)


def bits_for(count: int) -> int:
    """Bits of a map for so many values: 16 each, from 128 KB to 32 MB."""
    return 1 << min(28, max(20, (16 * count - 1).bit_length()))


def id_bits(rows: DataFrame, column: str = "doc_id", size: int = ID_BITS) -> np.ndarray:
    """A bit map of hashed values. With very many values for its size it fills up and thins out less; it never loses one.

    Values are dealt out by page, so that each page of 4 KB is built once, by Spark's bitmap aggregate.
    """
    v = F.col(column)
    slot = v.bitwiseXOR(F.shiftright(v, 25)).bitwiseXOR(F.shiftright(v, 50)).bitwiseAND(F.lit(size - 1))
    places = rows.where(v.isNotNull()).select(F.shiftright(slot, 15).alias("page"), slot.bitwiseAND(F.lit(_PAGE - 1)).alias("at"))
    pages = places.repartition("page").groupBy("page").agg(F.bitmap_construct_agg("at").alias("bits")).toArrow()
    out = np.zeros((size // _PAGE, _PAGE // 8), np.uint8)
    for page, bits in zip(pages["page"].to_pylist(), pages["bits"].to_pylist()):
        out[page] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def in_bits(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = _slots(values, len(bits) * 8)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def held(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """The rows whose doc_id may be in the bit map. Row-local; an exact join follows."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bits(batch.column("doc_id").to_numpy(zero_copy_only=False), shared.value)))

    return docs.where(F.col("doc_id").isNotNull()).mapInArrow(run, docs.schema)
