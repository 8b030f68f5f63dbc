"""What the training-data operators share: shared storage, column handling and hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64


#: Folders made for sessions (by application id) that name none, as in tests.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where all is one process (tests), a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        master = spark.sparkContext.master
        if master.startswith("local-cluster") or not master.startswith("local"):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that driver and executors share (master {master})")
        app = spark.sparkContext.applicationId
        folder = _OWN[app] = _OWN.get(app) or tempfile.mkdtemp(prefix="spark-tideline-", dir="/tmp")
    return folder.rstrip("/")


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tideline-{uuid.uuid4().hex}/{name}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts the lineage, and survives a lost executor."""
    path = table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without columns whose names clash (case-insensitively) with those that an operator adds."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(quoted(c)) for c in df.columns if c.lower() not in low])


def quoted(name: str) -> str:
    """A column's name as an expression, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def sealed(docs: DataFrame, new_text: bool = False) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """docs with doc_id, text (as string) and all other columns under private names, so that no column of an operator can meet
    one of the user's; and the function that gives a table of that form the names and the order of docs again, then columns
    named in addition. new_text: a column n_chars follows the text."""
    low = [c.lower() for c in docs.columns]
    names = [c if c in ("doc_id", "text") else f"__column_{i}" for i, c in enumerate(low)]
    inner = docs.select(*[(F.col(quoted(c)).cast("string") if p == "text" else F.col(quoted(c))).alias(p) for c, p in zip(docs.columns, names)])

    def opened(df: DataFrame, *more: str) -> DataFrame:
        out = [F.length("text").cast(docs.schema[c].dataType) if new_text and x == "n_chars" else F.col(p) for c, x, p in zip(docs.columns, low, names)]
        return df.select(*[o.alias(c) for c, o in zip(docs.columns, out)], *more)

    return inner, opened


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as long, text as string, and nothing else: other columns can't clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on an array of uint64."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class WordHashes(dict):
    """64-bit hashes of words (bytes); forgets all once it holds `limit` words, so its memory is bounded."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


#: Odd multipliers of a word's place in a shingle.
PLACES = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the windows of k word hashes; of the whole sequence if it is shorter, none if it is empty."""
    n = len(words)
    k = min(k, n)
    if not k:
        return np.empty(0, dtype=U64)
    out = np.zeros(n - k + 1, dtype=U64)
    for i in range(k):
        out += words[i : n - k + 1 + i] * PLACES[i]
    return mix64(out + U64(k))


def long_array(offsets: np.ndarray, values: np.ndarray):
    """An Arrow list<int64> column."""
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))
