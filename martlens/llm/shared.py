"""What the operators share: stored intermediate tables, shipping of the package to executors, small hashes."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.session import _bytes

_shipped: set[str] = set()
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors reach: ``spark.checkpoint.dir``.

    Only in local mode, where they are one process, a folder is made when the setting is missing. On a cluster a missing
    setting is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="martlens-llm-")
    return _own_folders[context.applicationId]


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the shared folder and read from there.

    It cuts the lineage, survives the loss of executors and fixes whatever a second evaluation could change.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: Most rows of a small key table that is sent to every executor instead of shuffling texts to meet it.
BROADCAST_ROWS = 500_000


def small_side(stored_table: DataFrame, items: Column | None = None) -> DataFrame:
    """The side of a join to send to every executor if it has at most ``BROADCAST_ROWS`` rows, else as it is.

    For narrow stored tables, whose rows are counted in no time; ``items`` weighs rows that hold more than one small value.
    """
    size = stored_table.agg(F.sum(F.lit(1) if items is None else items).alias("size")).first()["size"] or 0
    return F.broadcast(stored_table) if size <= BROADCAST_ROWS else stored_table


def unused(name: str, columns: list[str]) -> str:
    """A column name that none of the columns has, whatever their case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, so that their Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="martlens-ship-"), "martlens_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, files in os.walk(package):
            for file in files:
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


#: Most bytes of rows that Spark hands to a Python worker at once.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that the session hands to Python workers; a smaller bound of the caller stays.

    Without it a batch of whole texts has up to 64 MB, which each of an executor's tasks holds several times, inside and outside
    the JVM.
    """
    if _bytes(spark.conf.get(_BATCH)) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def model_path(name: str) -> str:
    """A tokenizer file by path, or by its name among the installed public tokenizers; called where the file is read."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed scramble of unsigned 64-bit numbers; every input bit reaches every output bit."""
    out = values.astype(np.uint64, copy=True)
    out ^= out >> np.uint64(30)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
