"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import math
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Bytes of raw input that one shuffle partition of a job should stand for.
BYTES_PER_PARTITION = 24 << 20


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the checkpoint folder all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Cut lineage: write ``df`` as parquet in the shared folder and read it.

    Reread rows are the same after an executor is lost, and their size on
    disk is known to the planner.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession, n_bytes: int = 0, per: int = BYTES_PER_PARTITION) -> int:
    """Partitions for ``n_bytes`` of data; the session's own number at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / per))


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns only, so that others cannot clash with ours."""
    require(df, *columns.values())
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def hex_unit(*parts: Column | str) -> Column:
    """A double in [0, 1) from the md5 of the colon-joined parts (52 bits)."""
    digest = F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(p) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def map_text(df: DataFrame, text: str, added: list[tuple[str, str, pa.DataType]], make: Callable[[], Callable], keep: list[str] | None = None) -> DataFrame:
    """``df``'s columns (those in ``keep``) as they are, plus columns worked out
    from the text column, a batch at a time.

    ``make()`` is called once a task and gives the function from a list of
    texts (None for null) to one list per added (name, SQL type, Arrow type).
    Other columns never leave Arrow, so wide integers stay exact beside nulls.
    """
    keep = df.columns if keep is None else keep
    at, rest = df.columns.index(text), [df.columns.index(c) for c in keep]

    def run(batches):
        compute = make()
        for batch in batches:
            if batch.num_rows:
                columns = compute(batch.column(at).to_pylist())
                arrays = [batch.column(i) for i in rest] + [pa.array(c, type=t) for c, (_, _, t) in zip(columns, added)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *(n for n, _, _ in added)])

    fields = [f"`{n}` {t}" for n, t in df.dtypes if n in keep] + [f"`{n}` {t}" for n, t, _ in added]
    return df.mapInArrow(run, ", ".join(fields))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where they cannot by themselves."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    on_path = any(p and os.path.realpath(p) == os.path.realpath(root) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep))
    sc = spark.sparkContext
    if on_path or (sc.master.startswith("local[") and os.path.realpath(os.getcwd()) == os.path.realpath(root)) or getattr(sc, "_faultscore_shipped", False):
        return
    package = os.path.basename(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="faultscore-package-"))
    sc.addPyFile(shutil.make_archive(os.path.join(folder, package), "zip", root, package))
    sc._faultscore_shipped = True


Query = Callable[[SparkSession, str], DataFrame]
