"""Stage outputs of a training run, committed one by one, so that a driver
that is started again goes on where the last one ended.

A run's folder is named by a digest of its rows, task, seed and configuration,
so other rows or settings never meet its outputs.  A stage writes its table or
model below a name of its own attempt; a one-line record that names the
attempt, written last, commits it.  What has no record is made anew, so an
attempt that ended half-way, or a second driver on the same run, does no harm.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col
from ..operators.candidates import CandidateConfig
from ..schema import TaskSpec

#: Raised when stage outputs change their form.
FORMAT = 2
#: Settings that say which candidates are fitted and how fast, not what a fit gives.
NOT_IN_DIGEST = ("include", "parallel_fits")


def content_digest(df: DataFrame) -> tuple:
    """Rows and the sum of their hashes: equal for equal rows in any order."""
    columns = [col(c) for c in sorted(df.columns)]
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first())


def run_digest(df: DataFrame, spec: TaskSpec, seed: int, config: CandidateConfig) -> str:
    settings = {k: v for k, v in asdict(config).items() if k not in NOT_IN_DIGEST}
    named = [FORMAT, *map(str, content_digest(df)), sorted(df.dtypes), repr(spec), seed, settings]
    return hashlib.sha256(json.dumps(named, sort_keys=True, default=repr).encode()).hexdigest()[:32]


@dataclass(frozen=True)
class RunFolder:
    """A run's committed stages below ``path``; with no path nothing is kept."""

    spark: SparkSession
    path: str | None = None

    @property
    def keeps(self) -> bool:
        return self.path is not None

    def _record(self, stage: str) -> str:
        return os.path.join(self.path, "committed", stage)

    def committed(self, stage: str) -> Any:
        """What the stage recorded, or None."""
        if not self.keeps:
            return None
        try:
            lines = self.spark.read.text(self._record(stage)).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return json.loads(lines[0][0]) if lines else None

    def commit(self, stage: str, value: Any) -> None:
        if self.keeps:
            self.spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(self._record(stage))

    def _attempt(self, stage: str) -> str:
        return os.path.join(self.path, "outputs", f"{stage}-{uuid.uuid4().hex}")

    def record(self, stage: str, make: Callable[[], Any]) -> Any:
        """A value of JSON types, made only once."""
        found = self.committed(stage)
        if found is None:
            found = make()
            self.commit(stage, found)
        return found

    def table(self, stage: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A table, written only once."""
        if not self.keeps:
            return make()
        path = self.committed(stage)
        if path is None:
            path = self._attempt(stage)
            make().write.parquet(path)
            self.commit(stage, path)
        return self.spark.read.parquet(path)

    def model(self, stage: str, make: Callable[[], tuple[Model, Any]]) -> tuple[Model, Any]:
        """A fitted model and a value of JSON types beside it, fitted only once."""
        found = self.committed(stage)
        if found is not None:
            return PipelineModel.load(found["path"]).stages[0], found["beside"]
        model, beside = make()
        if self.keeps:
            path = self._attempt(stage)
            PipelineModel(stages=[model]).save(path)
            self.commit(stage, {"path": path, "beside": beside})
        return model, beside


def run_folder(df: DataFrame, spec: TaskSpec, seed: int, config: CandidateConfig, root: str) -> RunFolder:
    """The folder of this run below ``root``, which every driver must see."""
    return RunFolder(df.sparkSession, os.path.join(root, run_digest(df, spec, seed, config)))
