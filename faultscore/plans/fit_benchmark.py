"""What the physical layout of the training rows costs and changes.

One candidate configuration is fitted several times on each of a list of
partition counts.  The report has a row per layout (partitions, fit seconds)
and the validation parity of the first layout's scores with each other
layout's.  Held-out rows are not read.
"""

from __future__ import annotations

import time
from dataclasses import replace
from typing import Any

from pyspark import StorageLevel

from ..operators.candidates import LABEL_COL, SCORE_COL, class_balance, fit_candidate, training_rows
from ..operators.parity import run_summary, score_parity
from ..operators.split import TRAIN, VALIDATION
from .experiment import Experiment, score_features

DEFAULT_PARTITIONS = (8, 1)


def run_fit_benchmark(exp: Experiment, repeats: int = 3, partitions: tuple[int, ...] = DEFAULT_PARTITIONS, candidate: str = "boosted_trees") -> dict[str, Any]:
    if repeats < 1:
        raise ValueError("repeats must be at least one")
    spark, spec = exp.features.sparkSession, exp.spec
    balance, width = class_balance(exp.train), exp.stats.vector_width(spec)
    runs, models = [], {}
    for n in partitions:
        rows = training_rows(exp.part(TRAIN), spec.id_column, replace(exp.config, fit_partitions=n)).persist(StorageLevel.MEMORY_AND_DISK)
        rows.count()
        for _ in range(repeats):
            started = time.perf_counter()
            models[n], _ = fit_candidate(candidate, rows, balance, exp.config, width, spec.id_column)
            runs.append((str(n), time.perf_counter() - started))
        rows.unpersist()
    layouts = [r.asDict() for r in run_summary(spark.createDataFrame(runs, "kind string, seconds double")).collect()]
    scores = {n: score_features(exp, candidate, models[n], exp.part(VALIDATION)) for n in partitions}
    base = scores[partitions[0]]
    parity = {n: score_parity(base, scores[n].select(spec.id_column, SCORE_COL), spec.id_column, LABEL_COL).first().asDict() for n in partitions[1:]}
    return {"candidate": candidate, "repeats": repeats, "layouts": sorted(layouts, key=lambda r: r["median_seconds"]), "parity_with_first": parity, "splits_read": [TRAIN, VALIDATION]}
