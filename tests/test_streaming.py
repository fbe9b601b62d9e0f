import os
import shutil

from pyspark.ml import PipelineModel

from faultscore.operators.candidates import PriorScore
from faultscore.operators.preprocess import fit_preprocessor
from faultscore.operators.scoring import predict_rows
from faultscore.schema import MACHINE_TASK as S
from faultscore.sources.adapters import load_machine, machine_table
from faultscore.sources.bundle import Bundle
from faultscore.streaming.scoring import start_file_scoring

from fixtures import SF001


def test_stream_scores_equal_batch_scores(spark, scratch):
    machine = load_machine(spark, SF001)
    pre, _ = fit_preprocessor(machine, S)
    prior = PriorScore(labelCol=S.target).fit(machine)
    model = PipelineModel(stages=list(pre.stages) + [prior])
    bundle = Bundle(model, 0.05, S.features, "majority_baseline", 42)
    source = os.path.join(scratch, "incoming")
    os.makedirs(source)
    shutil.copy(os.path.join(SF001, "events.parquet"), os.path.join(source, "part-0.parquet"))
    schema = spark.read.parquet(os.path.join(SF001, "events.parquet")).schema
    sink = os.path.join(scratch, "scored")
    query = start_file_scoring(spark, source, schema, bundle, sink, keep=["udi"], transform=machine_table,
                               checkpoint=os.path.join(scratch, "ckpt"))
    query.awaitTermination(300)
    streamed = {(r.udi, r.failure_probability, r.predicted_failure) for r in spark.read.parquet(sink).collect()}
    batch = {(r.udi, r.failure_probability, r.predicted_failure)
             for r in predict_rows(model, 0.05, machine, S.features, keep=["udi"]).collect()}
    assert streamed == batch and len(streamed) == machine.count()
