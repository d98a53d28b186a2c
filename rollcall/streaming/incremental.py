"""Score only what has not been scored, again and again.

Predictions are stored by model and run: ``root/algorithm_id=A/run=R``. A run sees the predictions of all other
runs and overwrites its own folder, so repeating a run, whether by hand or because a stream replays a batch,
gives the same table and never scores a record twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from rollcall import DEFAULT_KEY
from rollcall.modelling.matrix import scoring_matrix
from rollcall.modelling.scoring import score, with_net_score
from rollcall.operators.relational import not_yet_in
from rollcall.plans.spec import ModelSpec


def stored_predictions(spark: SparkSession, root: str, schema: str | T.StructType, skip_run: str | None = None) -> DataFrame:
    """All stored predictions but those of one run; empty if nothing is stored. ``run`` is text."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*fields.fields, T.StructField("algorithm_id", T.LongType()), T.StructField("run", T.StringType())])
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], full)
    found = spark.read.schema(full).parquet(root)
    return found if skip_run is None else found.filter(F.col("run") != skip_run)


def write_run(scores: DataFrame, root: str, algorithm_id: int, run: str) -> None:
    scores.write.mode("overwrite").parquet(f"{root.rstrip('/')}/algorithm_id={algorithm_id}/run={run}")


def score_new(
    spec: ModelSpec,
    model: PipelineModel,
    algorithm_id: int,
    tables: Mapping[str, DataFrame],
    predictions: DataFrame,
    net: tuple[str, str] | None = None,
    key: Sequence[str] = DEFAULT_KEY,
    unique: bool = True,
) -> DataFrame:
    """Scores of the records this model has not scored, with ``algorithm_id``.

    ``net`` names the best and the worst class of a model with three or more classes; then ``score`` is added.
    """
    rows = scoring_matrix(spec, tables, predictions, algorithm_id, key, unique)
    scored = score(model, rows, key)
    if net:
        scored = with_net_score(scored, *net)
    return scored.withColumn("algorithm_id", F.lit(algorithm_id).cast("long"))


def score_by_cohort(
    models: Mapping[str, tuple[ModelSpec, PipelineModel, int]],
    tables: Mapping[str, DataFrame],
    predictions: DataFrame,
    net: tuple[str, str] | None = None,
    key: Sequence[str] = DEFAULT_KEY,
    unique: bool = True,
) -> DataFrame:
    """Several production models side by side, each for its own cohort. Models are matched by name."""
    for name, (spec, _, _) in models.items():
        if name != spec.name:
            raise ValueError(f"model {name} comes with the specification of {spec.name}")
    parts = [score_new(s, m, i, tables, predictions, net, key, unique) for s, m, i in models.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def daily_run(
    spec: ModelSpec,
    model: PipelineModel,
    algorithm_id: int,
    tables: Mapping[str, DataFrame],
    root: str,
    run: str,
    schema: str | T.StructType,
    net: tuple[str, str] | None = None,
    key: Sequence[str] = DEFAULT_KEY,
) -> bool:
    """One scheduled run; False, and nothing written, if there is nothing new."""
    spark = next(iter(tables.values())).sparkSession
    new = score_new(spec, model, algorithm_id, tables, stored_predictions(spark, root, schema, run), net, key)
    if new.isEmpty():
        return False
    write_run(new.drop("algorithm_id"), root, algorithm_id, run)
    return True


def score_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    scorer: Callable[[DataFrame], DataFrame],
    root: str,
    stored_schema: str | T.StructType,
    checkpoint: str,
    algorithm_id: int,
    key: Sequence[str] = DEFAULT_KEY,
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> StreamingQuery:
    """Score files as they arrive in a folder, then stop when all present ones are done.

    ``prepare`` turns source rows into keyed rows before the check for what is scored already. A record that
    arrives twice is scored once. Each batch writes its own run, so a replayed batch replaces what it wrote.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        run = f"batch-{batch_id}"
        done = stored_predictions(batch.sparkSession, root, stored_schema, run)
        done = done.filter(F.col("algorithm_id") == algorithm_id)
        fresh = not_yet_in(prepare(batch).dropDuplicates(list(key)), done, key)
        write_run(scorer(fresh), root, algorithm_id, run)

    return (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
