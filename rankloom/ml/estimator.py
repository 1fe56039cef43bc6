"""Estimator/Model pair around a user-supplied learner."""

from __future__ import annotations

from collections.abc import Callable
from types import SimpleNamespace

from pyspark import cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame

from rankloom.ml.scoring import score_partitions
from rankloom.operators.sampling import repeat_epochs
from rankloom.sources.tfrecord import read_tfrecords, write_tfrecords


def _to_dict(value) -> dict[str, str]:
    if isinstance(value, dict):
        return {str(k): str(v) for k, v in value.items()}
    raise TypeError(f"expected a dict, got {type(value).__name__}")


class RankerParams(Params):
    """Settings shared by estimator and model."""

    batch_size = Param(Params._dummy(), "batch_size", "rows per scoring batch", TypeConverters.toInt)
    epochs = Param(Params._dummy(), "epochs", "times the data is fed", TypeConverters.toInt)
    steps = Param(Params._dummy(), "steps", "optimizer steps", TypeConverters.toInt)
    input_mapping = Param(Params._dummy(), "input_mapping", "column -> model input", _to_dict)
    output_mapping = Param(Params._dummy(), "output_mapping", "model output -> column", _to_dict)
    model_dir = Param(Params._dummy(), "model_dir", "where the trained model is kept", TypeConverters.toString)
    export_dir = Param(Params._dummy(), "export_dir", "where the serving model is exported", TypeConverters.toString)
    tfrecord_dir = Param(Params._dummy(), "tfrecord_dir", "export training data here first", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(batch_size=100, epochs=1, steps=1000, input_mapping={}, output_mapping={})

    def configure(self, **values):
        return self._set(**values)

    def merged(self, args: dict) -> SimpleNamespace:
        """User arguments overridden by explicitly set params."""
        values = {p.name: self.getOrDefault(p) for p in self.params if self.hasDefault(p)}
        values.update(args)
        values.update({p.name: self.getOrDefault(p) for p in self.params if self.isSet(p)})
        return SimpleNamespace(**values)


class _Writer(MLWriter):
    """Params as metadata, what the instance was made of (code included) as one pickled row."""

    def __init__(self, instance) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        data = bytearray(cloudpickle.dumps(self.instance.made_of()))
        self.sparkSession.createDataFrame([(data,)], "made_of binary").coalesce(1).write.parquet(f"{path.rstrip('/')}/data")


class _Reader(MLReader):
    def __init__(self, cls) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        data = self.sparkSession.read.parquet(f"{path.rstrip('/')}/data").first()["made_of"]
        instance = self.cls(*cloudpickle.loads(bytes(data)))
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        return instance


class Kept(MLWritable, MLReadable):
    """``save`` and ``load``, alone or as a stage of a saved pipeline.

    Only load what you trust: the files hold code.
    """

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class RankerEstimator(Estimator, RankerParams, Kept):
    """Fits ``train_fn(df, args) -> model state`` and wraps the result.

    ``load_fn(state, args) -> predict`` builds the scorer on a worker and must
    be picklable; ``export_fn(state, args)`` runs once after training.
    """

    def __init__(self, train_fn: Callable, load_fn: Callable, args: dict | None = None, export_fn: Callable | None = None):
        super().__init__()
        self.train_fn, self.load_fn, self.export_fn, self.args = train_fn, load_fn, export_fn, dict(args or {})

    def made_of(self) -> tuple:
        return self.train_fn, self.load_fn, self.args, self.export_fn

    def _fit(self, dataset: DataFrame) -> "RankerModel":
        args = self.merged(self.args)
        columns = sorted(self.getOrDefault("input_mapping"))
        data = dataset.select(*columns) if columns else dataset
        if self.isSet("tfrecord_dir"):
            schema = data.schema
            write_tfrecords(data, args.tfrecord_dir, mode="overwrite")
            data = read_tfrecords(dataset.sparkSession, args.tfrecord_dir, schema=_example_schema(schema))
        if args.epochs > 1:
            data = repeat_epochs(data, args.epochs)
        state = self.train_fn(data, args)
        if self.export_fn is not None:
            if not self.isSet("export_dir"):
                raise ValueError("an export function needs export_dir")
            self.export_fn(state, args)
        model = self._copyValues(RankerModel(state, self.load_fn, self.args))
        if self.isSet("model_dir"):
            model.write().session(dataset.sparkSession).overwrite().save(args.model_dir)
        return model


class RankerModel(Model, RankerParams, Kept):
    """Scores with a model that is loaded once per Python worker."""

    def __init__(self, state, load_fn: Callable, args: dict | None = None):
        super().__init__()
        self.state, self.load_fn, self.args = state, load_fn, dict(args or {})

    def made_of(self) -> tuple:
        return self.state, self.load_fn, self.args

    def _transform(self, dataset: DataFrame) -> DataFrame:
        args, state, load_fn = self.merged(self.args), self.state, self.load_fn
        mapping = self.getOrDefault("input_mapping")
        scored = {c for c in mapping if c in dataset.columns}
        return score_partitions(
            dataset,
            lambda: load_fn(state, args),
            inputs={c: name for c, name in mapping.items() if c in scored},
            outputs=self.getOrDefault("output_mapping"),
            batch_size=args.batch_size,
            keep=dataset.columns,
        )


def _example_schema(schema):
    from pyspark.sql import types as T

    from rankloom.sources.tfrecord import read_type

    return T.StructType(
        [T.StructField(f.name, T._parse_datatype_string(read_type(f.dataType.simpleString()))) for f in schema.fields]
    )
