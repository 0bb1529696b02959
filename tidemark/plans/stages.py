"""pyspark.ml stages over the expression operators (V2, V5), so they compose
in a ``Pipeline`` with MLlib estimators:

    Pipeline(stages=[StringFeatures(spec), Preprocessor(log, scale),
                     VectorAssembler(...), RandomForestClassifier(...)])

Their settings are Params, and pipelines that hold them can be saved and loaded.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame

from tidemark.config import FeatureSpec, Roles
from tidemark.functions.features import engineer
from tidemark.operators.preprocess import FittedPreprocessor, fit_preprocessor


def _param(name: str, doc: str, kind=TypeConverters.toString) -> Param:
    return Param(Params._dummy(), name, doc, kind)


def _tuples(values: dict) -> dict:
    return {k: tuple(v) if isinstance(v, list) else v for k, v in values.items()}


class StringFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """F9 as a Transformer: adds the eight engineered columns."""

    spec = _param("spec", "roles of the string columns, as JSON")

    def __init__(self, spec: FeatureSpec = FeatureSpec()):
        super().__init__()
        self._set(spec=json.dumps(asdict(spec)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return engineer(dataset, FeatureSpec(**_tuples(json.loads(self.getOrDefault("spec")))))


class _Columns(Params):
    logCols = _param("logCols", "columns that are log-scaled first", TypeConverters.toListString)
    scaleCols = _param("scaleCols", "other columns", TypeConverters.toListString)


class PreprocessorModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """M5 apply: the feature columns are replaced by their standardised
    values (statistics inlined as literals); other columns pass through."""

    stats = _param("stats", "statistics of the training frame by feature, as JSON")

    def __init__(self, fitted: FittedPreprocessor | None = None):
        super().__init__()
        if fitted is not None:
            self._set(logCols=list(fitted.log_cols), scaleCols=list(fitted.scale_cols), stats=json.dumps(fitted.stats))

    @property
    def fitted(self) -> FittedPreprocessor:
        return FittedPreprocessor(tuple(self.getOrDefault("logCols")), tuple(self.getOrDefault("scaleCols")),
                                  json.loads(self.getOrDefault("stats")))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = self.fitted
        return dataset.withColumns(dict(zip(fitted.columns, fitted.feature_exprs())))


class Preprocessor(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """M5 fit on the training frame only (exact medians, mean / population std)."""

    def __init__(self, log_cols: Sequence[str] = (), scale_cols: Sequence[str] = ()):
        super().__init__()
        self._set(logCols=list(log_cols), scaleCols=list(scale_cols))

    def _fit(self, dataset: DataFrame) -> PreprocessorModel:
        return PreprocessorModel(fit_preprocessor(dataset, self.getOrDefault("logCols"), self.getOrDefault("scaleCols")))


class _EnsembleWriter(MLWriter):
    def __init__(self, model: WindowedEnsembleModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802 - MLWriter's name
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.ensemble.save(f"{path}/ensemble")


class _EnsembleReader(MLReader):
    def load(self, path: str) -> WindowedEnsembleModel:
        from tidemark.plans import training
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = WindowedEnsembleModel(training.WindowedEnsemble.load(self.sparkSession, f"{path}/ensemble"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class WindowedEnsembleModel(Model, MLReadable, MLWritable):
    """Adds p_0..p_{K-1}, probability, disagreement, confidence,
    verdict and is_positive_decision to the columns ``keep`` (all, if none)."""

    keep = _param("keep", "columns that stay", TypeConverters.toListString)

    def __init__(self, ensemble, keep: Sequence[str] = ()):
        super().__init__()
        self.ensemble = ensemble
        self._set(keep=list(keep))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.ensemble.decide(dataset, self.getOrDefault("keep") or list(dataset.columns))

    def write(self) -> MLWriter:
        return _EnsembleWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EnsembleReader()


class WindowedEnsemble(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """E1 + E2 as an Estimator; the base model is named by its preset."""

    preset = _param("preset", "name of the base model's preset")
    roles = _param("roles", "roles of the columns, as JSON")
    k = _param("k", "windows", TypeConverters.toInt)

    def __init__(self, preset: str = "forest", log_cols: Sequence[str] = (), scale_cols: Sequence[str] = (),
                 roles: Roles = Roles(), k: int = 5):
        super().__init__()
        self._set(preset=preset, logCols=list(log_cols), scaleCols=list(scale_cols), roles=json.dumps(asdict(roles)), k=k)

    def _fit(self, dataset: DataFrame) -> WindowedEnsembleModel:
        from tidemark.plans.training import PRESETS, fit_windowed
        return WindowedEnsembleModel(fit_windowed(
            dataset, PRESETS[self.getOrDefault("preset")], self.getOrDefault("logCols"), self.getOrDefault("scaleCols"),
            Roles(**json.loads(self.getOrDefault("roles"))), self.getOrDefault("k")))
