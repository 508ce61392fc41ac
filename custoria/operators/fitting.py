"""Fitting of Spark ML models that can go to the tasks of any session."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, SparkSession

from custoria.session import workspace


def without_summary(model: Model, spark: SparkSession) -> Model:
    """The model without its training summary.

    A summary holds the session, and the prediction functions hold the model. Once a session has
    run an Observation it cannot be serialized, and with it no model that has a summary.
    """
    if getattr(model, "hasSummary", False):
        model = model.copy()  # copies of forests and support vector machines have no summary
    if getattr(model, "hasSummary", False):
        path = workspace(spark)
        model.save(path)
        model = type(model).load(path)
    return model


def fitted(estimator: Estimator, rows: DataFrame) -> Model:
    return without_summary(estimator.fit(rows), rows.sparkSession)
