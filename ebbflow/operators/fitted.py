"""Fitted models that are plain parameters: saved as one JSON text, written
and loaded like a Spark ML model, applied as one column in batch and stream."""

from __future__ import annotations

import json

from pyspark.sql import Column, SparkSession

KINDS: dict[str, type] = {}


class Fitted:
    """``column()`` is the probability of class 1, null where a feature is missing."""

    def __init_subclass__(cls):
        KINDS[cls.__name__] = cls

    def column(self) -> Column:
        raise NotImplementedError

    def to_dict(self) -> dict:
        raise NotImplementedError

    @classmethod
    def from_dict(cls, d: dict) -> Fitted:
        raise NotImplementedError

    def write(self) -> Writer:
        return Writer(self)


class Writer:
    def __init__(self, model: Fitted):
        self._model, self._mode = model, "errorifexists"

    def overwrite(self) -> Writer:
        self._mode = "overwrite"
        return self

    def save(self, path: str) -> None:
        text = json.dumps({"kind": type(self._model).__name__} | self._model.to_dict())
        (SparkSession.getActiveSession().createDataFrame([(text,)], "value string").coalesce(1)
         .write.mode(self._mode).text(f"{path}/fitted"))


def load(spark: SparkSession, path: str) -> Fitted:
    d = json.loads(spark.read.text(f"{path}/fitted").first()["value"])
    return KINDS[d.pop("kind")].from_dict(d)
