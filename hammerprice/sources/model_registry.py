"""Versioned models and the log of champions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from hammerprice.sources.commit_log import CommitLog


class PromotionConflict(RuntimeError):
    """Another model became champion in the meantime."""


@dataclass(frozen=True)
class Champion:
    sequence: int
    version: str
    path: str
    settings: dict

    def load(self) -> PipelineModel:
        return PipelineModel.load(self.path)


def _log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root.rstrip('/')}/champions")


def save_model(model: PipelineModel, root: str, version: str) -> str:
    path = f"{root.rstrip('/')}/versions/{version}"
    model.write().overwrite().save(path)
    return path


def _newest(log: CommitLog) -> Champion | None:
    found = log.latest()
    return found and Champion(found[0], found[1]["version"], found[1]["path"], found[1]["settings"])


def current_champion(spark: SparkSession, root: str) -> Champion | None:
    return _newest(_log(spark, root))


def promote_model(
    spark: SparkSession, model: PipelineModel, root: str, version: str, settings: Mapping,
    against: Champion | None = None, still_better: Callable[[Champion], bool] | None = None,
) -> Champion:
    """Save the model under its own version, then commit it as the next champion.

    It succeeds the champion that it was compared with: `against`, or the one in place when the call starts. Where another
    model has come in between, `still_better` is asked whether this one beats that one too, and the commit is tried again;
    without it, or where it says no, the promotion ends in `PromotionConflict` and there is no second champion.
    """
    log = _log(spark, root)
    rival = against or _newest(log)
    path = save_model(model, root, version)
    while True:
        champion = Champion(rival.sequence + 1 if rival else 1, version, path, dict(settings))
        content = {"version": version, "path": path, "settings": champion.settings}
        if log.commit(champion.sequence, content | {"promoted_at": dt.datetime.now(dt.timezone.utc).isoformat()}):
            return champion
        rival = _newest(log)
        if still_better is None or not still_better(rival):
            raise PromotionConflict(f"{rival.version} became champion {rival.sequence} before {version}")
