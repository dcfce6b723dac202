"""The whole forecast run: clean, features, lookup, validation, training, evaluation, storage."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from skygalley.config import ForecastConfig
from skygalley.errors import ModelDegradationError
from skygalley.forecast import evaluation as ev
from skygalley.forecast.folds import test_part
from skygalley.forecast.models import TwoStageModel, decide, feature_importance, fit_two_stage, raw_predictions
from skygalley.forecast.preparation import build_features, clean_data, hist_lookup, validate
from skygalley.sources.sinks import append_or_replace, overwrite

log = logging.getLogger(__name__)


def run_forecast(
    mart: DataFrame,
    root: str,
    version: str,
    cfg: ForecastConfig | None = None,
    raise_on_degradation: bool = False,
    commit: str | None = None,
) -> TwoStageModel:
    """Train, evaluate at every threshold and store the results under ``root``.

    Results of a degraded model are logged and not stored, so the last good run stays the latest. A run that is repeated
    after a failure under the same ``commit`` (a new one unless stated) stores what is still missing.

    The cleaned rows and the features are written once: later steps read both many times, and a lost
    executor then costs a re-read and not a rebuild of the warehouse.
    """
    cfg = cfg or ForecastConfig()
    commit = commit or ev.new_commit()
    spark = mart.sparkSession
    root = root.rstrip("/")
    clean = overwrite(clean_data(mart), f"{root}/clean")
    features = overwrite(build_features(clean, cfg), f"{root}/features")
    append_or_replace(hist_lookup(features), root, "lookup_hist_avg")
    validate(features, cfg)
    model = fit_two_stage(features, cfg)
    model.save(f"{root}/models/{version}")
    raw = overwrite(
        raw_predictions(test_part(features, cfg.test_weeks), model, cfg), f"{root}/test_predictions"
    )
    for threshold_type, threshold in cfg.thresholds.items():
        decided = decide(raw, threshold)
        metrics = ev.evaluate(decided, cfg.target)
        runs = ev.stored_runs(spark, root)
        known = not runs.isEmpty()
        previous = ev.latest_accuracy(ev.run_table(spark, root, "model_metrics"), runs) if known else None
        degraded, message = ev.is_degraded(
            previous, metrics.first()["accuracy"], cfg.degradation_threshold
        )
        if degraded:
            if raise_on_degradation:
                raise ModelDegradationError(message)
            log.critical("%s: results of %s not stored. %s", threshold_type, version, message)
            continue
        ev.store_run(
            root,
            f"{commit}_{threshold_type}",
            version,
            threshold_type,
            threshold,
            metrics,
            ev.evaluate_by_item(decided, cfg.target),
            feature_importance(model, cfg, features),
        )
    return model
