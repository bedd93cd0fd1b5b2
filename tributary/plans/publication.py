"""Layers published in one step (K4-K6): versioned folders and one pointer.

A job that overwrites a layer in place shows its readers half a table while it
writes, and nothing but a repeat mends a run that stops. ``publish`` gives a job
new folders for the layers it writes; when it has ended, one manifest names them
for all layers at once. Readers take their folders from the manifest, so they
see Silver, quarantine and Gold of one run, whole, at any time: a run that stops
before the switch changes nothing for them.

For full runs: a windowed Silver run replaces dates of the stored layer, and a
new version would hold its window only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import replace
from typing import TypeVar

from pyspark.sql import SparkSession

from tributary.plans.jobs import LakeConfig, run_bronze_to_silver, run_silver_to_gold
from tributary.sinks.manifest import Manifest
from tributary.sources.lake import child_folders, delete_folder, lake_path

VERSIONED_LAYERS = ("silver", "quarantine", "gold")
T = TypeVar("T")


def _manifest(spark: SparkSession, config: LakeConfig) -> Manifest:
    return Manifest(spark, lake_path(config.base_uri, "checkpoints/published"))


def _versions(path: str) -> str:
    return f"{path.rstrip('/')}_versions"


def _at(config: LakeConfig, runs: dict[str, str]) -> LakeConfig:
    """The lake with the given versions of its layers."""
    paths = {f"{n}_path": f"{_versions(getattr(config, f'{n}_path'))}/{run}" for n, run in runs.items()}
    return replace(config, **paths)


def published(spark: SparkSession, config: LakeConfig) -> LakeConfig:
    """The lake as last published; a layer never published is where ``config``
    says. Every reader and check of the library works on it."""
    return _at(config, _manifest(spark, config).current() or {})


def publish(
    spark: SparkSession, config: LakeConfig, job: Callable[[LakeConfig], T], layers: Iterable[str] = VERSIONED_LAYERS
) -> T:
    """Run ``job`` on a lake whose ``layers`` are new folders, the others as
    published, then switch all of them at once; returns the job's result.

    If the job fails, its folders go and the published layers stay. Folders that
    neither the new nor the previous manifest names are deleted after the
    switch, so a reader may finish what it started on the previous version.
    """
    layers = list(layers)
    unknown = set(layers) - set(VERSIONED_LAYERS)
    if unknown:
        raise ValueError(f"Layers without versions: {sorted(unknown)}")
    manifest = _manifest(spark, config)
    before = manifest.current() or {}
    run = uuid.uuid4().hex
    now = before | dict.fromkeys(layers, run)
    fresh = _at(config, now)
    try:
        result = job(fresh)
        manifest.publish(now)
    except BaseException:
        for name in layers:
            delete_folder(spark, fresh.path(name))
        raise
    for name in layers:
        folder = _versions(config.path(name))
        for old in set(child_folders(spark, folder)) - {now[name], before.get(name)}:
            delete_folder(spark, f"{folder}/{old}")
    return result


def publish_lake(spark: SparkSession, config: LakeConfig, **silver_options) -> LakeConfig:
    """Bronze -> Silver and quarantine -> Gold as one published version; returns
    the lake to read. ``silver_options`` are those of a full Silver run."""
    windowed = {"start", "end", "lookback_days"} & {k for k, v in silver_options.items() if v is not None}
    if windowed:
        raise ValueError(f"A published version is a full run; {sorted(windowed)} would leave its window only.")

    def job(fresh: LakeConfig) -> None:
        run_bronze_to_silver(spark, fresh, **silver_options)
        run_silver_to_gold(spark, fresh)

    publish(spark, config, job)
    return published(spark, config)
