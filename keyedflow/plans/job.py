"""From a settings row to a running job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery

from keyedflow.config import MessageConfig
from keyedflow.plans.pipeline import Sinks, batch_handler, file_sinks
from keyedflow.streaming.runner import start_stream


@dataclass(frozen=True)
class Job:
    """What a settings row decides: where the tables and the checkpoint are, and the query's name."""

    name: str
    sinks: Sinks
    checkpoint: str


def job_from_setting(spark: SparkSession, setting: Row, config: MessageConfig) -> Job:
    """Sinks and checkpoint from the folders of a settings row: ``raw_dir``, ``product_dir``, ``checkpoint_dir``.

    A folder that the row leaves empty is an error, not a default.
    """
    folders = {c: setting[c] for c in ("raw_dir", "product_dir", "checkpoint_dir")}
    missing = sorted(c for c, path in folders.items() if not path)
    if missing:
        raise ValueError(f"settings row of module {setting['module_name']!r} has no {', '.join(missing)}")
    sinks = file_sinks(spark, folders["product_dir"], config, raw_path=folders["raw_dir"])
    return Job(setting["module_name"], sinks, folders["checkpoint_dir"])


def start_job(messages: DataFrame, job: Job, config: MessageConfig, **options) -> StreamingQuery:
    """Stream decoded messages through the job's sinks; ``options`` are those of ``start_stream``."""
    return start_stream(messages, batch_handler(config, job.sinks), job.checkpoint, job.name, **options)
