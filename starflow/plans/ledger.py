"""A refresh that is taken up where it stopped.

Each run writes what it read and which stages it finished, one small folder a stage. Taken up again, it goes on
after the last finished stage, if its input and settings are still the same; otherwise it refuses.
"""

from __future__ import annotations

import logging
import re
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from starflow.plans.refresh import STAGES, RefreshConfig, load_counts
from starflow.sources import write_parquet

log = logging.getLogger(__name__)

_COLUMNS = "stage string, input string, settings string"


class ChangedInput(Exception):
    """A run was begun with other files or settings."""


def input_digest(spark: SparkSession, path: str | list[str]) -> str:
    """Of the names, lengths and times of all files, in any order; no file is read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    one = F.md5(F.concat_ws("|", "path", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string")))
    parts = [F.conv(F.substring(one, 1 + 8 * i, 8), 16, 10).cast("decimal(20, 0)") for i in range(4)]
    facts = files.agg(F.count(F.lit(1)).alias("n"), *[F.sum(p).alias(f"s{i}") for i, p in enumerate(parts)]).first()
    return "-".join(str(x) for x in facts)


def _settings(config: RefreshConfig) -> str:
    """What decides what the stages write; how they run does not."""
    kept = {k: v for k, v in asdict(config).items() if k not in ("concurrent", "spread", "max_records_per_file")}
    return repr(sorted(kept.items()))


def finished_stages(spark: SparkSession, config: RefreshConfig, run: str) -> DataFrame:
    """(stage, input, settings) of each stage that the run has finished."""
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError(f"not a name for a run: {run!r}")
    try:
        return spark.read.schema(_COLUMNS).parquet(f"{config.lake_root}/runs/{run}/*")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], _COLUMNS)


def run_once(spark: SparkSession, config: RefreshConfig, run: str, stages=None) -> DataFrame:
    """`run_refresh`, but only the stages that `run` has not finished. Returns the rows per warehouse table.

    A stage counts as finished once its note is written, which is after everything else of it; so one that stopped
    halfway is run again, and since every stage replaces all it writes, that gives what one run gives. `ChangedInput` if a
    finished stage saw other files or settings: a run with those needs another name.
    """
    stages = STAGES if stages is None else stages
    now = (input_digest(spark, config.raw_path), _settings(config))
    done = {r.stage: (r.input, r.settings) for r in finished_stages(spark, config, run).collect()}
    for stage, seen in done.items():
        if seen != now:
            what = "files" if seen[0] != now[0] else "settings"
            raise ChangedInput(f"run {run} finished {stage} with other {what}")
    for name, stage in stages.items():
        if name in done:
            log.info("run %s: %s was finished before", run, name)
            continue
        stage(spark, config)
        note = spark.createDataFrame([(name, *now)], _COLUMNS)
        write_parquet(note.coalesce(1), f"{config.lake_root}/runs/{run}/{name}")
    return load_counts(spark, config)
