"""Session and scratch-folder helpers for tests, the benchmark and local use.

On a cluster the session arrives configured; nothing here overrides what is set.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def local_session(cores: str = "8", memory: str = "8g", app: str = "rowharbor") -> SparkSession:
    """A local session with the settings the library is tested under."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the Python call site of every column costs more than building the column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A fresh machine-local folder is used only where the setting is absent and the
    master is local, which is the case in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="rowharbor-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Folder of this driver's named scratch, apart from that of other drivers.
_RUN = uuid.uuid4().hex
_under: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path inside the shared folder that no earlier run has used."""
    return "/".join([shared_folder(spark), "rowharbor", *_under[-1:], f"{label}-{uuid.uuid4().hex}"])


@contextmanager
def scratch_under(name: str) -> Iterator[None]:
    """Scratch written within is kept together, so that :func:`drop_scratch` can delete it by name."""
    _under.append(f"{_RUN}-{name}")
    try:
        yield
    finally:
        _under.pop()


def drop_scratch(spark: SparkSession, name: str) -> None:
    """Delete what was written under a name. DataFrames that still read it stop working."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/rowharbor/{_RUN}-{name}")
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: Bytes of a row group in tables whose later stages are to be shared out. A row group is read by one task, and one of the
#: usual size holds millions of narrow rows.
ROW_GROUP = 1 << 20


def cut_lineage(df: DataFrame, label: str, row_group: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where several actions read the same stage: the stage runs once, the copy
    survives lost executors, and later reads still prune columns. With ``row_group`` a file is written in row groups of
    so many bytes, so that many tasks can read what one task has written.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write if row_group is None else df.write.option("parquet.block.size", row_group)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_and_count(df: DataFrame, label: str, counts: Mapping[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """:func:`cut_lineage` in small row groups, with aggregates of the rows that the same write observes."""
    seen = Observation()
    stored = cut_lineage(df.observe(seen, *[c.alias(name) for name, c in counts.items()]), label, ROW_GROUP)
    return stored, {name: seen.get[name] for name in counts}


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own estimate of the rows is within its broadcast limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit
