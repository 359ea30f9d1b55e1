"""Job parameters, session construction and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Fixed values that the trip jobs must share with the original jobs:
# time format of the delimited files, earth radius in km, and the bounding box
# (degrees) used to clean trips.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
EARTH_RADIUS_KM = 6371.0
LON_WEST, LON_EAST = -80.0, -70.0
LAT_SOUTH, LAT_NORTH = 40.0, 46.0


@dataclass(frozen=True)
class JobParams:
    """Parameters of the trip and search-log jobs (replaces command-line flags)."""

    lon_west: float = LON_WEST
    lon_east: float = LON_EAST
    lat_south: float = LAT_SOUTH
    lat_north: float = LAT_NORTH
    earth_radius_km: float = EARTH_RADIUS_KM
    time_format: str = TIME_FORMAT
    fastest_k: int = 5
    fastest_after_day: int = 10
    popular_min_visitors: int = 10
    popular_top: int | None = None  # None: the whole ranking
    keyword_top: int | None = None
    export_files: int | None = None  # None: file count sized by AQE from the data


def session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "quarry",
            conf: dict[str, str] | None = None) -> SparkSession:
    """Local session used by tests and the bench.

    On a cluster the caller builds the session; join strategies are hints, never
    session settings.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "10g")
        # local runs only: catalog tables of the tests stay out of the working directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="quarry-warehouse-"))
    )
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``, registered for checkpoints.

    Without that setting a folder set by ``setCheckpointDir`` is used. With neither,
    a local master gets a fresh temporary folder; on a cluster this is an error, since
    executors would each write to a disk of their own. No session setting is changed.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no local SparkContext
        sc = None
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and sc is not None:
        base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        master = sc.master if sc is not None else "connect"
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="quarry-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique output path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry-out/{name}-{uuid.uuid4().hex}"
