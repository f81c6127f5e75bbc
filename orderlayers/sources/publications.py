"""Which version of a layer readers see.

Every run writes a fresh folder and then appends one row naming it; the newest row is
current. A run that dies before the append leaves readers on the old version, and its
folder is simply never named. One writer per layer at a time is assumed.

A run may write some buckets of a keyed layer only: its row then says for each bucket which
version's folder holds it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from orderlayers import schema as S
from orderlayers.sources.frames import one_row, path_exists, read_or_empty, remove_path

KEY_PARTS = ("ranges", "words")


def key_path(base: str, layer: str, part: str) -> str:
    """Where ranges or filter words of the buckets' keys lie."""
    return f"{base.rstrip('/')}/{layer}/keys/{part}"


def _log_path(base: str, layer: str) -> str:
    return f"{base.rstrip('/')}/{layer}/versions"


def data_path(base: str, layer: str) -> str:
    return f"{base.rstrip('/')}/{layer}/data"


def version_path(base: str, layer: str, version: str) -> str:
    return f"{data_path(base, layer)}/{version}"


def new_version() -> str:
    return f"v-{uuid.uuid4().hex}"


def publications(spark: SparkSession, base: str, layer: str) -> DataFrame:
    return read_or_empty(spark, spark.read, "json", _log_path(base, layer), S.PUBLICATION)


def current_version(spark: SparkSession, base: str, layer: str) -> Row | None:
    if not path_exists(spark, _log_path(base, layer)):
        return None
    newest = F.max_by(F.struct("*"), "seq").alias("newest")
    return publications(spark, base, layer).agg(newest).first()["newest"]


def bucket_holders(publication: Row) -> list[str]:
    """The version that holds each bucket."""
    names = publication["holders"].split(",")
    return [names[int(place)] for place in publication["held_by"].split(",")]


def publish(
    spark: SparkSession,
    base: str,
    layer: str,
    version: str,
    buckets: int,
    run_id: str | None,
    rows: int = 0,
    held_by: list[str] | None = None,
) -> None:
    """Make ``version`` current; ``held_by`` names the version of each bucket, by default this one."""
    held_by = held_by or [version] * buckets
    holders = sorted(set(held_by))
    place = {name: str(k) for k, name in enumerate(holders)}
    current = current_version(spark, base, layer)
    row = {
        "seq": current["seq"] + 1 if current else 1,
        "version": version,
        "buckets": buckets,
        "run_id": run_id,
        "published_at": F.current_timestamp(),
        "rows": rows,
        "holders": ",".join(holders),
        "held_by": ",".join(place[name] for name in held_by),
    }
    one_row(spark, S.PUBLICATION, row).write.mode("append").json(_log_path(base, layer))


def drop_old_versions(spark: SparkSession, base: str, layer: str, keep: int = 1) -> list[str]:
    """Delete the data that none of the ``keep`` newest publications needs; return the folders' versions.

    Folders of runs that died go too, so no run may be writing the layer meanwhile. Of a folder
    that is still needed for some of its buckets, the others go. What is known of the keys of
    deleted folders goes with them. A layer that never published
    anything is left alone.
    """
    newest = publications(spark, base, layer).orderBy(F.desc("seq")).limit(max(keep, 1)).collect()
    needed: dict[str, set[str]] = {row["version"]: set() for row in newest}
    for row in newest:
        for bucket, version in enumerate(bucket_holders(row) if row["buckets"] else ()):
            needed.setdefault(version, set()).add(str(bucket))
    data = data_path(base, layer)
    if not needed or not path_exists(spark, data):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(data)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for entry in files.listStatus(folder):
        _, partitioned, version = entry.getPath().getName().rpartition("=")
        if not entry.isDirectory():
            continue
        if version not in needed:
            if files.delete(entry.getPath(), True):
                dropped.append(version)
        elif partitioned:
            for part in files.listStatus(entry.getPath()):
                if part.getPath().getName().rpartition("=")[2] not in needed[version]:
                    files.delete(part.getPath(), True)
    for kind in KEY_PARTS:
        for version in dropped:
            remove_path(spark, f"{key_path(base, layer, kind)}/version={version}")
    return dropped
