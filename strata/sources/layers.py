"""Stored layers shared by all queries over the same snapshot of their sources.

A layer that several queries fan out is written once. Its folder is named by a
fingerprint of the source files, so a later query over the same snapshot reads the
copy, and a changed source gives a new one:

    <shared folder>/strata/layers/<name>-<sources>/<snapshot>/<copy>

A copy counts once its mark exists, which is written after the rows and only if the
sources did not change meanwhile; an interrupted job leaves a folder that nobody reads.
Two jobs writing at once leave two equal copies.
"""

from __future__ import annotations

import hashlib
import inspect
import time
import uuid
from collections.abc import Callable, Iterable
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_root
from strata.sources import fs, sinks

#: Session settings that can change the rows of a layer.
SETTINGS = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")

MARK = "_COMPLETE"
#: Writes that a changing source may spoil before the call gives up.
ATTEMPTS = 3


def _digest(*parts: object) -> str:
    return hashlib.sha256("\n".join(map(str, parts)).encode()).hexdigest()[:16]


def layers_root(spark: SparkSession) -> str:
    """The folder of all layers. It lies in `spark.checkpoint.dir` itself where that is
    set, so that sessions share it; Spark's own folder in there is new per session."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return f"{(named or checkpoint_root(spark)).rstrip('/')}/strata/layers"


def snapshot(spark: SparkSession, sources: Iterable[str]) -> str:
    """A fingerprint of the files under `sources`: path, length and modification time
    of each, whatever order they are listed in. The listing is Spark's own, no content
    is read, and one row reaches the driver."""
    seen = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sorted(sources)).select("path", "length", "modificationTime")
    hashes = [F.xxhash64(F.lit(salt), "path", "length", "modificationTime") for salt in (1, 2)]
    row = seen.agg(F.count(F.lit(1)), F.sum("length"), *[F.bit_xor(h) for h in hashes]).first()
    return _digest(*row)


def rules_digest(*modules: ModuleType) -> str:
    """A digest of the code that makes a layer: changed rules do not find old copies."""
    return _digest(*[inspect.getsource(m) for m in modules])


def _home(spark: SparkSession, name: str, sources: Iterable[str]) -> str:
    return f"{layers_root(spark)}/{name}-{_digest(*sorted(sources))}"


def _complete(spark: SparkSession, folder: str) -> list[str]:
    return [f"{folder}/{n}" for n in fs.names(spark, folder) if fs.exists(spark, f"{folder}/{n}/{MARK}")]


def stored(spark: SparkSession, build: Callable[[], DataFrame], name: str, sources: Iterable[str], rules: str = "", keep_seconds: float = 86400.0) -> DataFrame:
    """What `build` makes, read from the copy of the current snapshot of `sources`, written first if there is none.

    `build` returns a lazy DataFrame that depends on the files under `sources` and on the
    code that `rules` names (see `rules_digest`) alone. Any copy that has its columns
    serves, the one with the fewest columns first, so a narrow request reads a wide layer
    and a wide one adds a copy. Writing a copy drops those of older snapshots that are at
    least `keep_seconds` old; readers of a lazy result have that long. If the sources
    change during the write, the copy is dropped and made again, at most three times.
    """
    sources = list(sources)
    home = _home(spark, name, sources)
    for _ in range(ATTEMPTS):
        taken = snapshot(spark, sources)
        df = build()
        folder = f"{home}/{_digest(taken, rules, *[spark.conf.get(s) for s in SETTINGS])}"
        found = [spark.read.parquet(copy) for copy in _complete(spark, folder)]
        fitting = [c for c in found if set(df.columns) <= set(c.columns)]
        if fitting:
            return min(fitting, key=lambda c: len(c.columns)).select(*df.columns)
        copy = f"{folder}/{uuid.uuid4().hex[:12]}"
        out = sinks.stage(df, copy)
        if snapshot(spark, sources) == taken:
            fs.write_text(spark, f"{copy}/{MARK}", "complete\n")
            _drop_older(spark, home, folder, keep_seconds)
            return out
        fs.delete(spark, copy)
    raise RuntimeError(f"the sources of layer {name} changed during each of {ATTEMPTS} writes")


def _drop_older(spark: SparkSession, home: str, current: str, keep_seconds: float) -> list[str]:
    """Drop the copies of other snapshots last written `keep_seconds` ago or earlier."""
    old = [f"{home}/{n}" for n in fs.names(spark, home) if f"{home}/{n}" != current]
    copies = [f"{folder}/{n}" for folder in old for n in fs.names(spark, folder)]
    mark = lambda c: f"{c}/{MARK}" if fs.exists(spark, f"{c}/{MARK}") else c
    dropped = [c for c in copies if fs.modified(spark, mark(c)) <= time.time() - keep_seconds]
    for copy in dropped:
        fs.delete(spark, copy)
    for folder in old:
        if not fs.names(spark, folder):
            fs.delete(spark, folder)
    return dropped


def drop(spark: SparkSession, name: str | None = None) -> None:
    """Drop every copy of one layer, or of all. To run when no reader uses them any more."""
    root = layers_root(spark)
    for n in fs.names(spark, root):
        if name is None or n.rsplit("-", 1)[0] == name:
            fs.delete(spark, f"{root}/{n}")
