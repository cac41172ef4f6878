"""Views that read views: stages run in order, each a function of the tables and earlier stages."""

from __future__ import annotations

import hashlib
import inspect
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from haulmark import files
from haulmark.session import cut_lineage, shared_folder
from haulmark.sources.writers import materialize


def view_dag(tables: Mapping[str, DataFrame], stages: Mapping[str, Callable[..., DataFrame]], as_of=None,
             keep: Sequence[str] = (), keys: Mapping[str, Sequence[str]] | None = None,
             folder: str | None = None) -> dict[str, DataFrame]:
    """Build every stage; a stage names its inputs as parameters (and may take ``as_of``).

    Stages in ``keep`` are read more than once, so they are written to ``folder``
    (or checkpointed) instead of being computed again; the rest stay lazy.
    """
    built = dict(tables)
    for name, build in stages.items():
        wanted = inspect.signature(build).parameters
        args = {p: as_of if p == "as_of" else built[p] for p in wanted}
        df = build(**args)
        if name in keep:
            key = (keys or {}).get(name)
            df = materialize(df, f"{folder.rstrip('/')}/{name}", key) if folder else cut_lineage(df)
        built[name] = df
    return {n: built[n] for n in stages}


def fingerprint(df: DataFrame) -> str | None:
    """What a frame over files would show: its plan without row numbers, and name, size and time of each file. None for other frames."""
    paths = df.inputFiles()
    if not paths:
        return None
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    return _digest(plan, *files.versions(df.sparkSession, paths))


def _digest(*parts) -> str:
    return hashlib.sha256("\n".join(map(str, parts)).encode()).hexdigest()


def _code(build: Callable) -> str:
    """Text of a stage and of what it closes over, as far as that has a text."""
    try:
        text = inspect.getsource(build)
    except (OSError, TypeError):
        text = repr(build.__code__.co_code) if hasattr(build, "__code__") else repr(build)
    held = [c.cell_contents for c in getattr(build, "__closure__", None) or ()]
    return text + "".join(repr(h) for h in held if isinstance(h, (str, int, float, bool, tuple, list, dict, type(None))))


def refresh(spark: SparkSession, tables: Mapping[str, DataFrame], stages: Mapping[str, Callable[..., DataFrame]], as_of=None, keep: Sequence[str] = (),
            keys: Mapping[str, Sequence[str]] | None = None, folder: str | None = None, versions: Mapping[str, str] | None = None,
            built: list | None = None) -> dict[str, DataFrame]:
    """``view_dag`` that builds a kept stage again only when something it depends on has changed.

    Each stage has a fingerprint: its code, ``as_of`` if it takes it, and the fingerprints of its inputs down to the tables. That of a
    table comes from its plan and files (see ``fingerprint``) or from ``versions``; a table with neither counts as changed.
    Kept stages are written below ``folder`` (the session's shared one by default) under their fingerprint and stay until the
    next refresh has replaced them. A run that breaks off leaves no fingerprint for what it did not finish. Code that a
    stage calls is not looked into: pass a version as a value it closes over, or remove the folder.
    Names of the kept stages that were built are added to ``built``.
    """
    root = (folder or f"{shared_folder(spark)}/views").rstrip("/")
    marks = {n: (versions or {}).get(n) or fingerprint(df) or _digest(uuid.uuid4()) for n, df in tables.items()}
    views = dict(tables)
    for name, build in stages.items():
        wanted = inspect.signature(build).parameters
        marks[name] = _digest(name, _code(build), *(f"as_of {as_of}" if p == "as_of" else marks[p] for p in wanted))
        at, done = f"{root}/{name}/{marks[name]}", f"{root}/{name}/{marks[name]}.done"
        if name not in keep:
            views[name] = build(**{p: as_of if p == "as_of" else views[p] for p in wanted})
            continue
        if not files.exists(spark, done):
            materialize(build(**{p: as_of if p == "as_of" else views[p] for p in wanted}), at, (keys or {}).get(name))
            files.write_new(spark, done, name)
            if built is not None:
                built.append(name)
        views[name] = spark.read.parquet(at)
    for name in keep:  # all stages are there: what earlier refreshes wrote is no longer read
        for old in files.names(spark, f"{root}/{name}"):
            if not old.startswith(marks[name]):
                files.delete(spark, f"{root}/{name}/{old}")
    return {n: views[n] for n in stages}
