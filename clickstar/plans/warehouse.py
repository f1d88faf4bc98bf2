"""The star schema over the supplied tables, written step by step on first use.

Stage tables, dimensions and the conformed facts are tables, as each feeds many
readers: writing one cuts the lineage, lets readers fetch only the columns they
need, and gives the planner real sizes to choose join strategies by. Everything
read once stays a lazy plan.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from clickstar.operators import dims as D
from clickstar.operators import facts, marts, monitor, quality, rollup, stage, tables
from clickstar.params import RunParams
from clickstar.schemas import TABLES
from clickstar.session import prepare_wide, shared_dir, side_by_side
from clickstar.sources import adapter, raw


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, params: RunParams | None = None,
                 root: str | None = None) -> None:
        self.spark = prepare_wide(spark)
        self.sf_dir = sf_dir
        self.params = params or RunParams()
        tag = hashlib.sha256(sf_dir.encode()).hexdigest()[:10]
        app = spark.sparkContext.applicationId
        self.root = root or f"{shared_dir(spark)}/clickstar-{app}/{tag}"
        self._written: set[str] = set()
        self._fresh = 0

    # --- sources ---------------------------------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        return adapter.read_events(self.spark, self.sf_dir)

    @cached_property
    def run_log(self) -> DataFrame:
        return adapter.run_log(self.events)

    @cached_property
    def query_log(self) -> DataFrame:
        return adapter.query_log(self.events)

    @cached_property
    def raw(self) -> DataFrame:
        """The export as a projection of the events, for plans that read it once."""
        return raw.with_suffix(adapter.raw_export(self.events))

    @cached_property
    def flat(self) -> DataFrame:
        """Flat events as a plan; ``table('stg_events_flat')`` is the written form."""
        return stage.flatten(self.raw)

    @property
    def export(self) -> DataFrame:
        """The written export, one folder per day."""
        return raw.open_export(self.spark, self.path("raw_events"))

    # --- written tables ----------------------------------------------------------------

    def path(self, name: str) -> str:
        """Folder of a table, written on first use."""
        path = f"{self.root}/{name}"
        if name not in self._written:
            self._write(name, path)
            self._written.add(name)
        return path

    def scratch(self, name: str) -> str:
        """A folder for the result of a sink."""
        return f"{self.root}/sinks/{name}"

    def fresh(self, name: str) -> str:
        """A folder that no call before has written to."""
        self._fresh += 1
        return self.scratch(f"{name}-{self._fresh}")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _write(self, name: str, path: str) -> None:
        rows = self._build(name)
        layout = TABLES.get(name.removesuffix("_real"))
        if name == "raw_events":
            tables.write_partitioned(rows, path, "event_date")
        elif layout is not None and layout.partition:
            # facts read tables whose files hold one day each already
            tables.write_partitioned(rows, path, layout.partition, layout.cluster,
                                     rebalance=not name.startswith("fact_"),
                                     lookups=layout.lookups)
        else:
            tables.write_replace(rows, path)

    def _build(self, name: str) -> DataFrame:
        if name == "raw_events":
            return adapter.raw_export(self.events)
        if name == "stg_events_flat":
            return self.flat
        if name == "stg_sessions":
            return stage.sessions(self.table("stg_events_flat"))
        if name == "stg_sessions_real":
            return stage.sessions(self.table("stg_events_flat"), "event")
        if name == "dim_date":
            return D.dim_date(self.spark)
        if name == "mart_rollup":
            return rollup.daily_rollup(self.mart_sessions())
        if name == "fact_sessions":
            return facts.fact_sessions(self.table("stg_sessions_real"), self.dims(True), True)
        if name == "fact_events":
            return facts.fact_events(self.table("stg_events_flat"), self.dims(True, True), True)
        if name == "fact_conversions":
            return facts.fact_conversions(self.table("stg_events_flat"), self.dims(True, True),
                                          True)
        kind, _, form = name.partition("__")
        dim = D.DIMENSIONS[kind]
        rows = self.table("stg_sessions" if dim is D.CHANNEL else "stg_events_flat")
        return D.conformed(rows, dim) if form else D.members(rows, dim)

    # --- star --------------------------------------------------------------------------

    def dim(self, name: str, conformed: bool = False) -> DataFrame:
        return self.table(f"{name}__conformed" if conformed else name)

    def dims(self, conformed: bool = False, events: bool = False,
             date: bool = False) -> dict[str, DataFrame]:
        names = ["dim_device", "dim_geo", "dim_campaign", "dim_channel"]
        names += ["dim_event_type"] if events else []
        self.path("stg_sessions")
        side_by_side(self.spark, [lambda n=n: self.dim(n, conformed) for n in names])
        out = {n: self.dim(n, conformed) for n in names}
        if date:
            out["dim_date"] = self.table("dim_date")
        return out

    def fact_sessions(self, conformed: bool = False) -> DataFrame:
        if conformed:
            return self.table("fact_sessions")
        return facts.fact_sessions(self.table("stg_sessions"), self.dims())

    def fact_events(self, conformed: bool = False) -> DataFrame:
        if conformed:
            return self.table("fact_events")
        return facts.fact_events(self.table("stg_events_flat"), self.dims(events=True))

    def fact_conversions(self, conformed: bool = False) -> DataFrame:
        if conformed:
            return self.table("fact_conversions")
        return facts.fact_conversions(self.table("stg_events_flat"), self.dims(events=True))

    def mart_sessions(self, conformed: bool = True) -> DataFrame:
        return marts.mart_sessions(self.fact_sessions(conformed),
                                   self.dims(conformed, date=True))

    def mart_conversions(self, conformed: bool = True) -> DataFrame:
        return marts.mart_conversions(self.fact_conversions(conformed),
                                      self.dims(conformed, True, True))

    # --- operational tables --------------------------------------------------------------

    def partition_stats(self) -> DataFrame:
        """Sizes of the two stage tables."""
        return monitor.partition_stats(
            self.table("stg_events_flat"), "stg_events_flat", "event_date_partition"
        ).unionByName(monitor.partition_stats(
            self.table("stg_sessions"), "stg_sessions", "session_date"))

    def quality_log(self) -> DataFrame:
        return quality.quality_history(
            self.table("stg_events_flat"), self.table("stg_sessions"), self.fact_sessions(True),
            self.dims(True, date=True))


_OPEN: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of this session over ``sf_dir``."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = Warehouse(spark, sf_dir)
    return _OPEN[key]
