"""The tables of one landing zone, each computed once per session and kept as Parquet.

``raw`` is the text; ``located`` and ``loops`` are the parsed segments and loop instances; ``errors`` is the result
of validation. Queries read these tables like any other: columns are pruned, filters on loop and segment ids reach
the scan, and text is parsed once however many queries follow.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import build, framing, loops, validation
from ..session import store, tune
from ..specs.catalog import professional_claim
from ..specs.model import Spec

SPEC = professional_claim()


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str, variant: str, spec: Spec = SPEC):
        self.spark, self.sf_dir, self.variant, self.spec = spark, sf_dir.rstrip("/"), build.VARIANTS[variant], spec
        self._kept: dict[str, DataFrame] = {}
        self.prefix = f"{hashlib.md5(self.sf_dir.encode()).hexdigest()[:8]}/{variant}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _store(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        return store(df, f"{self.prefix}/{name}", partition_by)

    @cached_property
    def raw(self) -> DataFrame:
        documents = build.claim_documents(self.table("customer"), self.table("orders"), self.table("lineitem"), self.variant)
        return self._store(documents, "raw", ("multi",))

    @cached_property
    def has_long(self) -> bool:
        """Whether any document has several parts; answered by the partitions of ``raw``."""
        return not self.raw.where("multi").isEmpty()

    @property
    def framed(self) -> DataFrame:
        return framing.frame(self.raw, self.spec.spec_id)

    @property
    def parts(self) -> DataFrame:
        return framing.cut_elements(framing.cut_segments(self.framed))

    def assign(self) -> DataFrame:
        """Loop assignment straight from the text."""
        return loops.assign_loops(self.parts, self.spec, self.has_long)

    @cached_property
    def located(self) -> DataFrame:
        return self._store(self.assign(), "located")

    @property
    def segments(self) -> DataFrame:
        """``located`` for a single pass: the stored table if it is there, else straight from the text, without storing it."""
        return self.located if "located" in self.__dict__ else self.assign()

    def chosen(self, name: str, where: Column) -> DataFrame:
        """The segments that the steps of a query read, stored once and without the others; those of ``located`` if that is there."""
        if "located" in self.__dict__:
            return self.located.where(where)
        if name not in self._kept:
            self._kept[name] = self._store(self.assign().where(where), f"chosen/{name}")
        return self._kept[name]

    def outline(self, name: str = "outline", texts: Column | None = None, paths: Column | None = None) -> DataFrame:
        """All segments for steps that read few texts, stored once: ``elements`` where ``texts`` holds, ``path_inst`` where
        ``paths`` does (at the start of loops if not given); null elsewhere, as is ``sep``. ``located`` if that is there."""
        if "located" in self.__dict__:
            return self.located
        if name not in self._kept:
            rows, paths = self.assign(), F.col("role") == "start" if paths is None else paths
            self._kept[name] = self._store(rows.withColumns({
                "elements": F.when(F.lit(False) if texts is None else texts, F.col("elements")), "path_inst": F.when(paths, F.col("path_inst")),
                "sep": F.lit(None).cast(rows.schema["sep"].dataType)}), f"outline/{name}")
        return self._kept[name]

    @cached_property
    def loops(self) -> DataFrame:
        return self._store(loops.link_parents(self.located), "loops")

    @property
    def loops_alone(self) -> DataFrame:
        """``loops`` for queries that don't need ``located``."""
        if "loops" not in self.__dict__:
            self.loops = self._store(loops.link_parents(self.segments), "loops")
        return self.loops

    @cached_property
    def errors(self) -> DataFrame:
        return self._store(self.validate(), "errors")

    def validate(self) -> DataFrame:
        unreadable = framing.quarantine(self.framed, self.spec.spec_id)
        return validation.collect_errors(self.located, self.spec, unreadable, loops=self.loops)


_lakes: dict[tuple[str, str, str], Lake] = {}


def lake(spark: SparkSession, sf_dir: str, variant: str = "clean") -> Lake:
    key = (spark.sparkContext.applicationId, sf_dir, variant)
    if key not in _lakes:
        _lakes[key] = Lake(tune(spark), sf_dir, variant)
    return _lakes[key]
