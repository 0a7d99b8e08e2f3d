"""Full-width reads of a source table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SourceSpec:
    """Where a table is read from.

    kind 'table' reads a catalog table, 'jdbc' a table of another database, anything else is the name of a
    file format. A JDBC read needs ``predicates``, one per partition (``source_predicates`` makes them from units), or
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``: without them Spark pulls the whole table
    through one task. Other kinds are cut down to the rows for which one of the predicates holds.
    """

    kind: str
    location: str
    options: Mapping[str, str] = field(default_factory=dict)
    predicates: tuple[str, ...] = ()


_JDBC_SPLIT = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.predicates and spec.kind != "jdbc":
        return _read(spark, spec).filter(F.expr(" OR ".join(spec.predicates)))
    return _read(spark, spec)


def _read(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.kind == "table":
        return spark.table(spec.location)
    if spec.kind == "jdbc" and spec.predicates:
        url = spec.options["url"]
        others = {k: v for k, v in spec.options.items() if k != "url"}
        return spark.read.jdbc(url, spec.location, predicates=list(spec.predicates), properties=others)
    if spec.kind == "jdbc":
        missing = [o for o in _JDBC_SPLIT if o not in spec.options]
        if missing:
            raise ValueError(f"JDBC source {spec.location} would be read by one task; set {', '.join(missing)}")
        return spark.read.format("jdbc").option("dbtable", spec.location).options(**spec.options).load()
    return spark.read.format(spec.kind).options(**spec.options).load(spec.location)


def check_columns(source: DataFrame, target: DataFrame, extra: list[str]) -> list[str]:
    """The target holds the source's columns, same names and types in the same order, then ``extra``.

    Returns the column names to load.
    """
    wanted = [(f.name, f.dataType) for f in target.schema.fields if f.name not in extra]
    offered = [(f.name, f.dataType) for f in source.schema.fields if f.name not in extra]
    if wanted != offered:
        gaps = [f"{o} is not {w}" for o, w in zip(offered, wanted) if o != w]
        gaps += [f"{len(offered)} source columns, {len(wanted)} target columns"] if len(offered) != len(wanted) else []
        raise ValueError("source and target columns differ: " + "; ".join(gaps))
    return [name for name, _ in wanted]
