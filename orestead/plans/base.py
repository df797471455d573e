"""Registration of queries with their SQL, and the views that stand in for landed tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Tables of a directory, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def items(self) -> DataFrame:
        """Priced positions: domain, inn, name, section, price, pos."""
        return self._items(self.part)

    def _items(self, p: DataFrame, *further: str) -> DataFrame:
        li, o = self.lineitem, self.orders
        return (
            li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
            .select(
                F.col("l_suppkey").alias("domain"), F.col("o_custkey").alias("inn"), F.col("p_name").alias("name"), F.col("p_type").alias("section"),
                F.col("l_extendedprice").alias("price"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000000 + F.col("l_partkey") * 10000 + F.col("l_suppkey") % 10000).alias("pos"), F.col("p_brand").alias("brand"), *further,
            )
        )

    @property
    def directed(self) -> DataFrame:
        """items with a direction by ordered rules. They read a part's columns only, so parts are classified before the join."""
        from .rulesets import direction

        return self._items(self.part.withColumn("direction", direction(F.col("p_name"), F.col("p_type"))), "direction")

    @property
    def licences(self) -> DataFrame:
        """A licence text per company."""
        return self.customer.select(F.col("c_custkey").alias("inn"), F.col("c_mktsegment").alias("licence"))

    @property
    def site_dirs(self) -> DataFrame:
        """Directions that a company's site claims."""
        c = F.col("c_custkey")
        listed = F.array(*[F.lit(x) for x in ("Round", "Flat", "Toothed", "Thermal")])
        return self.customer.select(c.alias("inn"), F.element_at(listed, (c % 4 + 1).cast("int")).alias("direction")).where("inn % 3 <> 0").union(
            self.customer.select(c.alias("inn"), F.element_at(listed, (c % 3 + 1).cast("int")).alias("direction")).where("inn % 5 = 0")
        ).distinct()


#: DuckDB's common table expressions of the same views.
ITEMS = """items AS (SELECT l_suppkey AS domain, o_custkey AS inn, p_name AS name, p_type AS section, l_extendedprice AS price,
 (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey % 10000 AS pos, p_brand AS brand FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
DIRECTION = """CASE WHEN regexp_matches(name, '(ring|rod)') AND NOT regexp_matches(name, '^old') THEN 'Round'
 WHEN regexp_matches(name, 'plate') THEN 'Flat' WHEN regexp_matches(name, 'gear') AND NOT regexp_matches(name, 'small') THEN 'Toothed'
 WHEN regexp_matches(name, '^(hot|cold)') THEN 'Thermal' WHEN regexp_matches(name, 'bolt') THEN 'Service'
 WHEN regexp_matches(name, 'anvil') AND NOT regexp_matches(name, '^new') THEN 'Heavy' WHEN regexp_matches(name, 'gizmo') THEN 'Clever'
 WHEN regexp_matches(name, 'widget') AND NOT regexp_matches(name, '^(old|blue)') THEN 'Fitted'
 WHEN section = 'PROMO' THEN 'Promotion' END"""
DIRECTED = f"{ITEMS}, directed AS (SELECT *, {DIRECTION} AS direction FROM items)"
LICENCES = "licences AS (SELECT c_custkey AS inn, c_mktsegment AS licence FROM customer)"
SITE_DIRS = """site_dirs AS (SELECT DISTINCT * FROM (SELECT c_custkey AS inn, (['Round','Flat','Toothed','Thermal'])[c_custkey % 4 + 1] AS direction FROM customer WHERE c_custkey % 3 <> 0
 UNION ALL SELECT c_custkey, (['Round','Flat','Toothed','Thermal'])[c_custkey % 3 + 1] FROM customer WHERE c_custkey % 5 = 0))"""


def query(name: str, sql: str | None = None):
    """Registers f(tables) under name, with its SQL."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return register
