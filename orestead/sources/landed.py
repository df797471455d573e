"""Scans of landed data: selections, nested JSON, dumps with bad lines, XML answers; and small sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

LICENCE = "array<struct<number:string,date:string,annulled:string,terminated:string,inn:string,objects:array<struct<address:string,city:string,region:string,activity:string>>>>"
#: Fixed value: numbers of medical licences.
MEDICAL_NUMBER = r"(?iU)^(?:ло|л0?41|фс)"
CORRECTION = 12


def selection(rows: DataFrame, header_rows: int, position: str = "row_no") -> DataFrame:
    """A company selection as landed: header rows go, keys must have the right number of digits, sites are split."""
    ok = rows.where((F.col(position) > header_rows) & text.has_digits(F.col("inn"), (10, 12)))
    return ok.withColumn("sites", text.all_sites(F.col("sites"))) if "sites" in rows.columns else ok


def row_range(rows: DataFrame, position: str, first: int, last: int, limit: int | None = None) -> DataFrame:
    out = rows.where(F.col(position).between(first, last))
    return out if limit is None else out.orderBy(position).limit(limit)


def json_lines(rows: DataFrame, column: str, schema: str, keep: list[str]) -> DataFrame:
    """Fields of JSON lines held in a column; a bad line is kept in _corrupt_record with nulls elsewhere."""
    parsed = F.from_json(column, f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return rows.select(*keep, parsed.alias("_j")).select(*keep, "_j.*")


def json_dump(spark: SparkSession, path: str, schema: str, done: DataFrame | None = None, key: str = "inn") -> DataFrame:
    """JSON lines; a bad line is kept in _corrupt_record with nulls elsewhere, keys already done are left out."""
    df = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").schema(f"{schema}, _corrupt_record string").json(path)
    return df if done is None else df.join(done.select(key), key, "left_anti")


def licences(rows: DataFrame, column: str = "body") -> DataFrame:
    """(inn, body) to a row per object of each licence; licences of another company are left out."""
    l = rows.select(F.col("inn").alias("asked"), F.explode_outer(F.from_json(column, LICENCE)).alias("l")).where("l is not null and (coalesce(l.inn, '') = '' or l.inn = asked)")  # noqa: E741
    l = l.select(F.col("asked").alias("inn"), "l.number", "l.date", "l.annulled", "l.terminated", F.col("l.number").rlike(MEDICAL_NUMBER).alias("is_med"), F.explode_outer("l.objects").alias("o"))  # noqa: E741
    return l.select("inn", "number", "date", "annulled", "terminated", "is_med", "o.address", "o.city", "o.region", "o.activity")


def preferred_correction(corrections: Column, has: str = "value") -> Column:
    """Of an array of struct<type, value>: the correction of type 12 that has a value, else the first that has one."""
    usable = F.filter(corrections, lambda c: c[has].isNotNull())
    return F.coalesce(F.get(F.filter(usable, lambda c: c["type"] == CORRECTION), F.lit(0)), F.get(usable, F.lit(0)))


def xml_results(rows: DataFrame, column: str = "xml", keep: list[str] | None = None) -> DataFrame:
    """url, domain and title of each document of a search answer, after the columns of keep."""
    of = lambda tag: F.expr(f"xpath({column}, '//doc/{tag}/text()')")
    return rows.select("*", F.explode(F.arrays_zip(of("url").alias("url"), of("domain").alias("domain"), of("title").alias("title"))).alias("d")).select(*(keep or []), "d.url", "d.domain", "d.title")


def orphans(rows: DataFrame, confirmed: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(confirmed, keys, "left_anti")


def sheet(df: DataFrame) -> DataFrame:
    """Strings fit for a spreadsheet: control characters become dots, arrays are joined."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        out.append((text.cell(c) if kind == "string" else F.array_join(c.cast("array<string>"), "; ") if kind.startswith("array<") else c).alias(name))
    return df.select(*out)
