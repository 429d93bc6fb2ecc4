"""Driver test tables and the column roles bound to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.roles import Roles

ORDERS = Roles(key="o_orderkey", category="o_orderpriority", measure="o_totalprice",
               measure2=None, measure3=None, event_time="o_orderdate", update_time="o_orderdate",
               tags=None, name=None, description=None)

# lineitem joined to part: the part name's words are the tags of a line.
LINEITEM = Roles(key=None, category="l_returnflag", measure="l_extendedprice",
                 measure2="l_quantity", measure3="l_linenumber", event_time="l_shipdate",
                 update_time="l_shipdate", tags="tags", name=None, description=None)

PART = Roles(key="p_partkey", category="p_brand", measure="p_retailprice", measure2=None,
             measure3=None, event_time=None, update_time=None, tags="tags", name="p_name",
             description=None)

DOCUMENTS = Roles(key="doc_id", category="lang", measure="n_chars", measure2=None, measure3=None,
                  event_time=None, update_time=None, tags="tags", name="source",
                  description="text")

EMBEDDINGS = Roles(key="vec_id", category="label", measure=None, measure2=None, measure3=None,
                   event_time=None, update_time=None, tags=None, name=None, description=None)

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_with_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part with ``tags = split(p_name, ' ')``."""
    return table(spark, sf_dir, "part").withColumn("tags", F.split(F.col("p_name"), " "))


def lineitem_with_tags(spark: SparkSession, sf_dir: str, only_tags=None) -> DataFrame:
    """lineitem joined to its part's tags and brand.

    No broadcast hint: part grows with the scale factor, so the join is left
    to the planner and AQE, which switch to a broadcast join only when the
    *measured* part side is below the broadcast threshold.  With ``only_tags``
    the part side is first reduced to parts carrying one of those tags.
    """
    part = part_with_tags(spark, sf_dir).select("p_partkey", "p_brand", "tags")
    if only_tags:
        part = part.where(F.arrays_overlap(F.col("tags"), F.array(*[F.lit(t) for t in only_tags])))
    li = table(spark, sf_dir, "lineitem")
    return li.join(part, li["l_partkey"] == part["p_partkey"], "inner").drop("p_partkey")
