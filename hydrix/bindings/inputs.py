"""Inputs of the bindings: the driver's tables and the raw-measurement view ``M`` over ``events``.

``M`` has the raw columns of the source system (decimal commas, ``<`` detection limits, unparseable
text, NULL keys).  Every row of ``events`` is kept; ``%`` only varies the generated values.  The same
SQL text builds ``M`` in Spark and in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrix.plans.gold import GoldSpec
from hydrix.plans.silver import SilverSpec, build_silver


M_SQL = """select case when event_id % 97 = 0 then null else 'P' || cast(user_id as string) end as code_prelevement,
 'X' || cast(event_id % 9 as string) as code_parametre,
 case when event_id % 83 = 0 then null else
  case event_id % 9 when 0 then 'Escherichia coli' when 1 then 'Nitrates (en NO3)' when 2 then 'Plomb' when 3 then 'pH'
   when 4 then 'Tritium' when 5 then 'Chlore libre' when 6 then 'Glyphosate' when 7 then 'Entérocoques' else 'TEMPÉRATURE' end end as libelle_parametre,
 case when event_id % 89 = 0 then null else 'C' || cast(user_id % 40 as string) end as nom_commune,
 'D' || cast(user_id % 10 as string) as nom_departement, cast(user_id % 10 as string) as code_departement,
 case when event_id % 101 = 0 then null when event_id % 103 = 0 then 'le ' || substr(cast(ts as string),1,10) else substr(cast(ts as string),1,10) || 'T' || substr(cast(ts as string),12,8) || 'Z' end as date_prelevement,
 case event_id % 5 when 0 then '<' || replace(cast(value as string),'.',',') when 1 then replace(cast(value as string),'.',',')
  when 2 then ' ' || cast(value as string) when 3 then 'N.M.' else null end as resultat_alphanumerique,
 case when event_id % 5 < 3 then value end as resultat_numerique, 'mg/L' as libelle_unite,
 case when event_id % 2 = 0 then 'N' else 'O' end as code_type_parametre,
 case event_id % 3 when 0 then 'CONFORME' when 1 then 'NON CONFORME' else null end as conclusion_conformite_prelevement,
 event_id
from {events}"""

M_COLUMNS = (
    "code_prelevement", "code_parametre", "libelle_parametre", "nom_commune", "nom_departement",
    "code_departement", "date_prelevement", "resultat_alphanumerique", "resultat_numerique",
    "libelle_unite", "code_type_parametre", "conclusion_conformite_prelevement", "event_id",
)

# Binding parameters.
SILVER_SPEC = SilverSpec(tie_break=("event_id",))
GOLD_SPEC = GoldSpec(trend_round=4)
STATUS_OK = "CONFORME"
WINDOW = ("2024-01-10", "2024-01-20")
PAGE_SIZE = 1000
K = 10


# Declared schemas of the driver tables the bindings read (no schema-inference job).
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; known tables are read with their declared schema (no footer-inference job)."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def m_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(M_SQL, events=table(spark, sf_dir, "events"))


def silver_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(m_view(spark, sf_dir), SILVER_SPEC)


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def _f_pred():
    return F.col("o_orderstatus") == F.lit("F")
