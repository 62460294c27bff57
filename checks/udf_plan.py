"""The comparison plan for the bench, which shares no step with the engine: the input parsed once per output,
regular expressions for the cleaning, ``filter(p)`` and ``filter(~p)``, a row-at-a-time Python UDF for the
identity, and ``dropDuplicates`` for the survivor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the identity and the country rule.
NAMESPACE = uuid.UUID("57da2380-82c6-40a6-8e94-a77ee513bdfd")
NAMES = {"Spain": "ES", "France": "FR", "Germany": "DE", "ES": "ES", "FR": "FR", "DE": "DE"}


def _cleaned(spark: SparkSession, path: str) -> DataFrame:
    code = F.create_map(*[F.lit(part) for pair in NAMES.items() for part in pair])[F.col("country")]
    compact = F.regexp_replace(F.upper(F.trim("vat_number")), "[- ]", "")
    return (
        spark.read.option("header", True)
        .csv(path)
        .select(
            F.col("client_code").alias("external_id"),
            F.col("legal_name").alias("name"),
            compact.alias("tax_id"),
            code.alias("country"),
            F.col("contact_email").alias("email"),
        )
        .withColumn("tax_id", F.regexp_replace("tax_id", F.concat(F.lit("^"), F.coalesce("country", F.lit("-"))), F.lit("")))
    )


def run_udf_plan(spark: SparkSession, input_path: str, processed_path: str, rejected_path: str) -> None:
    """Both outputs of an extract in the layout of ERP_B."""

    @F.udf("string")
    def identity(country: str, tax_id: str) -> str:
        return str(uuid.uuid5(NAMESPACE, f"{country}:{tax_id}"))

    valid = (F.col("country") != "ES") | (F.length("tax_id") == 9)
    rows = _cleaned(spark, input_path)
    identified = rows.filter(valid).withColumn("customer_id", identity("country", "tax_id"))
    identified.dropDuplicates(["customer_id"]).write.mode("overwrite").parquet(processed_path)
    rows.filter(~valid).withColumn("reason", F.lit("Invalid tax ID")).write.mode("overwrite").json(rejected_path)
