"""The cleaned customer view: one definition of every business term."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.customer import band, collapse, count_yes
from holdfast.functions.numeric import strict_money
from holdfast.sources.contract import ADDON_COLUMNS, TELCO, Contract

# Source column -> name in the cleaned view.
ADDON_NAMES = {
    "OnlineSecurity": "online_security",
    "OnlineBackup": "online_backup",
    "DeviceProtection": "device_protection",
    "TechSupport": "tech_support",
    "StreamingTV": "streaming_tv",
    "StreamingMovies": "streaming_movies",
}


def silver_customers(raw: DataFrame, contract: Contract = TELCO) -> DataFrame:
    """Rename, type and derive; a single projection that stays inside one codegen span.

    A charge text that is neither blank nor a number fails the job on purpose.
    """
    col = F.col
    return raw.select(
        col(contract.id_column).alias("customer_id"),
        col("gender"),
        (col("SeniorCitizen") == 1).alias("is_senior"),
        (col("Partner") == "Yes").alias("has_partner"),
        (col("Dependents") == "Yes").alias("has_dependents"),
        col("tenure").alias("tenure_months"),
        strict_money(col("TotalCharges")).alias("total_charges"),
        col("MonthlyCharges").alias("monthly_charges"),
        col("PhoneService").alias("phone_service"),
        collapse(col("MultipleLines"), ["No phone service"]).alias("multiple_lines"),
        col("InternetService").alias("internet_service"),
        *(
            collapse(col(source), ["No internet service"]).alias(name)
            for source, name in ADDON_NAMES.items()
        ),
        col("Contract").alias("contract_type"),
        (col("PaperlessBilling") == "Yes").alias("paperless_billing"),
        col("PaymentMethod").alias("payment_method"),
        col("PaymentMethod").like("%automatic%").alias("is_automatic_payment"),
        (col(contract.target) == contract.positive).alias("has_churned"),
        band(col("tenure")).alias("tenure_band"),
        count_yes(ADDON_COLUMNS).alias("addon_service_count"),
        (col("InternetService") != "No").alias("has_internet"),
        (col("MonthlyCharges") * 12).cast("decimal(10,2)").alias("annual_revenue"),
    )
