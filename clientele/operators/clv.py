"""Customer lifetime value projection.

AnnualRevenue = round2(AvgOrderValue * PurchaseCount / (CustomerTenureDays / 365 + 1))
CLV_Predicted = round2(AnnualRevenue * lifespan_years)

The operations are evaluated in DOUBLE in the same order as the source so that the
rounded results agree bit for bit. A tenure of exactly -365 days would divide by zero;
the result is then NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.numeric import round2

# Fills applied before the projection.
AOV_FILL = 0.0
PURCHASE_FILL = 1
TENURE_FILL = 365
DAYS_PER_YEAR = 365.0


def clv(df: DataFrame, lifespan_years: int = 5) -> DataFrame:
    aov = F.coalesce(F.col("AvgOrderValue").cast("double"), F.lit(AOV_FILL))
    purchases = F.coalesce(F.col("PurchaseCount"), F.lit(PURCHASE_FILL)).cast("double")
    tenure = F.coalesce(F.col("CustomerTenureDays"), F.lit(TENURE_FILL)).cast("double")
    per_year = F.try_divide(purchases, tenure / F.lit(DAYS_PER_YEAR) + F.lit(1.0))
    annual = round2(aov * per_year)
    return (df.withColumn("AnnualRevenue", annual)
              .withColumn("CLV_Predicted", round2(F.col("AnnualRevenue") * F.lit(float(lifespan_years)))))
