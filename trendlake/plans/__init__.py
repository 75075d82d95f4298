from trendlake.plans.pipeline import (
    QualityGateError,
    bronze_to_silver,
    quality_gate,
    reference_to_silver,
    run,
    silver_to_gold,
)

__all__ = ["QualityGateError", "bronze_to_silver", "quality_gate", "reference_to_silver", "run", "silver_to_gold"]
