"""Composite plans: the transformation (X1-X3, X5) and the run job (X4)."""

from cargoline.plans.transform import DeliveryRules, QualityChecks, transform

__all__ = ["DeliveryRules", "QualityChecks", "transform"]
