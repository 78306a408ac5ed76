"""End-to-end plans built from the operators."""

from netbaseline.plans.baseline import ModelConfig, model_config, baseline_bounds, baseline_slots, batch_baseline

__all__ = ["ModelConfig", "model_config", "baseline_bounds", "baseline_slots", "batch_baseline"]
