"""Data health, cleaning, enrichment and model-based imputation as Spark DataFrame operators."""
