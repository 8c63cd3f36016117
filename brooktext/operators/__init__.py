"""Model updates and predictions as DataFrame operators."""
