"""Multi-operator runs: profile, clean, impute, enrich and the four-stage run."""
