"""Gold marts, KPIs and business questions built from the silver models."""
