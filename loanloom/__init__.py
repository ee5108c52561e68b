"""Credit-feature engine: raw entity and history tables to model-ready features, as Spark plans."""
