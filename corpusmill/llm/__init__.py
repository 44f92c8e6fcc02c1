"""Training-data operators: scoring, deduplication, archives, language, toxicity, decontamination, privacy, mixing."""
