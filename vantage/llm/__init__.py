"""Training-data operators: sharding, near-dedup, language, search, token counts, toxicity, licences, archives,
benchmark decontamination and BPE. Nothing else in the library imports this subpackage."""
