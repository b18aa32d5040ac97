"""Training-data operators: quality, decontamination, near-duplicates, toxicity, extraction, secrets, personal data,
source mixing, language and licences. Nothing else in the library imports this subpackage."""
