"""Operators of a training-data pipeline: near duplicates, secrets, token files,
decontamination, language-model scores, token counts, mixing, quality rules,
toxicity, licences, similarity joins, fill-in-the-middle, filter audits. Nothing else in the library imports this subpackage."""
