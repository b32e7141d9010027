"""Training-data operators: personal data, toxicity, near duplicates, licences, mixing, packing,
search, page text and language-model scores.  Nothing outside this folder, its tests and
``corpus_pipeline.py`` imports it."""
