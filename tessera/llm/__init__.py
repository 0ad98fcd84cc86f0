"""Training-data operators: near-duplicates, language-model scores, archives,
quality, personal data, tokens and packing. Nothing else in the library
imports this package; its queries are registered in ``tessera.llm.queries``."""
