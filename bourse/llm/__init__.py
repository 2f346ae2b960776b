"""Training-data operators: near-duplicates, repeated passages, benchmark
leaks, token counts and files, secrets, language-model scores, packing,
quality rules and page text. Nothing else in the library imports this."""
