"""Filing text jobs: sections, tokens, tf-idf, similarity, sentiment, phrases."""
