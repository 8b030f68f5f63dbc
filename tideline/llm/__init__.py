"""Training-data operators: ten operators over documents and embeddings, one module each."""
