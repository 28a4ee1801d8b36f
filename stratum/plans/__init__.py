"""Steps that read and commit state, and pipelines of them."""
