"""Reading raw files and collections, writing results and models."""
