"""SQL written apart from the library, to check its results in another engine."""
