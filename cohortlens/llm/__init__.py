"""Training-data operators (numbered 1-10); nothing else in the library imports this package."""
